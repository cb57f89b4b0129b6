"""Exact duplicates by merging sorted runs of digests over a tree of partitions.

Every partition makes sorted runs of the digests of its texts, copies already put together. A power of two
of positions then exchange runs in binomial rounds: in each, a position keeps the entries whose digest has
its own bits there and sends the others to the positions that differ from it in these bits only. With
``ROUND_BITS`` bits a round there are as many rounds as the logarithm of the positions, and no position ever
talks to all others. At the receiver the sorted runs are merged as they come, and of equal texts one entry
stays, with the identifier that stays and the number of rows. After the last round each position has one
range of digests, whole.

A text is its SHA-256, confirmed at every level by its length and a second hash. An entry has a fixed size,
and a task holds one block of each run that it merges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.joins import joiner
from wayfare.session import written

ROUND_BITS = 3
# Positions are told apart by the first bits of a digest, of which this many are looked at.
MOST_BITS = 20
RUN_ENTRIES = 400_000
BLOCK_ENTRIES = 1_024
MERGE_ENTRIES = 100_000

ENTRY = np.dtype([
    ("digest", "S32"), ("check", "<i8"), ("n_bytes", "<i8"), ("no_id", "u1"), ("rank", "<i8"), ("place", "<i8"),
    ("n", "<i8"),
])
BLOCKS = "at int, least binary, entries binary"
GROUPS = "digest binary, check long, n_bytes long, keep_id long, keep_place long, group_size long"


def merged(entries: np.ndarray) -> np.ndarray:
    """``entries`` by digest, those of one text as one: the first by identifier, with all rows counted."""
    if not len(entries):
        return entries
    e = entries[np.lexsort([entries[k] for k in ("place", "rank", "no_id", "n_bytes", "check", "digest")])]
    differs = np.zeros(len(e), dtype=bool)
    differs[0] = True
    for name in ("digest", "check", "n_bytes"):
        differs[1:] |= e[name][1:] != e[name][:-1]
    first = np.flatnonzero(differs)
    out = e[first]
    out["n"] = np.add.reduceat(e["n"], first)
    return out


def rounds_for(bits: int, each: int = ROUND_BITS) -> list[tuple[int, int]]:
    """(low, high) bits of a position that change in each round, the highest first."""
    return [(max(high - each, 0), high) for high in range(bits, 0, -each)]


def _sent(entries: np.ndarray, at: int, bits: int, turn: tuple[int, int]) -> pd.DataFrame:
    """A sorted run in blocks, each for the position that differs from ``at`` in the bits of this round."""
    low, high = turn
    mask = (1 << high) - (1 << low)
    lead = np.ascontiguousarray(entries["digest"]).view(">u4").reshape(-1, 8)[:, 0].astype(np.int64) >> (32 - bits)
    to = (at & ~mask) | (lead & mask)
    rows = []
    edges = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
    for start, end in zip(edges, edges[1:]):
        for i in range(start, end, BLOCK_ENTRIES):
            block = entries[i:min(i + BLOCK_ENTRIES, end)]
            rows.append((int(to[i]), block[:1].tobytes()[:32], block.tobytes()))
    return pd.DataFrame(rows, columns=["at", "least", "entries"])


def local_runs(
    batches: Iterator[pd.DataFrame], bits: int, turn: tuple[int, int], largest: bool
) -> Iterator[pd.DataFrame]:
    """Sorted runs of a partition's rows (doc_id, place, digest, check, n_bytes), sent off for the first round."""
    at = TaskContext.get().partitionId() % (1 << bits)
    run, held = [], 0
    for batch in batches:
        e = np.zeros(len(batch), dtype=ENTRY)
        e["digest"] = np.frombuffer(b"".join(batch["digest"]), dtype="S32")
        for name in ("check", "n_bytes", "place"):
            e[name] = batch[name].to_numpy()
        missing = batch["doc_id"].isna()
        ids = batch["doc_id"].fillna(0).astype("int64").to_numpy()
        e["no_id"], e["rank"], e["n"] = missing, ~ids if largest else ids, 1
        run.append(e)
        held += len(e)
        if held >= RUN_ENTRIES:
            yield _sent(merged(np.concatenate(run)), at, bits, turn)
            run, held = [], 0
    if held:
        yield _sent(merged(np.concatenate(run)), at, bits, turn)


def _merging(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray]]:
    """(position, merged entries in order) from blocks that come by position and least digest.

    Entries below the least digest of the block at hand are complete, as no later block can have them.
    """
    at, waiting, held, limit = None, [], 0, MERGE_ENTRIES
    for batch in batches:
        for to, least, block in zip(batch["at"], batch["least"], batch["entries"]):
            if to != at:
                if held:
                    yield at, merged(np.concatenate(waiting))
                at, waiting, held, limit = to, [], 0, MERGE_ENTRIES
            elif held >= limit:
                ready = merged(np.concatenate(waiting))
                below = int(np.searchsorted(ready["digest"], np.frombuffer(least, dtype="S32")[0]))
                if below:
                    yield at, ready[:below]
                waiting, held = [ready[below:]], len(ready) - below
                limit = max(MERGE_ENTRIES, 2 * held)
            waiting.append(np.frombuffer(block, dtype=ENTRY))
            held += len(waiting[-1])
    if held:
        yield at, merged(np.concatenate(waiting))


def _next_round(batches: Iterator[pd.DataFrame], bits: int, turn: tuple[int, int]) -> Iterator[pd.DataFrame]:
    for at, entries in _merging(batches):
        yield _sent(entries, int(at), bits, turn)


def _groups(batches: Iterator[pd.DataFrame], largest: bool) -> Iterator[pd.DataFrame]:
    for _, entries in _merging(batches):
        e = entries[entries["n"] > 1]
        raw = np.ascontiguousarray(e["digest"]).tobytes()
        ids = pd.Series(~e["rank"] if largest else e["rank"], dtype="Int64").mask(e["no_id"].astype(bool))
        yield pd.DataFrame({
            "digest": [raw[i:i + 32] for i in range(0, len(raw), 32)], "check": e["check"], "n_bytes": e["n_bytes"],
            "keep_id": ids, "keep_place": e["place"], "group_size": e["n"],
        })


def copy_groups(digests: DataFrame, largest: bool, round_bits: int = ROUND_BITS) -> DataFrame:
    """Texts that several rows of ``digests`` (doc_id, place, digest, check, n_bytes) have: a row each.

    keep_id is the greatest doc_id of the text, or the least; a row with an id goes before one without, and
    among equal ids the least place.
    """
    parallel = int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(MOST_BITS, max(1, (parallel - 1).bit_length()))
    first, *others = rounds_for(bits, round_bits)
    runs = digests.mapInPandas(partial(local_runs, bits=bits, turn=first, largest=largest), BLOCKS)

    def exchanged(blocks: DataFrame) -> DataFrame:
        return blocks.repartitionById(1 << bits, "at").sortWithinPartitions("at", "least")

    for turn in others:
        runs = exchanged(runs).mapInPandas(partial(_next_round, bits=bits, turn=turn), BLOCKS)
    return exchanged(runs).mapInPandas(partial(_groups, largest=largest), GROUPS)


def exact_duplicates(docs: DataFrame, keep: str = "largest", round_bits: int = ROUND_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row of ``docs`` (doc_id, text).

    Rows are copies when their whole texts are identical, byte by byte; a null text is an empty one, and a
    text of any length is hashed as one. Of copies the row with the ``largest`` doc_id stays, or the
    ``smallest``. A row without a doc_id stays only if no copy has one, and keep_id is null then. Rows equal
    in text and doc_id count one by one, and one of them stays. An empty table gives no rows. Other columns,
    whatever their names, are not looked at.

    The table of texts with copies goes back to the rows by a broadcast if it measures below 64 MB, and
    otherwise by a join in which a text with millions of copies is spread.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digests = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.xxhash64(text).alias("check"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    ), "digests")
    groups = written(copy_groups(digests, keep == "largest", round_bits), "copies")
    found = joiner(groups, ["digest", "check", "n_bytes"], ["place"])(digests, "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("place") == F.col("keep_place"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
