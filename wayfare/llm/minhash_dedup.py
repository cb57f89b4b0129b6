"""Near-duplicate texts by MinHash with tensored tables, confirmed on full sets of shingles.

Two collections of ``bands`` band hashes are made from ``2 * ROWS * bands`` minhashes. Each of the
``bands ** 2`` tables takes its key from one band of either collection, so that long and selective keys
need about the square root of the minhashes that independent tables would.

What keeps the work in proportion to the input:

- Texts with equal words are one text from the start.
- A band hash that no other text has can be in no shared table key; only shared ones are combined.
- Of the texts in shared buckets the shingles that no other of them has are counted. They bound the
  similarity a pair can reach, exactly, and rule out nearly all pairs that are only somewhat alike.
- A bucket's members are compared with one centre, so that a large group of copies costs a star, not all
  pairs. Buckets whose texts are not all connected by that go on by centre, each text once, and what their
  texts differ in from the middle of all leads to the links left (``difference_sets``).

Nothing is capped. A pair at the limit of similarity shares no table with a chance below ``MISSED``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import components
from wayfare.llm.difference_sets import enough, links_and_pairs
from wayfare.llm.worker import kept
from wayfare.operators.joins import join_by_key
from wayfare.session import written

ROWS = 3
MISSED = 3e-5
SEED = 5
MOST_WORDS = 200_000
CHUNK = 2_048

FIRST, SECOND, THIRD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def bands_for(percent: int) -> int:
    """Bands per collection so that a pair at the limit is missed with a chance below ``MISSED``."""
    bands = 1
    while 2 * (1 - (percent / 100) ** ROWS) ** bands > MISSED:
        bands += 1
    return bands


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * THIRD
    return x ^ (x >> np.uint64(32))


def normal_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; only ASCII white space separates."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words, sorted; a shorter text is one run, no words are none."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    known = kept("word hashes", _WordHashes)
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    run = min(size, len(words))
    total = hashes[: len(hashes) - run + 1] + np.uint64(run)
    for k in range(1, run):
        total = _mixed(total * FIRST + hashes[k: len(hashes) - run + 1 + k])
    return np.unique(total)


def _signature(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), CHUNK):
        least = np.minimum(least, (found[at:at + CHUNK, None] * factors).min(axis=0))
    return least


def described(docs: DataFrame, size: int, bands: int, others: Sequence[str] = ()) -> DataFrame:
    """(doc_id, digest, n_shingles, bands): a digest of the words and the band hashes of both collections.

    ``others`` are columns without nulls that pass through.
    """
    factors = np.random.default_rng(SEED).integers(0, 2**63, 2 * ROWS * bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = normal_words(text)
                found = shingles(words, size)
                key = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
                if len(found):
                    least = _signature(found, factors).reshape(2 * bands, ROWS)
                    band = np.zeros(2 * bands, dtype=np.uint64)
                    for k in range(ROWS):
                        band = _mixed((band ^ least[:, k]) * FIRST + SECOND)
                    out.append((doc_id, key, len(found), band.view(np.int64)))
                else:
                    out.append((doc_id, key, 0, None))
            frame = pd.DataFrame(out, columns=["doc_id", "digest", "n_shingles", "bands"])
            yield frame.assign(
                doc_id=pd.array(frame["doc_id"], dtype="Int64"), **{name: batch[name].to_numpy() for name in others}
            )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *others)
    passed = "".join(f", {f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[2:])
    return narrow.mapInPandas(describe, f"doc_id long, digest binary, n_shingles long, bands array<long>{passed}")


def table_keys(texts: DataFrame, bands: int) -> DataFrame:
    """(text_key, key) for every table in which a text may meet another. ``texts`` has text_key and bands."""
    each = written(texts.select("text_key", F.posexplode("bands").alias("band", "value")), "bands")
    shared = each.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1").select("band", "value")
    met = each.join(written(shared, "shared_bands"), ["band", "value"], "left_semi")
    of_text = met.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("band", "value"))).alias("met"))

    def collection(first: bool) -> Column:
        return F.filter("met", lambda b: (b["band"] < bands) if first else (b["band"] >= bands))

    tables = F.flatten(F.transform(collection(True), lambda a: F.transform(
        collection(False), lambda b: F.xxhash64(a["band"], a["value"], b["band"], b["value"])
    )))
    return of_text.select("text_key", F.explode(tables).alias("key"))


def _in_company(keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose bucket has two texts or more."""
    full = written(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "buckets")
    return written(keys.join(full, "key", "left_semi"), "members")


def full_sets(docs: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """(text_key, found) of ``candidates`` (text_key, digest, doc_id), one row each, from the documents' texts."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [normal_words(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "digest": [xxhash.xxh3_128_digest(b" ".join(w)) for w in words],
                "found": [shingles(w, size).view(np.int64) for w in words],
            })

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null")
    chosen = join_by_key(narrow, candidates.select("doc_id").distinct(), ["doc_id"], "left_semi", ["text"])
    made = chosen.mapInPandas(sets, "doc_id long, digest binary, found array<long>")
    # where documents share an id, the digest tells their texts apart
    of_text = join_by_key(made, candidates, ["doc_id", "digest"], "inner", ["found"])
    found = written(of_text.select("text_key", "found"), "sets")
    if found.groupBy("text_key").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return found
    return written(found.dropDuplicates(["text_key"]), "sets")


def _shared_sizes(sets: DataFrame) -> DataFrame:
    """(text_key, n, shared): size of each set, and how many of its shingles another set has too."""
    single = (
        sets.select("text_key", F.explode("found").alias("shingle"))
        .groupBy("shingle").agg(F.count("*").alias("n"), F.min("text_key").alias("text_key")).filter("n = 1")
        .groupBy("text_key").agg(F.count("*").alias("alone"))
    )
    sizes = sets.select("text_key", F.size("found").cast("long").alias("n"))
    return sizes.join(single, "text_key", "left").select(
        "text_key", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared")
    )


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Whether two sets, given (n, shared) of each, can be similar enough: an exact bound."""
    return enough(F.least(a["shared"], b["shared"]), a["n"], b["n"], percent)


def _spread(sets: DataFrame) -> DataFrame:
    """:func:`_shared_sizes` with found, the shared shingles, and spread, the mean number of sets that a shingle is in."""
    each = sets.select("text_key", F.explode("found").alias("shingle"))
    held = written(each.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"), "held")
    shared = each.join(held, "shingle").groupBy("text_key").agg(
        F.count("*").alias("shared"), F.sum("n").alias("holders"), F.collect_list("shingle").alias("found")
    )
    sizes = sets.select("text_key", F.size("found").cast("long").alias("n"))
    return sizes.join(shared, "text_key").withColumn("spread", F.col("holders") / F.col("n")).drop("holders")


def measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) with the size of what their sets have in common, and whether that links them."""
    of = lambda name: sets.select(F.col("text_key").alias(name), F.col("found").alias(f"found_{name}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").withColumn(
        "both", F.size(F.array_intersect("found_a", "found_b")).cast("long")
    )
    union = F.size("found_a") + F.size("found_b") - F.col("both")
    return joined.select("a", "b", "both", (100 * F.col("both") >= percent * union).alias("linked"))


def _folded(hubs: DataFrame, members: DataFrame, shared: DataFrame) -> DataFrame:
    """(hub, into) for centres that have half of what they share with any text in common with another centre.

    ``hubs`` has the buckets and their centres, ``members`` their texts, ``shared`` the elements that a text
    shares. Into is a centre that goes into no other, so that nothing drifts off over a chain of them.
    """
    known = written(hubs.select("centre.text_key", "centre.spread").distinct(), "hubs")
    met = members.join(known.select("text_key"), members["text.text_key"] == known["text_key"], "left_semi").join(hubs, "key")
    pairs = met.select(F.col("centre.text_key").alias("a"), F.col("text.text_key").alias("b")).filter("a != b").distinct()
    close = written(measured(written(pairs, "hub_pairs"), shared, 50).filter("linked").select("a", "b"), "close")
    final = close.join(close.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    into = known.select(F.col("text_key").alias("a"), F.struct("spread", "text_key").alias("into"))
    return written(
        final.join(into, "a").groupBy(F.col("b").alias("hub")).agg(F.max("into")["text_key"].alias("into")), "folded"
    )


def links_of(docs: DataFrame, texts: DataFrame, size: int, percent: int, bands: int) -> DataFrame:
    """Links (a, b) of text keys that connect what similar ones of ``texts`` connect.

    ``texts`` has text_key, digest, doc_id and bands.
    """
    keys = _in_company(table_keys(texts, bands))
    candidates = texts.drop("bands").join(keys.select("text_key").distinct(), "text_key", "left_semi")
    sets = full_sets(docs, written(candidates, "candidates"), size)
    able = 100 * F.col("shared") >= percent * F.col("n")
    bounds = written(_shared_sizes(sets).filter(able), "bounds")
    # once more among those alone, as what they shared with the others does not count
    bounds = written(_spread(sets.join(bounds.select("text_key"), "text_key", "left_semi")).filter(able), "bounds")
    entry = F.struct("text_key", "n", "shared", "spread")
    members = written(
        _in_company(keys.join(bounds.select("text_key"), "text_key", "left_semi"))
        .join(bounds.drop("found"), "text_key").select("key", entry.alias("text")), "entries",
    )
    # the text whose shingles most others have stands in the middle of a group of edited copies
    centres = written(
        members.groupBy("key").agg(
            F.max_by("text", F.struct("text.spread", "text.text_key")).alias("centre")
        ), "centres",
    )
    star = members.join(centres, "key").filter(
        (F.col("text.text_key") != F.col("centre.text_key")) & _may_link(F.col("text"), F.col("centre"), percent)
    ).select(F.col("centre.text_key").alias("a"), F.col("text.text_key").alias("b")).distinct()
    spokes = written(measured(written(star, "star"), sets, percent), "spokes")
    first = spokes.filter("linked").select("a", "b")

    group = written(components(first).withColumnRenamed("node", "text_key"), "groups")
    grouped = written(members.join(group, members["text.text_key"] == group["text_key"], "left").select(
        "key", "text", F.coalesce("component", "text.text_key").alias("component")
    ), "grouped")
    mixed = written(
        grouped.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high").select("key"), "mixed",
    )
    # buckets with one centre are taken together, and those with centres that are much alike, so that a text
    # comes up about once and not in every table
    hubs = written(centres.join(mixed, "key", "left_semi"), "mixed_hubs")
    shared = bounds.select("text_key", "found")
    into = _folded(hubs, members, shared)
    kept_as = hubs.select("key", F.col("centre.text_key").alias("hub")).join(into, "hub", "left").select(
        "key", F.coalesce("into", "hub").alias("cluster")
    )
    clustered = written(
        grouped.join(written(kept_as, "clusters"), "key")
        .select("cluster", "text.text_key", "text.n", "text.shared", "text.spread", "component").distinct(), "clustered",
    )
    certain, more = links_and_pairs(clustered, shared, percent)
    tested = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    untested = written(more, "more").join(written(tested, "tested"), ["a", "b"], "left_anti")
    late = measured(written(untested.select("a", "b"), "untested"), sets, percent)
    return first.union(certain).union(late.filter("linked").select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text).

    Texts are linked when their sets of distinct ``size``-word shingles have a similarity of at least
    ``percent``; component_id is the least doc_id that links lead to, and kept marks that document. A null,
    empty or blank text has no shingles and no links. A row with a null doc_id has no links, a null
    component, and is kept. Rows that repeat a doc_id are one node: they share a component, and each is
    kept if the node is. Only doc_id and text are looked at.
    """
    bands = bands_for(percent)
    rows = written(described(docs, size, bands), "described")
    nodes = rows.filter("doc_id is not null and digest is not null")
    # a number of eight bytes stands for a text from here on
    texts = written(
        nodes.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
        .withColumn("text_key", F.monotonically_increasing_id()), "texts",
    )
    alike = links_of(docs, texts, size, percent, bands)
    head = texts.select("text_key", F.col("doc_id").alias("head"))
    ends = alike.join(head.toDF("a", "head_a"), "a").join(head.toDF("b", "head_b"), "b").select("head_a", "head_b")
    heads = texts.select("digest", F.col("doc_id").alias("head"))
    copies = nodes.select("digest", "doc_id").distinct().join(heads, "digest").filter("doc_id != head")
    found = components(ends.toDF("a", "b").union(copies.select("head", "doc_id")))
    return rows.join(found.toDF("doc_id", "component"), "doc_id", "left").select(
        "doc_id", "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _row_key() -> Column:
    """128 bits for doc_id and text of a row; a null is told from any value."""
    text = F.col("text").cast("string")
    known = F.concat(
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")),
        F.when(text.isNull(), "-").otherwise("="), F.coalesce(text, F.lit("")),
    )
    return F.unhex(F.md5(known))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, in all their columns, without those whose text is a copy of a kept one.

    Texts are linked as in :func:`near_duplicates`, but whatever ids they have: an id with two texts links
    nothing and loses neither. Of the rows with an id the one with the least stays in each group of texts.
    Rows with a null doc_id give way only to one another, so one of them stays too. Blank texts have no
    group: rows that repeat an id and such a text are thinned to one, and those with a null doc_id stay.
    """
    bands = bands_for(percent)
    none, number = F.col("doc_id").isNull(), F.col("doc_id").cast("long")
    # a number from the row stands for its id here; texts that share one are told apart by their digests
    known = docs.select(
        F.xxhash64(_row_key()).alias("doc_id"), "text", _row_key().alias("row"),
        none.alias("none"), F.coalesce(number, F.lit(0).cast("long")).alias("id"),
    )
    rows = written(described(known, size, bands, ["row", "none", "id"]), "described")
    nodes = rows.filter("digest is not null")
    texts = written(
        nodes.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
        .withColumn("text_key", F.monotonically_increasing_id()), "texts",
    )
    group = components(links_of(known, texts, size, percent, bands)).toDF("text_key", "component")
    groups = texts.select("digest", "text_key").join(group, "text_key", "left").select(
        "digest", F.coalesce("component", "text_key").alias("group")
    )
    firsts = nodes.groupBy("digest", "none").agg(F.min(F.struct("id", "row")).alias("first"))
    stays = firsts.join(groups, "digest").groupBy("group", "none").agg(F.min("first").alias("first"))
    stays = written(stays.select(F.col("first.row").alias("_row")), "stays")
    dropped = nodes.select(F.col("row").alias("_row")).distinct().join(stays, "_row", "left_anti")
    keyed = docs.withColumn("_row", _row_key())
    kept = join_by_key(keyed, written(dropped, "dropped"), ["_row"], "left_anti", ["text"])
    repeated = rows.filter("digest is not null or not none").groupBy(F.col("row").alias("_row")).agg(
        F.count("*").alias("n")
    ).filter("n > 1")
    repeated = written(repeated.select("_row"), "repeated")
    if repeated.isEmpty():
        return kept.drop("_row")
    again = join_by_key(kept, repeated, ["_row"], "left_semi", ["text"]).dropDuplicates(["_row"])
    return join_by_key(kept, repeated, ["_row"], "left_anti", ["text"]).union(again).drop("_row")
