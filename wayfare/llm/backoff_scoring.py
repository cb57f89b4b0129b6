"""Log-probabilities of texts by a weighted backoff automaton of smoothed n-grams.

A state of the automaton is a context. Its arc for a token that followed it in training has the weight of
the smoothed n-gram; for any other token the failure arc, weighted with what smoothing left over, leads to
the context without its first token. The state without context has an arc for every token, known or not.

    p(w | context) = (count(context w) + PRIOR * p(w | shorter context)) / (count(context) + PRIOR)
    p(w) = (count(w) + 1) / (tokens + kinds + 1)

The automaton of a large corpus fits no machine. Texts are taken in blocks, and each block asks for just
the states and arcs its own texts pass: it lists its distinct n-grams with their training counts, the lists
are added up over the corpus by ranges of n-gram hashes, and each block gets its totals back. In a block
one traversal from left to right carries the state from token to token and adds up weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.session import written

ORDER = 2
PRIOR = 500.0
BLOCK_TOKENS = 1_200_000
SHARD_GRAMS = 2_500_000
FOLDS = 7
HELD_OUT_FOLD = 2

FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
END = b""


def held_out(doc_id: Column) -> Column:
    """Whether the unsigned crc32 of the id as text falls into the fold that is not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=kind)


BLOCKS = (
    "block long, n_tokens long, doc_ids array<long>, held array<boolean>, lengths array<long>, "
    "tokens binary, words binary"
)


def blocks_of(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole texts: ids, lengths in tokens, and every token as a number into the block's words."""
    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = 0

        def block() -> pd.DataFrame:
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in codes], dtype=np.uint64)
            return pd.DataFrame({
                "block": [(TaskContext.get().partitionId() << 32) + made], "n_tokens": [size], "doc_ids": [ids],
                "held": [held], "lengths": [[len(t) for t in texts]], "tokens": [_pack(np.concatenate(texts))],
                "words": [hashes.tobytes()],
            })

        codes, size, ids, held, texts = _Codes({END: 0}), 0, [], [], []
        for batch in batches:
            for doc_id, out, text in zip(batch["doc_id"], batch["held"], batch["text"]):
                words = (text or "").encode().lower().split()
                words.append(END)
                texts.append(np.fromiter(map(codes.__getitem__, words), dtype=np.int32, count=len(words)))
                ids.append(None if pd.isna(doc_id) else int(doc_id)), held.append(bool(out))
                size += len(words)
                if size >= block_tokens:
                    yield block()
                    made += 1
                    codes, size, ids, held, texts = _Codes({END: 0}), 0, [], [], []
        if texts:
            yield block()

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out(F.col("doc_id")).alias("held"))
    return narrow.mapInPandas(gather, BLOCKS)


class _Block:
    """The n-grams of a block: per order, each token's n-gram as a place in the sorted distinct hashes."""

    def __init__(self, row, order: int):
        self.tokens = _unpack(row["tokens"], "i4")
        words = np.frombuffer(row["words"], dtype=np.uint64)
        self.lengths = np.asarray(row["lengths"], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.learned = np.repeat(~np.asarray(row["held"], dtype=bool), self.lengths)
        place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        single = words[self.tokens]
        self.grams, self.at, self.has = [], [], []
        hashes = single
        for n in range(1, order + 1):
            if n > 1:
                before = np.roll(hashes, 1)
                if n == 2:
                    before[self.starts] = words[0]
                hashes = (before * FIRST + single) ^ np.uint64(n)
                hashes = (hashes ^ (hashes >> np.uint64(29))) * SECOND
                hashes ^= hashes >> np.uint64(32)
            has = place >= n - 2
            grams, at = np.unique(hashes, return_inverse=True)
            self.grams.append(grams), self.at.append(at), self.has.append(has)
        self.end = int(np.searchsorted(self.grams[0], words[0]))

    def learned_counts(self, n: int) -> np.ndarray:
        use = self.learned & self.has[n]
        return np.bincount(self.at[n][use], minlength=len(self.grams[n]))


def gram_lists(blocks: DataFrame, order: int, shards: int) -> DataFrame:
    """(shard, block, n, grams, counts): each block's distinct n-grams, cut into ranges of their hashes."""
    limits = np.array([(s << 64) // shards for s in range(1, shards)], dtype=np.uint64)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                block = _Block(row, order)
                for n in range(order):
                    grams, counts = block.grams[n], block.learned_counts(n)
                    cuts = np.concatenate([[0], np.searchsorted(grams, limits), [len(grams)]])
                    full = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
                    yield pd.DataFrame({
                        "shard": full, "block": row["block"], "n": n,
                        "grams": [grams[cuts[s]:cuts[s + 1]].tobytes() for s in full],
                        "counts": [_pack(counts[cuts[s]:cuts[s + 1]]) for s in full],
                    })

    return blocks.select("block", "held", "lengths", "tokens", "words").mapInPandas(
        spread, "shard int, block long, n int, grams binary, counts binary"
    )


def corpus_counts(lists: DataFrame) -> DataFrame:
    """(block, n, shard, totals, kinds, tokens): the corpus counts of each list, and of each shard's single words."""
    def add(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for n, rows in group.groupby("n"):
            grams = [np.frombuffer(g, dtype=np.uint64) for g in rows["grams"]]
            distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
            given = np.concatenate([_unpack(c, "i8") for c in rows["counts"]])
            totals = np.zeros(len(distinct), dtype=np.int64)
            np.add.at(totals, at, given)
            cuts = np.cumsum([0] + [len(g) for g in grams])
            for i, block in enumerate(rows["block"]):
                first = i == 0 and n == 0
                out.append((
                    block, n, rows["shard"].iloc[0], _pack(totals[at[cuts[i]:cuts[i + 1]]]),
                    int((totals > 0).sum()) if first else 0, int(totals.sum()) if first else 0,
                ))
        return pd.DataFrame(out, columns=["block", "n", "shard", "totals", "kinds", "tokens"])

    return lists.groupBy("shard").applyInPandas(
        add, "block long, n int, shard int, totals binary, kinds long, tokens long"
    )


def traversed(row, counts: pd.DataFrame, order: int, tokens: int, kinds: int, prior: float) -> pd.DataFrame:
    """Scores of a block's texts, given the corpus counts of its n-grams."""
    block = _Block(row, order)
    seen = []
    for n in range(order):
        own = counts[counts["n"] == n].sort_values("shard")
        seen.append(np.concatenate([_unpack(t, "i8") for t in own["totals"]]))
    single = seen[0][block.at[0]]
    base = np.log10((single + 1.0) / (tokens + kinds + 1.0))
    weight, state = 10.0 ** base, seen[0]
    for n in range(1, order):
        # the state after the token before; texts start in the state that an end leads to
        context = np.roll(state[block.at[n - 1]], 1)
        if n == 1:
            context[block.starts] = seen[0][block.end]
        arc = seen[n][block.at[n]]
        failure = prior / (context + prior)
        longer = np.where(arc > 0, (arc + prior * weight) / (context + prior), failure * weight)
        weight = np.where(block.has[n], longer, weight)
        state = seen[n]
    add = lambda x: np.add.reduceat(x, block.starts)
    return pd.DataFrame({
        "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"), "held_out": np.asarray(row["held"], dtype=bool),
        "n_tokens": block.lengths, "n_known": add((single > 0).astype(np.int64)),
        "train_tokens": np.full(len(block.lengths), tokens), "base_score": add(base),
        "score": add(np.log10(weight)),
    })


def scored(docs: DataFrame, order: int = ORDER, prior: float = PRIOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` (doc_id, text).

    Scores are sums of log10 over the words, A-Z in lower case, and a closing end. score is the automaton's
    and base_score that of single words. A null text counts as empty: its one token is the end. Rows with a
    null doc_id are scored and learned from; repeated rows are learned from once each. An empty table gives
    no rows. Other columns are not looked at. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    blocks = written(blocks_of(docs, block_tokens), "blocks")
    grams = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0] * order
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(grams / SHARD_GRAMS))
    counts = written(corpus_counts(gram_lists(blocks, order, shards)), "counts")
    learned = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    tokens, kinds = learned

    def score(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        return traversed(own.iloc[0], found, order, tokens, kinds, prior)

    return blocks.groupBy("block").cogroup(counts.select("block", "n", "shard", "totals").groupBy("block")).applyInPandas(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
