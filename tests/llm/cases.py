"""Small tables with the awkward rows that every operator must take, and plain versions to compare with."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# names that operators use inside, or that could clash with their results
CLASHING = ["rank", "key", "a", "b", "node", "component", "length", "shard", "arc", "fold", "score", "text_key"]

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in CLASHING]
)

LONG = " ".join(f"w{i % 977}q{i // 977}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while " + " ".join(f"word{i}" for i in range(60))

AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "one two"), (7, "one two"), (8, LONG), (9, LONG),
    (10, PROSE), (10, PROSE), (11, PROSE + " end"), (12, "x" * 5_000), (None, PROSE), (None, None), (13, "é ß 漢字 ́z"),
    (14, "### $$$ %%%"), (15, "a\na\na\nb " * 30), (16, "\x0b\x0c\x1c\x85  　"), (17, "<|endoftext|> text <|endoftext|>"),
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(*r, *(["x"] * len(CLASHING))) for r in rows], DOCUMENTS)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text: str | None, size: int) -> set:
    w = words(lower(text or ""))
    return {tuple(w)} - {()} if len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in parent}


def near_duplicates(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id -> least doc_id of its component, by comparing all pairs that share a shingle."""
    sets = [(d, shingle_set(t, size)) for d, t in rows if d is not None]
    holders = defaultdict(set)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(i)
    links = []
    for i, (d, s) in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            e, t = sets[j]
            if 100 * len(s & t) >= percent * len(s | t):
                links.append((d, e))
    return components({d for d, _ in sets}, links)
