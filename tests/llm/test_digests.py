"""Duplicates by digest, the manifest and the trie of conversations against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from cases import AWKWARD, CLASHING, SF, documents, words
from compare import duckdb_over, duckdb_rows, spark_rows
from pyspark.sql import functions as F

from wayfare.llm import conversation_trie, digest_merge, merkle_manifest, queries
from wayfare.session import ship_package
from wayfare.sources.tables import table


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_digest_merge", "op12_merkle_manifest", "op13_prefix_trie"])
def test_queries_equal_sql(spark, name):
    sf = SF.replace("0.001", "0.01")
    assert spark_rows(queries.QUERIES[name](spark, sf)) == duckdb_rows(duckdb_over(sf), queries.SQL[name])


# duplicates

def plain_duplicates(rows, largest):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        kept = ids.index(keep)
        out += [(d, keep, len(ids), i == kept, h(text)) for i, d in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("bits", [1, 2, 8])
@pytest.mark.parametrize("rows", [AWKWARD, [], AWKWARD * 30], ids=["awkward", "none", "many"])
def test_exact_duplicates(spark, rows, bits, keep):
    got = digest_merge.exact_duplicates(documents(spark, rows), keep, bits)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_duplicates(rows, keep == "largest")


def test_a_position_hears_from_those_that_differ_in_a_rounds_bits_only():
    assert digest_merge.rounds_for(7) == [(4, 7), (1, 4), (0, 1)]
    entries = digest_merge.merged(random_entries(500, 400))
    for low, high in digest_merge.rounds_for(7):
        sent = digest_merge._sent(entries, 0b1010101, 7, (low, high))
        outside = ~((1 << high) - (1 << low))
        assert {to & outside for to in sent["at"]} == {0b1010101 & outside}
        assert sum(len(b) for b in sent["entries"]) == entries.nbytes


def random_entries(n, distinct):
    rnd = np.random.default_rng(n)
    e = np.zeros(n, dtype=digest_merge.ENTRY)
    which = rnd.integers(0, distinct, n)
    e["digest"] = [hashlib.sha256(str(w).encode()).digest() for w in which]
    e["check"], e["rank"], e["place"], e["n"] = which, rnd.integers(-50, 50, n), np.arange(n), 1
    return e


@pytest.mark.parametrize("limit", [1, 5, 10_000])
def test_runs_are_merged_as_they_come(monkeypatch, limit):
    monkeypatch.setattr(digest_merge, "MERGE_ENTRIES", limit)
    entries = random_entries(900, 300)
    blocks = []
    for at, part in ((3, entries[:600]), (9, entries[600:])):
        for run in np.array_split(part, 5):
            run = digest_merge.merged(run)
            blocks += [(at, run[i:i + 1].tobytes()[:32], run[i:i + 7].tobytes()) for i in range(0, len(run), 7)]
    blocks = pd.DataFrame(sorted(blocks), columns=["at", "least", "entries"])
    batches = [blocks[i:i + 4] for i in range(0, len(blocks), 4)]
    got = defaultdict(list)
    for at, part in digest_merge._merging(iter(batches)):
        got[at].append(part)
    for at, part in ((3, entries[:600]), (9, entries[600:])):
        assert np.concatenate(got[at]).tobytes() == digest_merge.merged(part).tobytes()


def test_equal_digests_of_unequal_texts_stay_apart():
    e = random_entries(4, 1)
    e["check"] = [1, 2, 1, 2]
    assert digest_merge.merged(e)["n"].tolist() == [2, 2]


# manifest

LEAF_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, " + ", ".join(
    f"{name} string" for name in (*(c for c in CLASHING if c != "length"), "digest", "tree", "size", "path", "index")
)


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path_of(levels, i):
    path = []
    for level in levels[:-1]:
        first = i // 8 * 8
        run = level[first:first + 8]
        path.append((run[:i - first], run[i - first + 1:]))
        i //= 8
    return path


def plain_manifest(rows):
    out = []
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[2] == lang), key=lambda x: x[:3])
        trees[lang] = mine, levels_of([x[2] for x in mine])
    top = levels_of([trees[lang][1][-1][0] for lang in langs])
    for place, lang in enumerate(langs):
        mine, levels = trees[lang]
        for i, (_, _, digest, r) in enumerate(mine):
            path = path_of(levels, i) + path_of(top, place)
            folded = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                folded = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            for before, after in path:
                folded = h("".join([*before, folded, *after]))
            root = top[-1][0]
            proof = h("".join("".join(before + after) for before, after in path))
            out.append((r[0], digest, levels[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def leaves(n, langs, seed=1):
    rnd = random.Random(seed)
    return [
        (rnd.choice([None, rnd.randint(0, n)]) if rnd.random() < 0.2 else i, rnd.choice([None, "", "s"]),
         rnd.choice(langs), rnd.choice([None, i]), rnd.choice([None, "", "Abc É", "x y Z" * i]))
        for i in range(n)
    ]


@pytest.mark.parametrize("rows", [
    [], [(1, None, None, None, None)], leaves(8, ["a"]), leaves(9, [None]), leaves(66, ["a", "b", None, ""]),
    leaves(600, ["a", None]), leaves(40, [str(i) for i in range(100)]), [(1, "a", "b", 2, "T")] * 70,
], ids=["none", "one", "one run", "nine", "four languages", "deep", "many languages", "repeated"])
def test_manifest(spark, rows):
    extra = LEAF_SCHEMA.count(",") - 4
    docs = spark.createDataFrame([(*r, *["x"] * extra) for r in rows], LEAF_SCHEMA)
    got = merkle_manifest.manifest(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_manifest(rows)


def test_a_store_has_a_record_per_digest(spark):
    rows = spark.createDataFrame([("t", 64, i, bytes(32)) for i in range(64)], "tree string, size long, rank long, digest binary")
    trees = merkle_manifest.forest(rows)
    assert [level.count() for level in trees.levels] == [8, 1]
    assert merkle_manifest._store(trees.levels[0]).count() == 1


# trie

TURNS = "conv_id long, turn long, role string, text string, " + ", ".join(
    f"{name} string" for name in (*CLASHING, "parent", "i", "k", "start", "base", "words", "last", "after", "numbers")
)


def plain_trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, h(f"{len(role)}:{role}{text}"), role, text))
    original = {conv: [t[3:] for t in sorted(turns)] for conv, turns in given.items()}
    rebuilt, members = {}, defaultdict(list)
    for conv, own in original.items():
        n = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = (*original.get(conv - conv % 20, [])[:n], *own[n:])
        for depth in range(len(rebuilt[conv]) + 1):
            members[rebuilt[conv][:depth]].append(conv)
    children, n_leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        value = (len(convs) - 1) * len(words(node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            n_leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += value
    return sorted((
        (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], n_leaves[node],
         saved[node], h(",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))))
        for node, convs in members.items()
    ), key=str)


def conversations(seed, n, lengths, variety, first=0):
    rnd = random.Random(seed)
    rows = []
    for conv in range(first, first + n):
        for turn in range(rnd.choice(lengths)):
            turn = rnd.choice([turn, turn, 0, None]) if rnd.random() < 0.1 else turn
            text = rnd.choice([None, "", "a b", " c\tdd e", "long " * 3][:variety])
            rows.append((conv if rnd.random() > 0.02 else None, turn, rnd.choice(["u", "a", None][:variety]), text))
    return rows


LOW = {"chunk": 2, "shard_turns": 7, "rows_per_task": 9}


@pytest.mark.parametrize("rows, options", [
    ([], {}), ([(5, None, None, None)], {}), ([(None, 1, "a", "b")], {}),
    ([(2**60 + 1, None, None, None), (-3, 1, "a", "b"), (40, 1, "a", "b")], {}),
    (conversations(1, 60, [1, 2, 3, 8], 3), {}),
    (conversations(2, 200, [1, 2, 3, 8], 3), {"shard_turns": 5}),
    (conversations(3, 120, [1, 2, 3, 8, 9, 30], 1), LOW),
    (conversations(4, 80, [1, 4, 5, 6, 40], 2), {**LOW, "chunk": 4}),
    (conversations(5, 3, [400], 1) + conversations(6, 30, [3], 2, 100), {**LOW, "chunk": 16, "shard_turns": 50}),
    ([(c, 1, "u", "same " * 2_000) for c in range(300)] * 2, {"shard_turns": 20}),
], ids=["none", "one", "no id", "far ids", "few", "many shards", "equal, long", "long", "hot", "copies"])
def test_prefix_trie(spark, rows, options):
    extra = TURNS.count(",") - 3
    messages = spark.createDataFrame([(*r, *["x"] * extra) for r in rows], TURNS)
    got = conversation_trie.prefix_trie(messages, **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(rows)


def test_the_median_goes_in_first():
    tree = conversation_trie.TernaryTree()
    tree.insert_balanced([[i] for i in range(1_023)])

    def height(node):
        return 1 + max(height(tree.lower[node]), height(tree.higher[node])) if node else 0

    assert height(tree.heads[0]) == 10
    order, parents = tree.from_root()
    assert sorted(order) == list(range(1_024)) and set(parents) == {0}


def test_lists_of_ids_are_hashed_across_batches():
    batches = [pd.DataFrame(b, columns=["node", "ends"]) for b in (
        [(b"a", "1,2"), (b"a", "3")], [(b"a", "4"), (b"b", "5")], [(b"c", "6")],
    )]
    got = pd.concat(conversation_trie.hashed_ends(iter(batches)))
    assert dict(zip(got["node"], got["ends_sha256"])) == {b"a": h("1,2,3,4"), b"b": h("5"), b"c": h("6")}


def test_given_conversations(spark):
    messages = table(spark, SF, "conversations")
    rows = [tuple(r) for r in messages.select("conv_id", "turn", "role", "text").collect()]
    got = conversation_trie.prefix_trie(messages.withColumn("extra", F.lit(1)), **LOW).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(rows)
