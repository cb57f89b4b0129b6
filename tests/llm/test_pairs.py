"""The similarity join of embeddings and near-duplicate texts."""

import math
import random

import numpy as np
import pytest
from cases import AWKWARD, SF, components, documents, near_duplicates, shingle_set
from compare import duckdb_over, duckdb_rows, spark_rows
from pyspark.sql import functions as F

from wayfare.llm import embedding_join, minhash_dedup, queries
from wayfare.llm.common import components as spark_components
from wayfare.llm.common import ranked
from wayfare.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize("name", sorted(queries.SQL))
@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_query_matches_oracle(spark, name, sf):
    columns, rows = spark_rows(queries.QUERIES[name](spark, sf))
    expected_columns, expected = duckdb_rows(duckdb_over(sf), queries.SQL[name])
    assert columns == expected_columns
    assert rows == expected


def brute_vectors(rows, cosine):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v, dtype=float) / np.linalg.norm(v) if i is not None and usable(v) else None for i, v in rows]
    links, count = [], [0] * len(rows)
    for i, x in enumerate(units):
        for j, y in enumerate(units):
            if i != j and x is not None and y is not None and len(x) == len(y) and float(x @ y) >= cosine:
                count[i] += 1
                links.append((rows[i][0], rows[j][0]))
    least = components({i for i, _ in rows if i is not None}, links)
    return sorted(
        ((i, n, least.get(i), least.get(i, i) == i) for (i, _), n in zip(rows, count)), key=str,
    )


def vectors(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("cell", "cid", "head", "component", "node", "a", "n_links"):
        table = table.withColumn(name, F.lit("x"))
    return table


def result(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def test_join_of_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.2]), (4, [0.0, 1.0]), (4, [0.0, 1.0]), (5, None), (6, []),
        (7, [0.0, 0.0]), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (None, [1.0, 0.0]),
        (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.1, 0.0]), (13, [-1.0, 0.0]),
    ]
    assert result(embedding_join.linked(vectors(spark, rows))) == brute_vectors(rows, 0.95)


def test_join_of_no_vectors(spark):
    assert embedding_join.linked(vectors(spark, [])).collect() == []


def test_join_over_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "CELL_ROWS", 20)
    monkeypatch.setattr(embedding_join, "BLOCK_ROWS", 16)
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(12, 8))
    sizes = [90] + [10] * 11  # one dense group
    rows = []
    for centre, n in zip(centres, sizes):
        for _ in range(n):
            rows.append((len(rows), (centre + draw.normal(size=8) * 0.22).astype(np.float32).tolist()))
    rows += [(len(rows) + k, draw.normal(size=8).astype(np.float32).tolist()) for k in range(60)]
    expected = brute_vectors(rows, 0.95)
    assert sum(r[1] for r in expected) > 500
    assert result(embedding_join.linked(vectors(spark, rows))) == expected


@pytest.mark.parametrize("kind", ["float", "double"])
def test_join_of_scaled_copies_over_many_cells(spark, monkeypatch, kind):
    """Several pivots are copies of one vector, equal in direction up to rounding and different in length."""
    monkeypatch.setattr(embedding_join, "CELL_ROWS", 10)
    monkeypatch.setattr(embedding_join, "BLOCK_ROWS", 16)
    draw = np.random.default_rng(4)
    hot = draw.normal(size=8)
    copies = hot * draw.uniform(1, 9, size=(150, 1))
    around = hot + draw.normal(size=(60, 8)) * 0.25
    number = np.float32 if kind == "float" else np.float64
    rows = [(i, x.tolist()) for i, x in enumerate(
        np.concatenate([copies, around, draw.normal(size=(40, 8))]).astype(number))]
    expected = brute_vectors(rows, 0.95)
    assert sum(r[1] for r in expected) > 150 * 149
    assert result(embedding_join.linked(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"))) == expected


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(7, 7), (500, 500)]
    found = spark_components(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, found.collect())) == {k: v for k, v in components(
        {x for link in links for x in link if x != 500}, links[:-1]).items()}


def test_ranks_of_hot_keys_and_equal_rows(spark):
    rows = [(0, i // 3) for i in range(3000)] + [(k, 1) for k in range(1, 40)]
    got = ranked(spark.createDataFrame(rows, "k long, o long"), ["k"], ["o"]).collect()
    by_key = {}
    for r in sorted(got, key=lambda r: (r["k"], r["rank"])):
        by_key.setdefault(r["k"], []).append((r["o"], r["rank"]))
    assert len(got) == len(rows)
    for places in by_key.values():
        assert [r for _, r in places] == list(range(len(places)))
        assert [o for o, _ in places] == sorted(o for o, _ in places)


def check_duplicates(spark, rows, size, percent):
    got = minhash_dedup.near_duplicates(documents(spark, rows), size, percent).collect()
    least = near_duplicates(rows, size, percent)
    assert sorted((r["doc_id"], r["n_shingles"]) for r in got if r["doc_id"] is not None) == sorted(
        (d, len(shingle_set(t, size))) for d, t in rows if d is not None)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == least
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    return got


def test_duplicates_of_awkward_documents(spark):
    assert len(check_duplicates(spark, AWKWARD, 3, 85)) == len(AWKWARD)


def test_duplicates_of_no_documents(spark):
    assert check_duplicates(spark, [], 3, 85) == []


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_edited_copies_of_all_degrees(spark, size, percent):
    """Copies with few and many edits, copies of copies, and texts that share a passage."""
    draw = random.Random(3)
    vocabulary = [f"v{i}" for i in range(400)]
    base = draw.choices(vocabulary, k=200)

    def edited(words, n):
        words = list(words)
        for at in draw.sample(range(len(words)), n):
            words[at] = f"e{draw.random()}"
        return words

    texts = [base] + [edited(base, draw.randrange(1, 14)) for _ in range(150)]
    texts += [edited(draw.choice(texts[1:60]), draw.randrange(1, 6)) for _ in range(60)]
    texts += [draw.choices(vocabulary, k=80) + base[:120] for _ in range(60)]
    texts += [t[: len(t) - draw.randrange(30)] for t in texts[:50]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    draw.shuffle(rows)
    got = check_duplicates(spark, rows, size, percent)
    assert len({r["component_id"] for r in got}) < len(rows) - 30


def test_texts_of_a_large_group_come_up_about_once(spark, monkeypatch):
    """Copies with edits of their own meet in many buckets, whose centres are much alike."""
    draw = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for doc_id in range(300):
        words = list(base)
        for at in draw.sample(range(len(words)), 5):
            words[at] = f"x{doc_id}_{at}"
        rows.append((doc_id, " ".join(words)))
    counts = {}

    def counted(df, name):
        df = minhash_dedup_written(df, name)
        if name == "clustered":
            counts["rows"], counts["texts"] = df.count(), df.select("text_key").distinct().count()
        return df

    minhash_dedup_written = minhash_dedup.written
    monkeypatch.setattr(minhash_dedup, "written", counted)
    check_duplicates(spark, rows, 3, 85)
    assert counts["texts"] > 200
    # four times as many where each centre had a cluster of its own
    assert counts["rows"] < 1.5 * counts["texts"]


def test_thinned_documents_keep_their_columns(spark):
    docs = documents(spark, AWKWARD)
    kept = minhash_dedup.deduplicated(docs, 3, 85)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(range(1, 5)) <= set(ids) and 5 not in ids and 9 not in ids
    assert ids.count(10) == 1 and ids.count(None) == 2


def test_thinning_links_texts_and_not_ids(spark):
    """Ids with several texts, ids beyond the precision of doubles, and rows without an id."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    big = 2**53 + 1
    rows = [
        (1, a), (2, a + " end"), (2, b), (3, b + " end"), (4, c), (4, c), (4, c + " end"), (big, d), (big + 1, d),
        (None, a), (None, a), (None, a + " end"), (None, "only here " + c[::-1]), (None, "only here " + c[::-1]),
        (6, ""), (6, ""), (None, ""), (None, ""),
    ]
    kept = [tuple(r) for r in minhash_dedup.deduplicated(documents(spark, rows), 5, 80).select("doc_id", "text").collect()]
    fourth = [t for i, t in kept if i == 4]
    assert len(fourth) == 1 and fourth[0] in (c, c + " end")
    unknown = [t for i, t in kept if i is None]
    assert len([t for t in unknown if t in (a, a + " end")]) == 1
    assert unknown.count("only here " + c[::-1]) == 1 and unknown.count("") == 2 and len(unknown) == 4
    assert sorted((i, t) for i, t in kept if i not in (None, 4)) == [(1, a), (2, b), (6, ""), (big, d)]


def test_bands_find_pairs_at_the_limit():
    for percent in (80, 85, 95):
        bands = minhash_dedup.bands_for(percent)
        assert 2 * (1 - (percent / 100) ** minhash_dedup.ROWS) ** bands <= minhash_dedup.MISSED
