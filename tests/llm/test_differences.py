"""Links within groups of sets, compared with all pairs."""

import random
from collections import Counter

import pytest
from cases import components

from wayfare.llm import difference_sets
from wayfare.llm.difference_sets import links_and_pairs
from wayfare.llm.minhash_dedup import measured
from wayfare.session import ship_package, written

SHAPE = "cluster long, text_key long, n long, shared long, component long"


def connected(spark, clusters, percent):
    """Components from the links found, those of all pairs, and how many pairs were to be compared."""
    rows, found, expected = [], {}, set()
    for cluster, sets in clusters.items():
        for key, elements in sets.items():
            rows.append((cluster, key, len(elements), len(elements), key))
            found[key] = elements
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    expected.add((a, b))
    sets = spark.createDataFrame([(k, sorted(v)) for k, v in found.items()], "text_key long, found array<long>")
    links, pairs = links_and_pairs(spark.createDataFrame(rows, SHAPE), sets, percent)
    certain = [(r["a"], r["b"]) for r in links.collect()]
    assert all((min(x), max(x)) in expected for x in certain)
    late = [(r["a"], r["b"]) for r in measured(pairs, sets, percent).filter("linked").collect()]
    assert all((min(x), max(x)) in expected for x in late)
    return components(found, certain + late), components(found, expected), pairs.count()


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def edited(draw, elements, n, new):
    kept = sorted(elements)
    draw.shuffle(kept)
    return set(kept[n:]) | {next(new) for _ in range(n)}


def test_a_large_group_just_below_the_limit(spark):
    """600 copies, none similar enough to any other but for 40 that were copied once more."""
    draw, new = random.Random(1), iter(range(10_000, 10_000_000))
    base = set(range(200))
    sets = {k: edited(draw, base, 24, new) for k in range(600)}
    sets |= {600 + k: edited(draw, sets[k * 15], 6, new) for k in range(40)}
    got, expected, compared = connected(spark, {1: sets}, 80)
    assert got == expected
    assert len(set(got.values())) == 600
    assert compared < 10 * len(sets)


@pytest.mark.parametrize("few", [2, 8])
def test_copies_of_copies_over_several_levels(spark, monkeypatch, few):
    """Edits that families share are a middle of their own; some sets are in two clusters."""
    monkeypatch.setattr(difference_sets, "FEW", few)
    draw, new = random.Random(2), iter(range(10_000, 10_000_000))
    base = set(range(100))
    sets = {}
    for _ in range(6):
        family = edited(draw, base, draw.randrange(8, 16), new)
        for _ in range(5):
            branch = edited(draw, family, draw.randrange(0, 12), new)
            for _ in range(5):
                sets[len(sets)] = edited(draw, branch, draw.randrange(0, 9), new)
    keys = list(sets)
    second = {k: sets[k] for k in draw.sample(keys, 40)}
    second |= {1000 + k: set(range(50_000, 50_000 + 20 + k)) for k in range(12)}
    got, expected, _ = connected(spark, {1: sets, 2: second}, 85)
    assert got == expected
    assert 6 < len(set(got.values())) < len(got) - 20


def test_small_and_equal_groups_and_none(spark):
    assert connected(spark, {}, 80) == ({}, {}, 0)
    clusters = {1: {1: {1, 2, 3}, 2: {1, 2, 3, 4}, 3: {9}}, 2: {1: {1, 2, 3}}, 3: {k: set(range(30)) for k in range(10, 40)}}
    got, expected, _ = connected(spark, clusters, 75)
    assert got == expected


@pytest.mark.parametrize("alone", [True, False])
def test_edits_of_its_own_leave_a_set_few_elements_to_share(spark, monkeypatch, alone):
    """Sets far from the middle would have to share nearly all that they lack; elements held once may be missing."""
    draw, new = random.Random(3), iter(range(10_000, 10_000_000))
    base = set(range(150))
    sets = {k: edited(draw, base, draw.randrange(2, 24), new) for k in range(300)}
    sets |= {300 + k: edited(draw, sets[k * 10], draw.randrange(0, 6), new) for k in range(30)}
    holders = Counter(x for elements in sets.values() for x in elements)
    found = {k: sorted(x for x in v if alone or holders[x] > 1) for k, v in sets.items()}
    rows = spark.createDataFrame([(1, k, len(v), sum(holders[x] > 1 for x in v), k) for k, v in sets.items()], SHAPE)
    went_on = []

    def counted(df, name):
        df = written(df, name)
        if name == "rarest":
            went_on.append(df.count())
        return df

    monkeypatch.setattr(difference_sets, "written", counted)
    links, pairs = links_and_pairs(rows, spark.createDataFrame(list(found.items()), "text_key long, found array<long>"), 85)
    full = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "text_key long, found array<long>")
    linked = [(r.a, r.b) for r in links.union(measured(pairs, full, 85).filter("linked").select("a", "b")).collect()]
    alike = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    assert components(sets, linked) == components(sets, alike)
    assert {(min(x), max(x)) for x in linked} <= set(alike)
    # 18,582 by the number of shared elements alone
    assert sum(went_on) < 10_000


def exploded(df):
    """Rows that the explode steps of ``df`` make."""
    spark = df.sparkSession
    ways, rows = [df._jdf.queryExecution().optimizedPlan()], 0
    while ways:
        node = ways.pop()
        ways += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Generate":
            rows += spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node).count()
    return rows


def test_middles_are_found_from_differences_and_not_whole_sets(spark, monkeypatch):
    """Sets whose start is one with many elements of its own; families lack or have the same elements."""
    draw, new = random.Random(4), iter(range(10_000, 10_000_000))
    base = set(range(300))
    sets = {0: edited(draw, base, 30, new)}
    for _ in range(10):
        family = edited(draw, base, 20, new)
        for _ in range(12):
            sets[len(sets)] = edited(draw, family, draw.randrange(4, 14), new)
    made = []

    def counted(df, name):
        made.append(exploded(df))
        return written(df, name)

    monkeypatch.setattr(difference_sets, "written", counted)
    rows = spark.createDataFrame(
        [(1, k, len(v), len(v), k, float(k == 0)) for k, v in sets.items()], f"{SHAPE}, spread double"
    )
    full = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "text_key long, found array<long>")
    links, pairs = links_and_pairs(rows, full, 88)
    linked = [(r.a, r.b) for r in links.union(measured(pairs, full, 88).filter("linked").select("a", "b")).collect()]
    alike = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= 88 * len(sets[a] | sets[b])
    ]
    assert len(alike) > 100
    assert components(sets, linked) == components(sets, alike)
    assert {(min(x), max(x)) for x in linked} <= set(alike)
    # 36,300 elements of whole sets on the first level and 234,000 on the next, 13,292 and 43,454 differences
    assert 0 < max(made) < 60_000
