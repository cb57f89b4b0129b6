"""Pairs of similar sets in groups of any size, from what each set differs in from the group's middle.

The middle C of a group has the elements that more than half of its sets have. With D(x) the elements
that are in just one of x and C, sets a and b differ in |D(a)| + |D(b)| - 2 |D(a) & D(b)| elements, and
are similar enough exactly if

    excess(a) + excess(b) <= 2 |D(a) & D(b)|    where    excess(x) = |D(x)| - |x| (100 - P) / (100 + P)

- Where the sum of two excesses is not above zero the sets are linked without a look. So the set with the
  least excess, the hub, has a link to each set whose excess does not outweigh its own.
- Any other pair shares elements of D, and at least one among the rarest of either (a prefix filter). Sets
  that share such an element are a smaller group, to which the same is done again.
- How many must be shared is bounded a second time. Where a set lacks R elements of C, has A others, and
  shares x of the first and y of the second with a similar set, the two have at most n - A + y elements in
  common and at least n + R - x in all, so that P x + 100 y >= P R + 100 A - (100 - P) n. Edits of its own
  thus leave a copy far from the middle next to no choice.

An element of D is one that at most half of the group differ in, so a group of the next level has at most
half as many sets, and there are at most log2 levels. No middle takes a look at whole sets: at first D is taken
from any one set of the group, then from the middle of the group before, and elements of D that more than
half of the group differ in change sides in the middle. Groups of up to ``FEW`` sets are compared pair by
pair. Copies with edits of their own share next to nothing of D, so that a large group of them, however
many are just below the limit, comes to a star and a few small groups. Nothing is capped or left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.session import written

FEW = 8
MEMBER = ("text_key", "n", "shared", "component")


def enough(common: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether sets of sizes ``a`` and ``b`` with ``common`` elements in both are similar enough."""
    return 100 * common >= percent * (a + b - common)


def _several(rows: DataFrame) -> DataFrame:
    """(cluster, members) of clusters that are not yet connected, one of those with equal members."""
    sizes = rows.groupBy("cluster").agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("text_key")).alias("mark"),
        F.bit_xor(F.xxhash64(F.lit(1), F.col("text_key"))).alias("second_mark"),
    ).filter("low < high")
    return sizes.groupBy("members", "mark", "second_mark").agg(F.min("cluster").alias("cluster")).select(
        "cluster", "members"
    )


def _all_pairs(few: DataFrame, percent: int) -> DataFrame:
    """(a, b) of sets in one small cluster that are not connected and may be similar enough."""
    one = few.select("cluster", *(F.col(c).alias(f"one_{c}") for c in MEMBER))
    other = few.select("cluster", *MEMBER)
    return one.join(other, "cluster").filter(
        (F.col("one_text_key") < F.col("text_key")) & (F.col("one_component") != F.col("component"))
        & enough(F.least("one_shared", "shared"), F.col("one_n"), F.col("n"), percent)
    ).select(F.col("one_text_key").alias("a"), F.col("text_key").alias("b"))


def _from_one(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` with own and lacks, elements that the set has and lacks beside one set of its cluster, and n_own.

    That is the one with the greatest spread, which lies near the middle. ``sets`` may lack elements that no
    other set has, and so does own then; n_own counts them.
    """
    found = rows.join(sets, "text_key")
    start = found.groupBy("cluster").agg(F.max_by("text_key", F.struct("spread", "text_key")).alias("text_key"))
    ones = written(start.join(sets, "text_key").select("cluster", F.col("found").alias("one")), "ones")
    lacks = F.array_except("one", "found")
    # n counts all elements of the set, those included that found may lack
    return found.join(ones, "cluster").select(
        "cluster", "members", *MEMBER, F.array_except("found", "one").alias("own"), lacks.alias("lacks"),
        (F.col("n") - F.size("one") + F.size(lacks)).alias("n_own"),
    )


def _differences(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` with own, lacks and n_own beside the middle of their cluster, differs, excess and weight.

    ``rows`` has own, lacks and n_own beside any one set of elements for each cluster. differs has own, then
    lacks. weight is what the elements that the set shares with a similar one weigh at least: an element of
    its own 100, one that it lacks ``percent``. excess is in units of 1 / (100 + percent).
    """
    rows = rows.withColumn("differs", F.concat("own", "lacks"))
    each = rows.select("cluster", "members", F.size("own").alias("owned"), F.posexplode("differs").alias("place", "element"))
    # an element is in the set that all of a cluster are compared with or is not, so all that differ agree
    turned = each.groupBy("cluster", "element").agg(
        F.count("*").alias("differing"), F.first("members").alias("members"),
        F.first(F.col("place") < F.col("owned")).alias("joins"),
    ).filter("2 * differing > members").groupBy("cluster").agg(
        F.collect_list(F.when(F.col("joins"), F.col("element"))).alias("joining"),
        F.collect_list(F.when(~F.col("joins"), F.col("element"))).alias("leaving"),
    )
    none = F.array().cast("array<long>")
    joining, leaving = F.coalesce("joining", none), F.coalesce("leaving", none)
    still_own, left = F.array_except("own", joining), F.array_except(leaving, "lacks")
    n_own = F.col("n_own") - F.size("own") + F.size(still_own) + F.size(left)
    moved = rows.join(written(turned, "turned"), "cluster", "left").select(
        "cluster", *MEMBER, F.concat(still_own, left).alias("own"),
        F.concat(F.array_except("lacks", leaving), F.array_except(joining, "own")).alias("lacks"), n_own.alias("n_own"),
    )
    n_lacks = F.size("lacks").cast("long")
    return moved.withColumn("differs", F.concat("own", "lacks")).withColumn(
        "excess", (100 + percent) * (F.col("n_own") + n_lacks) - (100 - percent) * F.col("n")
    ).withColumn("weight", percent * n_lacks + 100 * F.col("n_own") - (100 - percent) * F.col("n"))


def _rarest(rows: DataFrame, percent: int) -> DataFrame:
    """(cluster, element, members of MEMBER) for the elements of differs of which similar sets share one.

    ``rows`` has need, the least number of elements that the set shares with any it is linked to, and weight,
    the least that these weigh. The most frequent elements that are fewer than need or weigh less are left out.
    Elements only of sets that are connected already are no part of any link to look for, and are left out before.
    """
    each = rows.select(
        "cluster", *MEMBER, "need", "weight", F.size("own").alias("owned"), F.posexplode("differs").alias("place", "element")
    ).withColumn("weighs", F.when(F.col("place") < F.col("owned"), 100).otherwise(percent))
    common = written(
        each.groupBy("cluster", "element").agg(
            F.count("*").alias("holders"), F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low < high").select("cluster", "element", "holders"), "common",
    )
    met = each.join(common, ["cluster", "element"])
    by_rarity = W.partitionBy("cluster", "text_key").orderBy(F.desc("holders"), F.desc("element"))
    # counted from the most frequent one, so that elements left out need not be sorted
    weighed = F.sum("weighs").over(by_rarity.rowsBetween(W.unboundedPreceding, W.currentRow))
    return met.withColumn("_from_end", F.row_number().over(by_rarity)).withColumn("_weighed", weighed).filter(
        "_from_end >= need AND _weighed >= weight"
    ).select("cluster", "element", *MEMBER)


def links_and_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that are certain, and further pairs (a, b) to compare, in all clusters of ``rows``.

    ``rows`` has cluster and, once for each of its sets, text_key, n (its size), shared (how many of its
    elements another set may have) and component (equal for sets that are connected already). Links and
    linked ones among the pairs connect all sets of a cluster that similar ones connect. ``sets`` has
    text_key and found, its distinct elements, of which those that no other set has may be missing. ``rows``
    may have spread, which is greater for sets nearer to the middle.
    """
    links, pairs, differing = [], [], None
    if "spread" not in rows.columns:
        rows = rows.withColumn("spread", F.col("shared") / F.col("n"))
    while True:
        sized = rows.join(written(_several(rows), "clusters"), "cluster")
        pairs.append(written(_all_pairs(sized.filter(F.col("members") <= FEW), percent).distinct(), "pairs"))
        many = written(sized.filter(F.col("members") > FEW), "many")
        if many.isEmpty():
            break
        if differing is None:
            beside = written(_from_one(many, sets), "beside")
        else:
            before = differing.select(F.col("cluster").alias("parent"), "text_key", "own", "lacks", "n_own")
            beside = many.join(before, ["parent", "text_key"])
        differing = written(_differences(beside, percent), "differing")
        hubs = written(
            differing.groupBy("cluster").agg(F.min(F.struct("excess", "text_key", "component")).alias("hub")), "hubs"
        )
        placed = differing.join(hubs, "cluster").withColumn(
            "near", (F.col("text_key") == F.col("hub.text_key")) | (F.col("excess") + F.col("hub.excess") <= 0)
        )
        links.append(written(
            placed.filter((F.col("component") != F.col("hub.component")) & F.col("near"))
            .select(F.col("hub.text_key").alias("a"), F.col("text_key").alias("b")), "certain",
        ))
        # a cluster whose sets are all near its hub has no more links to look for
        least_far = written(
            placed.filter(~F.col("near")).groupBy("cluster").agg(F.min("excess").alias("least_far")), "least_far"
        )
        partner = F.when(F.col("near"), F.col("least_far")).otherwise(F.col("hub.excess"))
        need = F.greatest(F.lit(1), F.ceil((F.col("excess") + partner) / (2.0 * (100 + percent)) - 1e-9))
        left = placed.join(least_far, "cluster").withColumn("need", need).withColumn(
            "component", F.when(F.col("near"), F.col("hub.component")).otherwise(F.col("component"))
        )
        rows = written(
            _rarest(left.filter(F.col("need") <= F.size("differs")), percent).select(
                F.xxhash64("cluster", "element").alias("cluster"), F.col("cluster").alias("parent"), *MEMBER
            ), "rarest",
        )
    spark = rows.sparkSession
    none = spark.createDataFrame([], "a long, b long")
    for found in links:
        none = none.union(found)
    every = pairs[0]
    for found in pairs[1:]:
        every = every.union(found)
    return none, every.distinct()
