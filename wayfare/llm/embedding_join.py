"""Exact similarity join of embeddings by angle, over cells around pivots.

Each vector belongs to the cell of its nearest pivot and visits another cell only where the triangle
inequality on angles leaves room for a link: it must be no further beyond the border between the two
pivots than the angle of the join, and no further from the other pivot than that cell's radius plus this
angle. Cells then join on their own. A pair is looked at once, in the lower one of its cells.

A cell of any size is cut into blocks, and pairs of blocks are the tasks, so a dense cell costs more tasks
but no larger ones. A task returns numbers of links and a spanning forest, never the pairs. Equal vectors
are one vector from the start. Vectors without structure, such as random directions in many dimensions,
have few borders that rule anything out; the join is then exact but compares most pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import components
from wayfare.session import written

CELL_ROWS = 2_048
MOST_PIVOTS = 1_024
BLOCK_ROWS = 4_096
CHUNK_ROWS = 512
# how far a product of two units may be off, and what three such errors make of angles near zero
ROUNDING = 1e-12
SLACK = 5e-6


def usable(embedding: Column) -> Column:
    """Whether a vector has a direction: it has components, all finite, and not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=float) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class _Pivots:
    """Pivots of one dimension, with their numbers, distances and, once known, the radii of their cells."""

    def __init__(self, numbers: list[int], units: np.ndarray):
        self.numbers = np.array(numbers)
        self.units = units
        # from differences, as 2 - 2 * cosine cancels for pivots that point the same way
        self.apart = np.stack([np.linalg.norm(units - unit, axis=1) for unit in units])


def _by_dimension(pivots: list[tuple[int, list[float]]]) -> dict[int, _Pivots]:
    found: dict[int, list[tuple[int, list[float]]]] = {}
    for number, vector in pivots:
        found.setdefault(len(vector), []).append((number, vector))
    return {d: _Pivots([n for n, _ in p], _units(pd.Series([v for _, v in p]))) for d, p in found.items()}


def _same_dimension(batch: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    for dimension, part in batch.groupby(batch["embedding"].map(len), sort=False):
        yield int(dimension), part


def in_cells(classes: DataFrame, pivots: dict[int, _Pivots]) -> DataFrame:
    """``classes`` with cell and angle to its pivot; a dimension without a pivot is one cell of its own."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dimension, part in _same_dimension(batch):
                if dimension not in pivots:
                    yield part.assign(cell=-dimension, angle=0.0)
                    continue
                own = pivots[dimension]
                cosines = _units(part["embedding"]) @ own.units.T
                nearest = cosines.argmax(axis=1)
                angle = np.arccos(np.clip(cosines[np.arange(len(part)), nearest], -1, 1))
                yield part.assign(cell=own.numbers[nearest], angle=angle)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInPandas(place, f"{fields}, cell long, angle double")


def _visits(x: np.ndarray, cells: np.ndarray, own: _Pivots, radii: dict[int, float], angle: float) -> np.ndarray:
    """For each vector and pivot, whether the vector visits that pivot's cell, a lower one than its own."""
    cosines = x @ own.units.T
    at = np.searchsorted(own.numbers, cells)
    beyond = cosines[np.arange(len(x)), at][:, None] - cosines
    radius = np.array([radii.get(int(n), -math.inf) for n in own.numbers])
    near = np.arccos(np.clip(cosines, -1, 1)) <= radius + angle + SLACK
    reach = (math.sin(angle) + SLACK) * own.apart[at] + ROUNDING
    return near & (beyond <= reach) & (own.numbers[None, :] < cells[:, None])


def _visitor_counts(placed: DataFrame, pivots, radii, angle: float) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, int] = {}
        for batch in batches:
            for dimension, part in _same_dimension(batch):
                if dimension in pivots:
                    own = pivots[dimension]
                    seen = _visits(_units(part["embedding"]), part["cell"].to_numpy(), own, radii, angle).sum(axis=0)
                    for number, n in zip(own.numbers, seen):
                        total[int(number)] = total.get(int(number), 0) + int(n)
        yield pd.DataFrame({"cell": list(total), "n": list(total.values())}, dtype="int64")

    return placed.select("embedding", "cell").mapInPandas(count, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")
    )


def block_pairs(placed: DataFrame, pivots, radii, sizes: dict[int, int], visitors: dict[int, int], angle: float):
    """Copies of the vectors for every pair of blocks they take part in: (cell, a, b, side, cid, weight, embedding)."""
    own_blocks = {c: -(-n // BLOCK_ROWS) for c, n in sizes.items()}
    visitor_blocks = {c: -(-n // BLOCK_ROWS) for c, n in visitors.items()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dimension, part in _same_dimension(batch):
                part = part.reset_index(drop=True)
                own = pivots.get(dimension)
                cells = part["cell"].to_numpy()
                spread = part["spread"].to_numpy()
                rows, cell, a, b, side = [], [], [], [], []

                def put(i: int, c: int, left: int, right: int, where: int) -> None:
                    rows.append(i), cell.append(c), a.append(left), b.append(right), side.append(where)

                for i in range(len(part)):
                    c = int(cells[i])
                    n = own_blocks[c]
                    mine = int(spread[i] % n)
                    for other in range(n):
                        put(i, c, min(mine, other), max(mine, other), int(mine > other))
                    for other in range(visitor_blocks.get(c, 0)):
                        put(i, c, mine, n + other, 0)
                if own is not None:
                    where = _visits(_units(part["embedding"]), cells, own, radii, angle)
                    for i, k in zip(*np.nonzero(where)):
                        c = int(own.numbers[k])
                        n = own_blocks[c]
                        mine = n + int(spread[i] % visitor_blocks[c])
                        for other in range(n):
                            put(int(i), c, other, mine, 1)
                for at in range(0, len(rows), 8 * BLOCK_ROWS):
                    cut = slice(at, at + 8 * BLOCK_ROWS)
                    yield part.iloc[rows[cut]][["cid", "weight", "embedding"]].reset_index(drop=True).assign(
                        cell=cell[cut], a=a[cut], b=b[cut], side=side[cut]
                    )

    kind = dict(placed.dtypes)["embedding"]
    spread = F.pmod(F.xxhash64("cid"), F.lit(1 << 40)).alias("spread")
    return placed.select("cid", "weight", "embedding", "cell", spread).mapInPandas(
        deal, f"cid long, weight long, embedding {kind}, cell long, a long, b long, side int"
    )


def _joined(left: pd.DataFrame, right: pd.DataFrame | None, cosine: float) -> pd.DataFrame:
    """Links of two blocks, or of one with itself: rows (a, n) with numbers of links and (a, b) of a spanning forest."""
    alone = right is None
    x = _units(left["embedding"])
    y = x if alone else _units(right["embedding"])
    other = left if alone else right
    base = 0 if alone else len(left)
    ids = left["cid"].to_numpy() if alone else np.concatenate([left["cid"].to_numpy(), right["cid"].to_numpy()])
    weights = [left["weight"].to_numpy(), other["weight"].to_numpy()]
    label = np.arange(len(ids))
    links = np.zeros(len(ids), dtype=np.int64)
    forest: list[tuple[int, int]] = []
    for at in range(0, len(x), CHUNK_ROWS):
        linked = x[at:at + CHUNK_ROWS] @ y.T >= cosine
        if alone:
            linked[np.arange(len(linked)), at + np.arange(len(linked))] = False
        i, j = np.nonzero(linked.any(axis=1))[0], np.nonzero(linked.any(axis=0))[0]
        if not len(i):
            continue
        links[at + i] += linked[i].astype(np.int64) @ weights[1]
        if not alone:
            links[base + j] += linked[:, j].astype(np.int64).T @ weights[0][at:at + len(linked)]
        for row in i:
            to = base + np.nonzero(linked[row])[0]
            mine = at + row
            new = to[label[to] != label[mine]]
            if len(new):
                roots, first = np.unique(label[new], return_index=True)
                forest += [(mine, int(new[k])) for k in first]
                label[np.isin(label, roots)] = label[mine]
    has = np.nonzero(links)[0]
    ends = np.array(forest, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({
        "a": np.concatenate([ids[has], ids[ends[:, 0]]]),
        "b": pd.array([None] * len(has) + ids[ends[:, 1]].tolist(), dtype="Int64"),
        "n": np.concatenate([links[has], np.zeros(len(ends), dtype=np.int64)]),
    })


def linked_classes(classes: DataFrame, cosine: float) -> DataFrame:
    """(a, null, n) numbers of links per class and (a, b, 0) links that connect what all links connect."""
    angle = math.acos(cosine)
    total = classes.count()
    wanted = min(MOST_PIVOTS, -(-total // CELL_ROWS))
    drawn = classes.orderBy(F.xxhash64("cid"), "cid").limit(wanted).select("embedding").collect()
    pivots = _by_dimension([(i, r["embedding"]) for i, r in enumerate(drawn)])
    placed = written(in_cells(classes, pivots), "cells")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
    sizes, radii = {r["cell"]: r["n"] for r in cells}, {r["cell"]: r["radius"] for r in cells}
    visitors = {r["cell"]: r["n"] for r in _visitor_counts(placed, pivots, radii, angle).collect() if r["n"]}

    def join(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["side"] == 0], group[group["side"] == 1]
        if group["a"].iloc[0] == group["b"].iloc[0]:
            return _joined(left, None, cosine)
        return _joined(left, right, cosine) if len(left) and len(right) else _joined(left[:0], None, cosine)

    pairs = block_pairs(placed, pivots, radii, sizes, visitors, angle)
    return pairs.groupBy("cell", "a", "b").applyInPandas(join, "a long, b long, n long")


def linked(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding).

    Links join rows whose vectors have a cosine of at least ``cosine``, which must be positive, in double
    precision. n_links counts the other rows linked directly; component_id is the least vec_id that links
    lead to; kept marks that row. Vectors that are null, empty or zero, or hold null or non-finite
    components, and rows with a null vec_id, have no links. Vectors of different lengths never link.
    Repeated rows count one by one and link with each other. Other columns are not looked at.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    good = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    classes = written(
        good.groupBy("embedding").agg(F.min("vec_id").alias("head"), F.count("*").alias("weight"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes",
    )
    found = written(linked_classes(classes.select("cid", "weight", "embedding"), cosine), "links")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    of_class = written(
        classes.join(counts, F.col("cid") == F.col("a"), "left")
        .select("embedding", "head", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "counted",
    )
    heads = classes.select("cid", "head")
    ends = (
        found.filter("b is not null").join(heads.toDF("a", "head_a"), "a").join(heads.toDF("b", "head_b"), "b")
        .select("head_a", "head_b")
    )
    members = written(
        good.join(of_class, "embedding").select("vec_id", "head", "n_links"), "vectors",
    )
    copies = members.filter("vec_id != head").select("head", "vec_id")
    component = components(ends.toDF("a", "b").union(copies))
    others = rows.filter(~(F.col("vec_id").isNotNull() & usable(F.col("embedding")))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links")
    )
    return members.select("vec_id", "n_links").union(others).join(
        component.toDF("vec_id", "component"), "vec_id", "left"
    ).select(
        "vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
