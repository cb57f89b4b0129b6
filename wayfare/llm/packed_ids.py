"""Packed id matrices: documents cut and packed best-fit-decreasing into rows of a fixed length.

Each task packs its documents as they come, ``group_tokens`` at a time. Pieces go from long to short into
the fullest row that takes them, which a segment tree over the free room of rows finds in a logarithmic
number of steps. Rows fill matrices of ``rows`` rows. A matrix carries its ids, the cumulative lengths of
its segments over the flattened matrix, padding included, and the places where positions restart.

Memory does not depend on how much a task packs: a group is flat arrays of numbers, Arrow batches are taken
some texts at a time, and a written file has row groups of a few matrices.
"""

from __future__ import annotations

import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.tokens import word_ids

LENGTH = 2048
ROWS = 256
GROUP_TOKENS = 1 << 22
PAD = 0
CLOSING = bytes(4)
TEXTS_AT_ONCE = 256
# Parquet's writer looks at its buffers after a hundred rows only, which are 200 MB of matrices, and its reader
# takes up to 4096 rows of a row group at once; so sizes are looked at after each row.
ROW_GROUP = {
    "parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
    "parquet.enable.dictionary#ids": "false",
}

SCHEMA = (
    "matrix long, n_rows int, row_length int, ids binary, cu_seqlens array<int>, resets array<int>, "
    "doc_ids array<long>, starts array<long>, lengths array<int>, rows array<int>"
)


class RoomTree:
    """Rows by free room: a segment tree over rooms 0 to ``most`` that finds the least one that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.counts = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.counts[at] += by
            at >>= 1

    def take(self, room: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least free room of at least ``room``; the row leaves the tree."""
        at = room + self.size
        if not self.counts[at]:
            # climb to the first subtree on the right that holds a row, then go down to its leftmost leaf
            while at > 1 and (at & 1 or not self.counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.counts[2 * at] else 2 * at + 1
        found = at - self.size
        row = self.rows[found].pop()
        self._change(found, -1)
        return found, row


def fitted(lengths: np.ndarray, length: int) -> list[array.array]:
    """Rows of places in ``lengths``, which are those of pieces, packed best-fit-decreasing."""
    tree, rows = RoomTree(length), []
    order = np.argsort(-lengths.astype("i8"), kind="stable")
    for piece, size in zip(array.array("q", order.tobytes()), array.array("q", lengths[order].astype("i8").tobytes())):
        found = tree.take(size)
        if found is None:
            rows.append(array.array("q"))
            found = length, len(rows) - 1
        room, row = found
        rows[row].append(piece)
        tree.add(room - size, row)
    return rows


class Group:
    """Pieces of documents in flat arrays, one after another, until they are packed."""

    def __init__(self, length: int):
        self.length = length
        self.ids = bytearray()
        self.docs, self.unknown = array.array("q"), array.array("b")
        self.starts, self.lengths = array.array("q"), array.array("i")

    def add(self, doc_id: int | None, start: int, ids: memoryview) -> None:
        self.docs.append(doc_id or 0)
        self.unknown.append(doc_id is None)
        self.starts.append(start)
        self.lengths.append(len(ids) // 4)
        self.ids += ids

    def size(self) -> int:
        return len(self.ids) // 4

    def matrices(self, rows: int, number: int) -> Iterator[pa.RecordBatch]:
        """Matrices of ``rows`` rows, numbered from ``number`` on."""
        lengths = np.frombuffer(self.lengths, dtype="i4")
        full = fitted(lengths, self.length)
        flat, after = np.frombuffer(self.ids, dtype="<u4"), np.cumsum(lengths, dtype="i8")
        docs, starts = np.frombuffer(self.docs, dtype="i8"), np.frombuffer(self.starts, dtype="i8")
        unknown = np.frombuffer(self.unknown, dtype="?")
        for at in range(0, len(full), rows):
            part = full[at:at + rows]
            pieces = np.concatenate([np.frombuffer(r, dtype="i8") for r in part])
            sizes, of_row = lengths[pieces], np.repeat(np.arange(len(part)), [len(r) for r in part])
            filled = np.bincount(of_row, sizes, len(part)).astype("i8")
            # a row's pieces lie one after another; what is left of it is padding, a segment of its own
            shift = np.arange(len(part)) * self.length + filled - np.cumsum(filled)
            begin = np.cumsum(sizes, dtype="i8") - sizes + shift[of_row]
            open_rows = np.flatnonzero(filled < self.length)
            resets = np.sort(np.concatenate([begin, open_rows * self.length + filled[open_rows]]))
            ids = np.full(len(part) * self.length, PAD, dtype="<u4")
            for to, source, n in zip(begin.tolist(), (after[pieces] - sizes).tolist(), sizes.tolist()):
                ids[to:to + n] = flat[source:source + n]
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([len(part)], pa.int32()), pa.array([self.length], pa.int32()),
                pa.array([ids.tobytes()], pa.binary()), _listed(np.append(resets, len(ids)), pa.int32()),
                _listed(resets, pa.int32()), _listed(docs[pieces], pa.int64(), unknown[pieces]),
                _listed(starts[pieces], pa.int64()), _listed(sizes, pa.int32()), _listed(of_row, pa.int32()),
            ], names=[f.split()[0] for f in SCHEMA.split(", ")])
            number += 1


def _listed(values: np.ndarray, kind: pa.DataType, missing: np.ndarray | None = None) -> pa.Array:
    """One list of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind, mask=missing))


def positions(resets: np.ndarray, total: int) -> np.ndarray:
    """Position ids of a flattened matrix of ``total`` places: they count from 0 at each reset."""
    begin = np.zeros(total, dtype=np.int64)
    begin[resets] = resets
    return np.arange(total) - np.maximum.accumulate(begin)


def packed(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, rows: int = ROWS, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """Matrices of the ids of ``docs`` (doc_id, text), each document closed by id 0 and cut every ``length`` ids.

    Columns: ids are n_rows times row_length little-endian unsigned 32-bit numbers, padded with 0; cu_seqlens
    are the cumulative lengths of segments from 0, resets the places where position ids restart; doc_ids,
    starts (in the document), lengths and rows say per piece where it comes from and lies. Nothing is lost:
    a document's pieces by start are its ids. A null text counts as empty, which is the closing id alone;
    rows with a null doc_id and repeated rows are packed like others. An empty table gives no matrix. Other
    columns are not looked at.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(tokenizer)
        number = TaskContext.get().partitionId() << 32
        group = Group(length)
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(first, TEXTS_AT_ONCE)
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids = memoryview(table.encode(text) + CLOSING)
                    for at in range(0, len(ids), 4 * length):
                        group.add(doc_id, at // 4, ids[at:at + 4 * length])
                        if group.size() >= group_tokens:
                            for matrix in group.matrices(rows, number):
                                yield matrix
                                number += 1
                            group = Group(length)
        yield from group.matrices(rows, number)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(pack, SCHEMA)


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Write matrices as Parquet, which commits each task's file once, whatever executors are lost.

    A row group has a few matrices, so that neither this nor a reader holds more of them at once.
    """
    matrices.write.option("compression", "zstd").options(**ROW_GROUP).parquet(path)
