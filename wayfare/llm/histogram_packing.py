"""Best-fit packing planned on a histogram of lengths instead of on documents.

Pieces are counted per length, of which there are at most as many as tokens in a sequence. Best fit in
decreasing order runs over these counts on the driver and yields a few ranges per length: "the pieces
with ranks 40 to 90 of length 700 go into sequences 12 to 37, two each, from place 600". Pieces then
find their slots by their rank within their length, so no task and no driver sees all documents.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import ranked
from wayfare.llm.tokens import word_ids
from wayfare.session import written

SEPARATOR = b"\0\0\0\0"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOTS = "array<struct<length: bigint, first: bigint, pieces: bigint, sequence: bigint, each: bigint, place: bigint>>"
MOST_BROADCAST_SLOTS = 500_000


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """One row per piece: a document's ids and a closing id 0, cut where longer than ``capacity``."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = word_ids(tokenizer)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = table.encode(text) + SEPARATOR
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.assign(doc_id=pd.array(frame["doc_id"], dtype="Int64"))

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInPandas(cut, PIECES)


def plan(counts: Mapping[int, int], capacity: int) -> list[dict]:
    """Slots for ``counts`` pieces of each length, by best fit in decreasing order.

    Open sequences with the same room are kept as ranges. The longest pieces left go to the smallest room
    that takes them, as many into each sequence as fit, and new sequences are opened when none does.
    """
    rooms: list[int] = []
    ranges: dict[int, list[tuple[int, int]]] = {}

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in ranges:
                bisect.insort(rooms, room)
                ranges[room] = []
            ranges[room].append((first, n))

    slots, opened = [], 0
    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room], rooms[at]
            else:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = room // length
            full = min(n, left // each)
            if full:
                taken, used, per = full * each, full, each
            else:
                taken, used, per = left, 1, left
            slots.append({"length": length, "first": done, "pieces": taken, "sequence": first, "each": per,
                          "place": capacity - room})
            give(room - per * length, first, used)
            give(room, first + used, n - used)
            done, left = done + taken, left - taken
    return slots


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with doc_id, piece, length) with sequence_id and offset; sequences have no gaps."""
    pieces = written(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = plan(counts, capacity)
    table = pieces.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(slots)), SLOTS)))
    if len(slots) <= MOST_BROADCAST_SLOTS:
        table = F.broadcast(table)
    at = ranked(pieces, ["length"], ["doc_id", "piece"])
    inside: Column = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("pieces"))
    i = F.col("rank") - F.col("first")
    return at.join(table.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & inside).select(
        *pieces.columns,
        (F.col("sequence") + F.floor(i / F.col("each"))).alias("sequence_id"),
        (F.col("place") + i % F.col("each") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all ``docs`` (doc_id, text).

    A null or empty text is the closing id alone. Rows with a null doc_id and repeated rows are packed
    like others, each on its own. No documents give no rows. Other columns are not looked at. Texts of
    any length are cut without loss.
    """
    return packed(pieces_of(docs, tokenizer, capacity), capacity)
