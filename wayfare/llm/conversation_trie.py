"""A trie of conversations, turn by turn, with what sharing common beginnings saves.

Turns are numbered by a dictionary, and a conversation becomes rows of at most ``CHUNK`` numbers. Rows are
sorted by their numbers over the cluster; each stretch of the sorted rows is a shard of bounded size that
builds ternary search trees, the median inserted first. An iterative traversal adds up members, leaves and
savings from the leaves to the root. What lies between the first and the last row of a shard is then
complete; nodes on the paths of these two rows may go on in the shards beside it, and are merged by a digest
of their turns.

A conversation beyond ``CHUNK`` turns goes on in further rows, each in the trie of the node where the row
before it ended. Paths that end at such a node count as border paths too, so that the merging carries what is
below them up to the root. A border path's conversations each own the nodes whose least member they are, which
are the lower end of their path; a node's total is the sum, over the border paths through it, of what they own
from there on, a running sum along each path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.joins import joiner
from wayfare.operators.ordered import running, running_count, running_sum
from wayfare.session import written

CHUNK = 256
FAMILY = 20
BORROWED = 4
WORDS = r"[^\x20\x09-\x0D]+"
# A shard ends after so many turns or rows, so that its tree fits a task whatever the conversations.
SHARD_TURNS = 200_000
# A key with more rows is numbered and summed up in slices.
ROWS_PER_TASK = 500_000

PARTS = (
    "kind string, conv_id long, depth long, node binary, parent binary, parent_conv_id long, words long, "
    "n_convs long, least long, n_children long, n_leaves long, saved_tokens long, ends string"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class TernaryTree:
    """Sequences of numbers in a ternary search tree: smaller, greater, and what follows an equal one.

    Node 0 is the empty sequence; ``heads`` has the root of the numbers that follow a node.
    """

    def __init__(self) -> None:
        self.key, self.lower, self.higher, self.heads = [None], [0], [0], [0]

    def _new(self, key: int) -> int:
        for column, value in ((self.key, key), (self.lower, 0), (self.higher, 0), (self.heads, 0)):
            column.append(value)
        return len(self.key) - 1

    def walk(self, keys) -> list[int]:
        """The node of every prefix of ``keys``, nodes not there yet being added."""
        path, at = [0], 0
        for key in keys:
            node = self.heads[at]
            if not node:
                node = self.heads[at] = self._new(key)
            while self.key[node] != key:
                side = self.lower if key < self.key[node] else self.higher
                if not side[node]:
                    side[node] = self._new(key)
                node = side[node]
            at = node
            path.append(at)
        return path

    def insert_balanced(self, sequences: list) -> None:
        """Insert sorted sequences, the median of each range before its halves."""
        ranges = [(0, len(sequences))]
        while ranges:
            low, high = ranges.pop()
            if low < high:
                middle = (low + high) // 2
                self.walk(sequences[middle])
                ranges += [(low, middle), (middle + 1, high)]

    def from_root(self) -> tuple[list[int], list[int]]:
        """All nodes, each after its parent in the trie, and the parents; node 0 is first, its own parent."""
        order, parents, waiting = [0], [0] * len(self.key), [(self.heads[0], 0)]
        while waiting:
            node, parent = waiting.pop()
            if node:
                order.append(node)
                parents[node] = parent
                waiting += [(self.lower[node], parent), (self.higher[node], parent), (self.heads[node], node)]
        return order, parents


def _digests(start: bytes, numbers: np.ndarray, after: bytes | None) -> list[bytes]:
    """Identity of the node at each prefix of a row that begins at the node ``start``."""
    found, running_hash = [start], hashlib.sha256(start)
    for number in numbers:
        running_hash.update(int(number).to_bytes(8, "big"))
        found.append(running_hash.digest())
    if after is not None:
        found[-1] = after
    return found


def _ids_hash(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _tree_parts(start: bytes, base: int, rows: list[tuple]) -> Iterator[tuple]:
    """What a shard knows of the trie that begins at the node ``start``, of depth ``base``.

    ``rows`` are (conv_id, numbers, words, last, after, border) in the order of numbers and conv_id.
    """
    tree = TernaryTree()
    sequences = [r[1] for i, r in enumerate(rows) if not i or not np.array_equal(r[1], rows[i - 1][1])]
    tree.insert_balanced([s.tolist() for s in sequences])
    size = len(tree.key)
    words, members, least = [0] * size, [0] * size, [None] * size
    children, leaves, saved, ends = [0] * size, [0] * size, [0] * size, {}
    border, paths = {}, []
    path, before = [0], None
    for conv, numbers, counts, last, after, on_border in rows:
        if before is None or not np.array_equal(numbers, before):
            path, before = tree.walk(numbers.tolist()), numbers
            for node, n in zip(path[1:], counts):
                words[node] = int(n)
        end = path[-1]
        members[end] += 1
        least[end] = conv if least[end] is None else min(least[end], conv)
        if last:
            ends.setdefault(end, []).append(conv)
        if on_border:
            names = _digests(start, numbers, after)
            border.update(zip(path, names))
            paths.append((conv, path, names))
    order, parents = tree.from_root()
    for node in reversed(order[1:]):
        parent = parents[node]
        members[parent] += members[node]
        least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
        if node in border:
            continue  # its children, leaves and savings are known only once all shards are put together
        leaves[node] += not children[node]
        saved[node] += (members[node] - 1) * words[node]
        children[parent] += 1
        leaves[parent] += leaves[node]
        saved[parent] += saved[node]
    depth = [0] * size
    for node in order[1:]:
        parent = parents[node]
        depth[node] = depth[parent] + 1
        if node not in border:
            known = border.get(parent)
            yield ("node", least[node], base + depth[node], None, known, None if known is not None else least[parent],
                   words[node], members[node], least[node], children[node], leaves[node], saved[node],
                   _ids_hash(ends.get(node, [])))
    told = set()
    for conv, path, names in paths:
        for i, (node, name) in enumerate(zip(path, names)):
            # the members of a node where a row went on are those of the row before
            counted = node not in told and not (i == 0 and base)
            new = node not in told
            told.add(node)
            yield ("border", conv, base + i, name, names[i - 1] if i else None, None, words[node],
                   members[node] if counted else 0, least[node] if counted else None,
                   children[node] if new else 0, leaves[node] if new else 0, saved[node] if new else 0, None)
    for node, ids in ends.items():
        if node in border:
            yield ("ends", ids[0], base + depth[node], border[node], None, None, None, None, None, None, None, None,
                   ",".join(map(str, ids)))


def _shard_parts(rows: list[tuple]) -> pd.DataFrame:
    """A shard's rows (start, base, conv_id, numbers, words, last, after) as parts of the trie."""
    found, tree = [], []
    for i, (start, base, conv, numbers, words, last, after) in enumerate(rows):
        border = i in (0, len(rows) - 1) or after is not None
        if tree and tree[0] != (start, base):
            found += _tree_parts(*tree[0], tree[1])
            tree = []
        if not tree:
            tree = [(start, base), []]
            border = True  # the node that a trie begins at is on a border path
        tree[1].append((conv, numbers, words, last, after, border))
    found += _tree_parts(*tree[0], tree[1])
    # objects, as whole numbers beside nulls would become floating-point ones
    return pd.DataFrame(found, columns=[c.split()[0] for c in PARTS.split(", ")], dtype=object)


def trie_parts(batches: Iterator[pd.DataFrame], shard_turns: int) -> Iterator[pd.DataFrame]:
    """Parts of the trie from rows in order, a shard of about ``shard_turns`` turns at a time."""
    shard, held = [], 0
    for batch in batches:
        for start, base, conv, numbers, words, last, after in zip(*(batch[c] for c in (
            "start", "base", "conv_id", "numbers", "words", "last", "after"
        ))):
            shard.append((start, int(base), int(conv), np.asarray(numbers, dtype=np.int64), words, last, after))
            held += len(numbers) + 1
            if held >= shard_turns:
                yield _shard_parts(shard)
                shard, held = [], 0
    if shard:
        yield _shard_parts(shard)


def hashed_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, ends_sha256) from lists of ids that come by node and first id, one list in memory at a time."""
    node, running_hash = None, None
    for batch in batches:
        done = []
        for at, ids in zip(batch["node"], batch["ends"]):
            if at != node:
                if node is not None:
                    done.append((node, running_hash.hexdigest()))
                node, running_hash = at, hashlib.sha256(ids.encode())
            else:
                running_hash.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, running_hash.hexdigest())], columns=["node", "ends_sha256"])


def numbered_turns(messages: DataFrame, rows_per_task: int) -> DataFrame:
    """(conv_id, i, turn_id, words) per message with a conv_id; i counts a conversation's turns from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = messages.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        # the role's length keeps apart what joined text would not
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("key"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    places = running(turns, ["conv_id"], ["turn", "key"], {"i": running_count()}, rows_per_task)
    placed = written(places.select("conv_id", (F.col("i") - 1).alias("i"), "key", "words"), "turns")
    dictionary = written(
        placed.select("key").distinct().withColumn("turn_id", F.monotonically_increasing_id()), "dictionary"
    )
    encoded = joiner(dictionary, ["key"], ["conv_id", "i"])(placed, "inner")
    return written(encoded.select("conv_id", "i", "turn_id", "words"), "encoded")


def rebuilt(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, i, turn_id, words) where the first h of each conversation come from its family's first.

    ``conversations`` has conv_id, h, taken (how many of them there are, h at most) and own (the turns it has).
    """
    heads = turns.filter(F.col("i") < BORROWED - 1).withColumnRenamed("conv_id", "head")
    borrowed = conversations.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "head")
    # where the head is shorter than h, what follows moves up
    moved = conversations.filter("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"))
    own = joiner(moved, ["conv_id"], ["i"])(turns.filter(F.col("i") >= _borrowed_turns()), "left")
    return borrowed.filter("i < h").select("conv_id", "i", "turn_id", "words").unionByName(
        own.select("conv_id", (F.col("i") - F.coalesce("less", F.lit(0))).alias("i"), "turn_id", "words")
    )


def _borrowed_turns() -> Column:
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED


def chunk_rows(turns: DataFrame, lengths: DataFrame, chunk: int, rows_per_task: int) -> DataFrame:
    """(start, base, conv_id, numbers, words, last, after): rows of at most ``chunk`` turns.

    ``turns`` has conv_id, i, turn_id and words, and ``lengths`` the number of turns per conv_id, which may
    be 0. start is the identity of the node at which a row begins, the depth of which is base, and after that
    of the node at which a full row ends; it is made of the row's number and a sum of hashes of all rows up to
    there, two of 60 bits.
    """
    place = F.struct("i", "turn_id", "words")
    cut = turns.withColumn("k", F.floor(F.col("i") / chunk)).unionByName(
        # a row for every conversation, also one without turns
        lengths.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in ("i", "turn_id", "words")],
                       F.lit(0).cast("long").alias("k"))
    )
    rows = written(
        cut.groupBy("conv_id", "k").agg(
            F.sort_array(F.collect_list(F.when(F.col("i").isNotNull(), place))).alias("turns")
        ).select(
            "conv_id", "k", F.col("turns.turn_id").alias("numbers"), F.col("turns.words").alias("words")
        ).join(lengths, "conv_id").withColumn("last", (F.col("k") + 1) * chunk >= F.col("length")),
        "chunks",
    )
    digest = F.sha2(F.concat_ws(",", F.col("k").cast("string"), F.col("numbers").cast("array<string>")).cast("binary"), 256)
    hashes = {
        name: F.conv(F.substring("digest", at, 15), 16, 10).cast("decimal(38,0)")
        for name, at in (("upto_a", 1), ("upto_b", 16))
    }
    long = rows.filter(F.size("numbers") == chunk).withColumn("digest", digest)
    upto = running(
        long.select("conv_id", "k", "digest"), ["conv_id"], ["k"],
        {name: running_sum(value) for name, value in hashes.items()}, rows_per_task,
    ).select("conv_id", "k", F.concat_ws(
        ",", *[c.cast("string") for c in (F.col("k") + 1, F.col("upto_a"), F.col("upto_b"))]
    ).cast("binary").alias("after"))
    upto = written(upto, "after")
    starts = upto.select("conv_id", (F.col("k") + 1).alias("k"), F.col("after").alias("start"))
    on = ["conv_id", "k"]
    return rows.join(upto, on, "left").join(starts, on, "left").select(
        F.coalesce("start", F.lit("").cast("binary")).alias("start"), (F.col("k") * chunk).alias("base"),
        "conv_id", "numbers", "words", "last", "after",
    )


def put_together(parts: DataFrame, rows_per_task: int) -> DataFrame:
    """The nodes of the whole trie from the ``parts`` of all shards."""
    paths = parts.filter("kind = 'border'").select(
        "conv_id", "depth", "node", "parent", "words", "n_convs", "least", "n_children", "n_leaves", "saved_tokens"
    )
    nodes = written(paths.groupBy("node").agg(
        F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("words").alias("words"),
        F.min("conv_id").alias("owner"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.min("least").alias("least"),
    ), "border")
    below = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    nodes = written(nodes.join(below, "node", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    ).withColumns({
        "leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"),
    }).select("node", "depth", "parent", "owner", "least", "n_convs", "n_children", "leaves", "saved"), "border")

    # each border path once, with what it owns from each of its nodes on
    steps = paths.select("conv_id", "depth", "node").distinct()
    owned = joiner(nodes.select("node", "owner", "leaves", "saved"), ["node"], ["conv_id"])(steps, "inner")
    mine = F.col("owner") == F.col("conv_id")
    sums = running(
        owned.select(
            "conv_id", (-F.col("depth")).alias("up"), "node",
            *[F.when(mine, F.col(c)).otherwise(0).alias(c) for c in ("leaves", "saved")],
        ),
        ["conv_id"], ["up"], {"n_leaves": running_sum(F.col("leaves")), "saved_tokens": running_sum(F.col("saved"))},
        rows_per_task,
    )
    totals = sums.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    slices = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = (
        parts.filter("kind = 'ends'").select("node", "conv_id", "ends")
        .repartition(slices, "node").sortWithinPartitions("node", "conv_id").select("node", "ends")
        .mapInPandas(hashed_ends, "node binary, ends_sha256 string")
    )
    names = written(nodes.select(F.col("node").alias("parent"), F.col("least").alias("above")), "names")
    with_parent = joiner(names, ["parent"], ["conv_id", "depth"])
    no_ends = F.sha2(F.lit("").cast("binary"), 256)
    merged = with_parent(
        nodes.drop("leaves", "saved", "owner").join(totals, "node").join(ends, "node", "left")
        .withColumnRenamed("least", "conv_id"),
        "left",
    ).withColumns({"parent_conv_id": F.col("above"), "ends_sha256": F.coalesce("ends_sha256", no_ends)})
    inner = parts.filter("kind = 'node'").withColumnRenamed("ends", "ends_sha256")
    at_border = with_parent(inner.filter(F.col("parent").isNotNull()), "inner").withColumn("parent_conv_id", F.col("above"))
    inside = inner.filter(F.col("parent").isNull())
    return merged.select(*COLUMNS).unionByName(at_border.select(*COLUMNS)).unionByName(inside.select(*COLUMNS))


def prefix_trie(
    messages: DataFrame, chunk: int = CHUNK, shard_turns: int = SHARD_TURNS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """A row per node of the trie of ``messages`` (conv_id, turn, role, text), see ``COLUMNS``.

    A conversation's turns go by turn, null first, and those of one turn number by the digest of role and
    text; a null role or text is empty, and repeated rows are turns of their own. Rows without a conv_id
    belong to no conversation. Every conversation c is rebuilt: the first h turns of conversation c - c % 20,
    or all it has, then its own after the first h, where h is the unsigned crc32 of the decimal c modulo 4.
    One that has no turns left ends at the root, which has depth 0 and no words. Conversations and turns may be
    of any length. An empty table gives no rows. Other columns, whatever their names, are not looked at.
    """
    turns = numbered_turns(messages, rows_per_task)
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("own").alias("there"))
    conversations = written(
        sizes.withColumn("h", _borrowed_turns()).withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(heads, "head", "left")
        .withColumn("taken", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
        .select("conv_id", "h", "taken", "own"),
        "conversations",
    )
    own = F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))
    lengths = conversations.select("conv_id", (F.col("taken") + own).alias("length"))
    rows = written(chunk_rows(rebuilt(turns, conversations), lengths, chunk, rows_per_task), "rows")
    slices = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["base", "start", "numbers", "conv_id"]
    parts = written(
        rows.repartitionByRange(slices, *order).sortWithinPartitions(*order)
        .mapInPandas(partial(trie_parts, shard_turns=shard_turns), PARTS),
        "parts",
    )
    return put_together(parts, rows_per_task)
