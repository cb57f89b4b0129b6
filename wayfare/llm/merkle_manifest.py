"""A Merkle manifest of a table of documents, and an inclusion proof for every row.

The tree is a content-addressed store: a record per inner node, from its digest to the digests of its
children. It is built bottom-up, a level at a time, each an eighth of the one below. Proofs come by descent:
requests start at the root, look their digest up in the store, go on to the child that the next digit of
their rank selects, and collect the children not selected. Requests with the same digits so far are one
record until they part, so that a level has as many records as nodes and no digest is looked up by many; at
the last step a record becomes the leaves below it. A path is a list of segments, one per level, from the
root; reversed it is the proof.

There is one tree per language, and one over their roots. All looked-up digests are unique, whatever the
share of one language.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import ranked
from wayfare.operators.joins import joiner
from wayfare.session import written

FAN = 8
DIGEST_BYTES = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_MODULUS = 3
TOP = "top"
SEGMENTS = "array<struct<before: binary, after: binary>>"


def sha256(*parts: Column) -> Column:
    """The digest of the joined ``parts``, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields, each ``-`` if null, else its UTF-8 bytes, a colon and the value."""
    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return sha256(*map(part, FIELDS))


@dataclass(frozen=True)
class Forest:
    """Trees by name. ``levels[i]`` is the store of the nodes of height i + 1, by digest."""

    levels: Sequence[DataFrame]
    # (tree, size, height, digest) per tree
    roots: DataFrame


def forest(leaves: DataFrame, passed: Sequence[str] = ()) -> Forest:
    """Trees over ``leaves`` (tree, size, rank, digest); ``size`` is the number of leaves of the row's tree.

    Level by level, every eight neighbours become the node of their joined hexadecimal digests, the last
    ones of a level also if they are fewer, until one is left. The store of the lowest nodes keeps the
    columns ``passed`` of the leaves, per child and in order.
    """
    most = leaves.agg(F.max("size")).first()[0] or 0
    height = next(h for h in range(64) if FAN ** h >= most)
    levels = []
    leaves = leaves.withColumnRenamed("rank", "index")
    finished = leaves.filter("size = 1").select("tree", "size", F.lit(0).alias("height"), "digest")
    below = leaves.filter("size > 1")
    for level in range(1, height + 1):
        # the children in order, as one string of bytes
        own = F.struct("index", "digest", *(passed if level == 1 else []))
        joined = F.aggregate(
            "nodes", F.lit("").cast("binary"), lambda done, node: F.concat(done, node["digest"])
        )
        keep = [F.col("nodes")] if passed and level == 1 else []
        built = written(
            below.groupBy("tree", F.floor(F.col("index") / FAN).alias("index"))
            .agg(F.max("size").alias("size"), F.sort_array(F.collect_list(own)).alias("nodes"))
            .select("tree", "size", "index", joined.alias("children"), *keep)
            .withColumn("digest", sha256(hexed(F.col("children")))),
            "nodes",
        )
        levels.append(built)
        finished = finished.unionByName(
            built.filter(F.col("size") <= FAN ** level).select("tree", "size", F.lit(level).alias("height"), "digest")
        )
        below = built.filter(F.col("size") > FAN ** level).select("tree", "size", "index", "digest")
    return Forest(levels, finished)


def _store(level: DataFrame) -> DataFrame:
    """A record per digest: equal subtrees, which repeated rows can give, are one node."""
    columns = [c for c in level.columns if c not in ("tree", "size", "index", "digest")]
    return level.groupBy("digest").agg(*[F.first(c).alias(c) for c in columns])


def _segment(children: Column, digit: Column) -> Column:
    """The children beside the one of ``digit``, on its left and on its right."""
    at = (digit * DIGEST_BYTES).cast("int")
    return F.struct(
        F.substring(children, F.lit(1), at).alias("before"),
        F.substring(children, at + DIGEST_BYTES + 1, F.length(children)).alias("after"),
    )


def _child(children: Column, digit: Column) -> Column:
    return F.substring(children, (digit * DIGEST_BYTES + 1).cast("int"), F.lit(DIGEST_BYTES))


def _with_digits(requests: DataFrame) -> DataFrame:
    """Requests fanned out to the children of their node, one per digit."""
    last = (F.length("children") / DIGEST_BYTES - 1).cast("int")
    return requests.withColumn("digit", F.explode(F.sequence(F.lit(0), last)))


def descent(trees: Forest, requests: DataFrame, to: int) -> DataFrame:
    """Requests (height, digest, path, and columns passed on) taken down to the nodes of height ``to``.

    Each enters at its own height; a level's lookup is a join on a digest that is unique in the store and
    occurs once per place of its node.
    """
    passed = [c for c in requests.columns if c not in ("height", "digest", "path")]
    at = None
    for level in range(len(trees.levels), to - 1, -1):
        entering = requests.filter(F.col("height") == level).select(*passed, "digest", "path")
        at = entering if at is None else at.unionByName(entering)
        if level > to:
            found = at.join(_store(trees.levels[level - 1]).select("digest", "children"), "digest")
            at = _with_digits(found).select(
                *passed,
                _child(F.col("children"), F.col("digit")).alias("digest"),
                F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
            )
    return requests.select(*passed, "digest", "path").filter(F.lit(False)) if at is None else at


def _proof(path: Column) -> Column:
    """H of the siblings of all levels, from the leaf up."""
    joined = F.aggregate(
        F.reverse(path), F.lit("").cast("binary"), lambda done, s: F.concat(done, s["before"], s["after"])
    )
    return F.sha2(hexed(joined).cast("binary"), 256)


def _folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(
        F.reverse(path), hexed(leaf),
        lambda below, s: F.sha2(F.concat(hexed(s["before"]), below, hexed(s["after"])).cast("binary"), 256),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text, any of which may be null in any row; doc_id and
    n_chars are integers. A leaf is the digest of these five fields, of whole texts of any length. Within a
    language, null being one of them, leaves go by doc_id, null first, and rows of one doc_id by their
    digest; repeated rows are leaves of their own. Languages go by their UTF-8 bytes, null first. A
    language with one row has its leaf as subroot, and a single subroot is the root. No rows give no rows.
    Other columns, whatever their names, are not looked at.

    ``folded_root`` starts at the leaf of the row, which is tampered with where 3 divides the unsigned
    crc32 of the decimal doc_id: then the text's A to Z are lower-cased. A row without a doc_id is not
    tampered with.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MODULUS == 0
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    digests = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # one text that sorts as the language does, null first
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        leaf_digest().alias("digest"),
        F.when(changed, leaf_digest(text=lowered)).alias("tampered"),
    )
    # the sort puts null ids first
    placed = ranked(digests, [], ["tree", "doc_id", "digest"])
    sizes = written(placed.groupBy("tree").agg(F.min("rank").alias("first"), F.count("*").alias("size")), "languages")
    leaves = joiner(sizes, ["tree"], ["rank"])(placed, "inner").withColumn("rank", F.col("rank") - F.col("first"))
    below = forest(leaves, ["doc_id", "tampered"])

    # languages are ordered by where their rows begin, and are the leaves of the tree above
    subroots = written(below.roots.join(sizes.select("tree", "first"), "tree"), "subroots")
    languages = subroots.count()
    above = forest(ranked(subroots, [], ["first"]).select(
        F.lit(TOP).alias("tree"), F.lit(languages).cast("long").alias("size"), "rank", "digest"
    ))
    top = above.roots.first()
    root = F.lit(None).cast("binary") if top is None else F.lit(bytes(top["digest"]))
    start = above.roots.select("height", "digest", F.array().cast(SEGMENTS).alias("path"))
    # the requests reach the subroots and enter the tree of each
    entered = descent(above, start, 0).join(subroots.groupBy("digest").agg(F.max("height").alias("height")), "digest")
    requests = entered.select("height", "digest", "path", F.col("digest").alias("subroot"))

    lone = leaves.filter("size = 1").select("digest", "doc_id", "tampered")
    ends = requests.filter("height = 0").join(lone, "digest").select(
        "doc_id", F.col("digest").alias("leaf"), "tampered", "subroot", "path"
    )
    if below.levels:
        # the lowest nodes bring their documents along; a request becomes one per leaf without a shuffle
        lowest = descent(below, requests, 1).join(_store(below.levels[0]), "digest")
        node = F.element_at("nodes", F.col("digit") + 1)
        ends = ends.unionByName(_with_digits(lowest).select(
            node["doc_id"].alias("doc_id"), node["digest"].alias("leaf"), node["tampered"].alias("tampered"), "subroot",
            F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
        ))
    folded = _folded(F.col("path"), F.coalesce("tampered", "leaf"))
    return ends.select(
        "doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        hexed(root).alias("root"), _proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
