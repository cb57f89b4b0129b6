"""DuckDB SQL of the operators on digests: duplicates, the manifest and the trie of conversations."""

from __future__ import annotations

FAN = 8


def crc32(text: str) -> str:
    """Unsigned crc32 of ASCII ``text``, a bit at a time."""
    return (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, "
        f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda acc, b: "
        "list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"
    )


def _level(before: str, after: str) -> str:
    """Rows (tree, i, h, f, proof) a level up: nodes are run together by eights, paths grow by the siblings."""
    rest = "hs[:i % 8] || hs[i % 8 + 2:]"
    replaced = "hs[:i % 8] || [f] || hs[i % 8 + 2:]"
    return f"""
        {after}_runs AS (
            SELECT tree, i // {FAN} AS run, list(h ORDER BY i) AS hs, max(top) AS top
            FROM (SELECT DISTINCT tree, i, h, max(i) OVER (PARTITION BY tree) AS top FROM {before}) GROUP BY ALL),
        {after} AS (
            SELECT * EXCLUDE (hs, top) REPLACE (
                i // {FAN} AS i,
                CASE WHEN top = 0 THEN h ELSE sha256(array_to_string(hs, '')) END AS h,
                CASE WHEN top = 0 THEN f ELSE sha256(array_to_string({replaced}, '')) END AS f,
                proof || array_to_string({rest}, '') AS proof)
            FROM (SELECT b.*, hs, top FROM {before} b JOIN {after}_runs r ON r.tree = b.tree AND r.run = b.i // {FAN}))"""


def _part(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_part, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def manifest_sql(levels: int = 7, levels_above: int = 3) -> str:
    """For up to 8 ** levels rows in a language and 8 ** levels_above languages."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"l{i}" for i in range(levels + 1)]
    above = [f"t{i}" for i in range(levels_above + 1)]
    up = [_level(a, b) for a, b in zip(steps, steps[1:])]
    up_above = [_level(a, b) for a, b in zip(above, above[1:])]
    return f"""WITH leaves AS (
            SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS leaf,
                CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf(lowered)} END AS tampered
            FROM documents),
        l0 AS (
            SELECT row_number() OVER () AS place, doc_id, leaf, tree, leaf AS h, coalesce(tampered, leaf) AS f, '' AS proof,
                row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
            FROM leaves),{','.join(up)},
        t0 AS (
            SELECT * REPLACE ('' AS tree, dense_rank() OVER (ORDER BY tree) - 1 AS i), h AS subroot FROM {steps[-1]}),
        {','.join(up_above).lstrip()}
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified
        FROM {above[-1]}"""


DUPLICATES = """
    WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
        row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
    FROM hashed
"""

TRIE = rf"""
    WITH own AS (
        SELECT conv_id, role, text, sha256(length(role) || ':' || role || text) AS key,
            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) - 1 AS i
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
        WHERE conv_id IS NOT NULL),
    convs AS (
        SELECT conv_id, {crc32('conv_id::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
    turns AS (
        SELECT convs.conv_id, i, key, words FROM convs JOIN own ON own.conv_id = convs.conv_id - convs.conv_id % 20
        WHERE i < h
        UNION ALL
        SELECT conv_id, i, key, words FROM convs JOIN own USING (conv_id) WHERE i >= h),
    whole AS (
        SELECT conv_id, coalesce(keys, []) AS keys, coalesce(counts, []) AS counts FROM convs LEFT JOIN (
            SELECT conv_id, list(key ORDER BY i) AS keys, list(words ORDER BY i) AS counts FROM turns GROUP BY conv_id)
        USING (conv_id)),
    passed AS (
        SELECT conv_id, keys[:d] AS node, d, len(keys) = d AS ending, CASE WHEN d > 0 THEN counts[d] ELSE 0 END AS words
        FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS d FROM whole)),
    nodes AS (
        SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
        FROM passed GROUP BY node, d),
    kids AS (SELECT node[:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    known AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
    sums AS (
        SELECT node[:a] AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
            sum((n_convs - 1) * words)::BIGINT AS saved_tokens
        FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM known) GROUP BY ALL)
    SELECT k.conv_id, k.d AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens,
        k.ends_sha256
    FROM known k JOIN sums USING (node) LEFT JOIN known p ON k.d > 0 AND p.node = k.node[:k.d - 1]
"""

SQL: dict[str, str] = {
    "op11_digest_merge": DUPLICATES,
    "op12_merkle_manifest": manifest_sql(),
    "op13_prefix_trie": TRIE,
}
