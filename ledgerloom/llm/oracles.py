"""DuckDB SQL for the training-data queries that SQL can express, written apart from the operators."""

from __future__ import annotations

#: crc32 of the UTF-8 bytes of ``{0}``, unsigned: a table of 256 remainders, then one step per byte.
CRC_TABLE = """crc_table AS (
    SELECT list(r ORDER BY b) AS t FROM (
        SELECT b, list_reduce([b::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))) AS r FROM range(256) AS g(b)))"""


def crc32(text: str, table: str = "t") -> str:
    """For strings of ASCII and other characters alike: bytes come from the hexadecimal form."""
    return (f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, octet_length(encode({text})) + 1), "
            f"lambda i: ('0x' || substr(hex(encode({text})), (2 * i - 1)::BIGINT, 2))::UBIGINT)), "
            f"lambda c, b: xor({table}[(xor(c, b) & 255)::BIGINT + 1], c >> 8)))")


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


def _tree(nodes: str, name: str, levels: int) -> str:
    """CTEs ``name0`` to ``name{levels}``: a tree's nodes level by level with their siblings to the left and right."""
    out, below = [], nodes
    for k in range(levels + 1):
        base = f"SELECT tree, pos, cnt, digest FROM {nodes}" if k == 0 else (
            f"SELECT tree, pos // 16 AS pos, (cnt + 15) // 16 AS cnt, CASE WHEN cnt > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest "
            f"FROM {below} GROUP BY tree, pos // 16, cnt")
        side = "coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN {}), '')"
        out.append(f"{name}{k} AS (SELECT *, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS a, "
                   f"{side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS b FROM ({base}))")
        below = f"{name}{k}"
    return ",\n".join(out)


def merkle(levels: int = 6, over: int = 4) -> str:
    leaf = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    joins = "".join(f" JOIN t{k} ON t{k}.tree = d.tree AND t{k}.pos = d.pos // {16 ** k}" for k in range(levels))
    joins += "".join(f" JOIN u{k} ON u{k}.pos = s.pos // {16 ** k}" for k in range(over))
    steps = [f"t{k}" for k in range(levels)] + [f"u{k}" for k in range(over)]
    folds, last = [], "p"
    for k, s in enumerate(steps):
        folds.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN {s}_n > 1 THEN sha256({s}_a || cur || {s}_b) ELSE cur END AS cur) FROM {last})")
        last = f"f{k}"
    carried = ", ".join(f"{s}.cnt AS {s}_n, {s}.a AS {s}_a, {s}.b AS {s}_b" for s in steps)
    return f"""WITH {CRC_TABLE},
d AS (
    SELECT doc_id, coalesce('s' || source, 'n') AS tree, {leaf.format('text')} AS digest,
           CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN {leaf.format(lower)} END AS changed,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS cnt
    FROM documents, crc_table),
{_tree('d', 't', levels)},
s AS (SELECT '' AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS cnt FROM t{levels}),
{_tree('s', 'u', over)},
p AS (SELECT d.doc_id, d.digest AS leaf, s.digest AS subroot, u{over}.digest AS root, coalesce(d.changed, d.digest) AS cur, {carried}
      FROM d JOIN s ON s.source = d.tree {joins} CROSS JOIN u{over}),
{', '.join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({' || '.join(f'{s}_a || {s}_b' for s in steps)}) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM {last}"""


def spelling() -> str:
    lower = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    at = "(h % length(w))::BIGINT"
    return rf"""WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
lowered AS (SELECT doc_id, {lower} AS w, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT w, c, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM lowered, crc_table),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, {at}) || substr(w, {at} + 2) ELSE w END AS w, c FROM hashed),
words AS (SELECT w, sum(c)::BIGINT AS n FROM slipped WHERE length(w) >= 6 GROUP BY w HAVING sum(c) >= 5),
less AS (SELECT w, i, substr(w, 1, i) || substr(w, i + 2) AS v FROM (SELECT w, unnest(range(length(w))) AS i FROM words)),
near AS (
    SELECT less.w, words.w AS x FROM less JOIN words ON less.v = words.w
    UNION SELECT words.w, less.w FROM less JOIN words ON less.v = words.w
    UNION SELECT a.w, b.w FROM less a JOIN less b ON a.i = b.i AND a.v = b.v AND a.w <> b.w),
best AS (
    SELECT near.w, count(*) AS n_near, first(near.x ORDER BY words.n DESC, near.x) AS x, max(words.n) AS m
    FROM near JOIN words ON words.w = near.x GROUP BY near.w),
formed AS (
    SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * words.n THEN x END AS form, CASE WHEN m >= 5 * words.n THEN m END AS form_n
    FROM words LEFT JOIN best ON best.w = words.w),
walk AS (
    SELECT w, w AS at, form AS further FROM formed
    UNION ALL SELECT walk.w, walk.further, formed.form FROM walk JOIN formed ON formed.w = walk.further)
SELECT formed.w AS word, form, walk.at AS root, n, n_near, form_n FROM formed JOIN walk ON walk.w = formed.w AND walk.further IS NULL"""


def substrings(length: int = 35) -> str:
    return rf"""WITH texts AS (SELECT row_number() OVER () AS num, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT num, unnest(range(1, len(words) - {length} + 2)) AS s, words FROM texts),
hashed AS (SELECT num, s, array_to_string(words[s:s + {length - 1}], ' ') AS w FROM windows),
again AS (SELECT num, s FROM hashed QUALIFY count(*) OVER (PARTITION BY w) > 1),
gone AS (SELECT DISTINCT num, unnest(range(s, s + {length})) AS i FROM again),
placed AS (SELECT num, doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM texts),
kept AS (
    SELECT placed.num, count(gone.i) AS n_removed, count(*) AS n_words, string_agg(w, ' ' ORDER BY placed.i) FILTER (gone.i IS NULL) AS rest
    FROM placed LEFT JOIN gone ON gone.num = placed.num AND gone.i = placed.i GROUP BY placed.num)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (num)"""
