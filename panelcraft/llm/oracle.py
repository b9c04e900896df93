"""DuckDB SQL of the text operators that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
r AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM r),
x AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM x"""


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: reflected CRC-32 of the decimal doc_id: a shift and a conditional exclusive or for each bit of each byte
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE t AS (
  SELECT *, CASE WHEN {_CRC} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS altered
  FROM documents),
l AS (SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("altered")} AS seen FROM t),
leaves AS (
  SELECT doc_id, leaf, seen, coalesce('=' || source, '-') AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM l),
nodes AS (
  SELECT 0 AS lvl, tree, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lvl, tree, pos // 16, n),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 16, n),
low AS (
  SELECT a.lvl, a.tree, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.lvl = b.lvl AND a.tree = b.tree AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY 1, 2, 3),
high AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY 1, 2),
ranked AS (SELECT row_number() OVER () AS rid, v.*, s.subroot, s.pos AS top FROM leaves v JOIN subroots s ON v.tree = s.tree),
steps AS (
  SELECT rid, lvl, l, r FROM ranked JOIN low ON low.tree = ranked.tree AND low.pos = ranked.pos // power(16, lvl)::BIGINT
  UNION ALL
  SELECT rid, 1000 + lvl, l, r FROM ranked JOIN high ON high.pos = ranked.top // power(16, lvl)::BIGINT),
path AS (SELECT rid, string_agg(l || r, '' ORDER BY lvl) AS proof, list({{'l': l, 'd': '', 'r': r}} ORDER BY lvl) AS steps FROM steps GROUP BY rid),
f AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_concat([{{'l': '', 'd': seen, 'r': ''}}], coalesce(steps, [])),
                     lambda a, x: {{'l': '', 'd': sha256(x.l || a.d || x.r), 'r': ''}}).d AS folded_root
  FROM ranked LEFT JOIN path USING (rid))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f"""
