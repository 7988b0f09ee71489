"""The registered queries as plain SQL for DuckDB, where SQL can state them: written from their contracts, over whole tables."""

from __future__ import annotations

from churnflow.llm import secret_scan

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_SPACED_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP1 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + 9), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
g AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT n FROM p))),
h AS (SELECT doc_id, item_id, s, n FROM g JOIN p USING (gram, n)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM h) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id),
q AS (SELECT gram, n, list_distinct(string_split(gram, ' ')) AS terms FROM (SELECT DISTINCT n, gram FROM p)),
u AS (SELECT gram, n, len(terms) AS many, unnest(terms) AS term FROM q),
c AS (
  SELECT doc_id, gram, n FROM (SELECT DISTINCT doc_id, unnest(w) AS term FROM d) JOIN u USING (term)
  GROUP BY doc_id, gram, n, many HAVING count(*) = many),
x AS (
  SELECT doc_id, w, gram, n, terms, unnest(range(1, greatest(len(w) - (n + 5) + 1, 1) + 1)) AS s
  FROM c JOIN d USING (doc_id) JOIN q USING (gram, n)),
near AS (SELECT DISTINCT doc_id, item_id FROM x JOIN p USING (gram, n) WHERE list_has_all(list_slice(w, s, s + n + 4), terms)),
close AS (
  SELECT doc_id, count(*) AS n_near, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS near_ids
  FROM near GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near, sha256(coalesce(near_ids, '')) AS near_sha256
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN close USING (doc_id)"""

_OP2 = f"""
WITH d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 49), ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
f AS (SELECT gram, min(doc_id) AS first FROM g GROUP BY gram),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS k FROM g JOIN f USING (gram) WHERE doc_id > first),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d) ANTI JOIN hit USING (doc_id, k)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id) USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

# Two hexadecimal digits are a byte.
_OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT doc_id, x, length(x) // 2 AS n_bytes FROM d),
g AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS gram
  FROM (SELECT doc_id, x, unnest(range(n_bytes - 99)) AS s FROM n WHERE n_bytes >= 100)),
l AS (SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS nth FROM g),
m AS (SELECT doc_id, s, s - lag(s) OVER w AS gap FROM l WHERE nth > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
r AS (SELECT doc_id, s, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM m),
spans AS (SELECT doc_id, run, min(s) AS s, max(s) + 100 AS e FROM r GROUP BY doc_id, run),
cut AS (
  SELECT doc_id, count(*) AS n_spans, CAST(sum(e - s) AS BIGINT) AS n_removed, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es
  FROM spans GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN ss IS NULL THEN x ELSE array_to_string(list_transform(
    range(1, len(ss) + 2), lambda i: substr(x, 2 * coalesce(es[i - 1], 0) + 1, 2 * (coalesce(ss[i], n_bytes) - coalesce(es[i - 1], 0)))), '') END)) AS kept_sha256
FROM n LEFT JOIN cut USING (doc_id)"""


# The patterns, in the order of their kinds; the base ones are those of the contract, letters in either case.
_OP8_PATTERNS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
              r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    **secret_scan.WEAK,
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _op8() -> str:
    # A match's neighbours are marked with a private character.
    mark = "chr(57344)"
    found = "\nUNION ALL ".join(
        f"SELECT doc_id, '{kind}' AS kind, {i} AS o, string_split(regexp_replace(coalesce(text, ''), {_quoted('(' + p + ')')}, "
        f"{mark} || '\\1' || {mark}, 'g'), {mark}) AS pieces FROM documents"
        for i, (kind, p) in enumerate(_OP8_PATTERNS.items()))
    return f"""
WITH f AS ({found}),
u AS (SELECT doc_id, kind, o, unnest(pieces) AS hit, unnest(range(len(pieces))) AS i FROM f WHERE len(pieces) > 1),
c AS (SELECT *, sum(length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM u),
p AS (
  SELECT doc_id, kind, o, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, o < 3 AS base,
         CASE WHEN kind IN ('assign', 'hex', 'key') THEN 'secret' WHEN kind IN ('access', 'id') THEN 'name' ELSE 'place' END AS role
  FROM c WHERE i % 2 = 1
    AND (kind <> 'assign' OR length(regexp_extract(hit, '[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6)
    AND (kind <> 'key' OR (regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[0-9]')))),
weak AS (
  SELECT w.doc_id, w.kind, w.o, w.s, w.e
  FROM p w JOIN p n ON w.doc_id = n.doc_id AND greatest(w.s - n.e, n.s - w.e) <= 200 WHERE NOT w.base
  GROUP BY ALL
  HAVING bool_or(CASE WHEN w.kind = 'key' THEN n.role IN ('name', 'place') ELSE n.role = 'secret' END)
     AND NOT bool_or(n.base AND n.s < w.e AND n.e > w.s)),
a AS (SELECT doc_id, kind, o, s, e FROM p WHERE base UNION ALL SELECT * FROM weak),
j AS (
  SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3) AS base,
         count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex
  FROM a GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN j USING (doc_id)"""


# Three marks, four 32-bit numbers of a digest, and lines with their line feeds.
_OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x FROM documents),
h AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1,
         CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(list_slice(l, 1, a), '') AS prefix, array_to_string(list_slice(l, a + 1, b), '') AS middle,
         array_to_string(list_slice(l, b + 1, len(l)), '') AS suffix FROM c)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""

_TERMS = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_OP13 = f"""
WITH d AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
g AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM d),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
i AS (SELECT item_id, term, count(*) AS many FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (
  SELECT item_id, doc_id, CAST(sum(many * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // l))))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN p USING (term) JOIN d USING (doc_id), g GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20"""


#: Not in SQL: XXH64 (op4), trained models (op5, op9), keyed pseudonyms (op6) and a tokenizer (op10, op11); tests check these.
ORACLE: dict[str, str] = {
    "op1_decontamination": _OP1, "op2_substring_dedup": _OP2, "op3_topk_search": _OP3, "op7_suffix_dedup": _OP7, "op8_secrets": _op8(),
    "op12_infilling": _OP12, "op13_ranked_search": _OP13,
}
