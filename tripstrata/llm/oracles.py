"""The operators' results as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

_COMPONENTS = """
reach AS (
  SELECT id AS node, id AS other FROM nodes
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

_NEAR = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * k >= 80 * (s.n + t.n - k)),
nodes AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN component ON node = documents.doc_id"""

_EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id
  WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.95),
nodes AS (SELECT id FROM v),
{_COMPONENTS},
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept
FROM component LEFT JOIN degrees ON a = node"""

#: Measure, its numerator and denominator, floor, whether it has a lower limit.
_MEASURES = (
    ("word_length", "word_chars", "n_words", 500, True), ("symbols", "n_symbols", "n_words", 100, False),
    ("dup_lines", "n_dup_lines", "n_lines", 400, False), ("repeat_words", "n_repeat_words", "n_words", 200, False),
)


def _value(top: str, base: str) -> str:
    return f"CASE WHEN {base} > 0 THEN ({top} * 1000) // {base} ELSE 0 END"


_ROOM = "greatest(4.0 * (high - low), floor) * sqrt(greatest(1.0, 200 / greatest(n_words, 1)))"

_QUALITY = rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k
  FROM (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split))),
repeats AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM windows, (SELECT unnest(range(5)) AS d) WHERE k > 1 GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (doc_id)),
long AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, n_words, '{m}' AS measure, {_value(a, b)} AS v, {f} AS floor, {two} AS two_sided FROM counted" for m, a, b, f, two in _MEASURES)}),
places AS (SELECT *, CAST(greatest(length(bin(v)) - 10, 0) AS INTEGER) AS s FROM long),
binned AS (SELECT *, (v >> s) << s AS bin FROM places),
own AS (
  SELECT lang, source, measure, count(*) AS docs, quantile_disc(bin, 0.25) AS low, quantile_disc(bin, 0.75) AS high
  FROM binned WHERE n_words > 0 GROUP BY ALL),
of_lang AS (
  SELECT lang, measure, count(*) AS docs, quantile_disc(bin, 0.25) AS low, quantile_disc(bin, 0.75) AS high
  FROM binned WHERE n_words > 0 GROUP BY ALL),
of_all AS (SELECT measure, quantile_disc(bin, 0.25) AS low, quantile_disc(bin, 0.75) AS high FROM binned WHERE n_words > 0 GROUP BY ALL),
limits AS (
  SELECT own.lang, own.source, own.measure,
    CASE WHEN own.docs >= 200 THEN own.low WHEN of_lang.docs >= 200 THEN of_lang.low ELSE of_all.low END AS low,
    CASE WHEN own.docs >= 200 THEN own.high WHEN of_lang.docs >= 200 THEN of_lang.high ELSE of_all.high END AS high
  FROM own JOIN of_lang ON of_lang.measure = own.measure AND of_lang.lang IS NOT DISTINCT FROM own.lang JOIN of_all ON of_all.measure = own.measure),
judged AS (
  SELECT doc_id, bool_and(v <= high + {_ROOM} AND (NOT two_sided OR v >= low - {_ROOM})) AS good
  FROM long JOIN limits ON limits.measure = long.measure AND limits.lang IS NOT DISTINCT FROM long.lang AND limits.source IS NOT DISTINCT FROM long.source
  GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(good, false) AS kept
FROM counted LEFT JOIN judged USING (doc_id)"""

#: CRC-32 of a decimal number's text, bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))))"""

_TRIE = rf"""
WITH own AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT own.c, list_concat(coalesce(head.turns[:h], []), own.turns[h + 1:]) AS s
  FROM (SELECT c, turns, {_CRC} % 4 AS h FROM own) AS own LEFT JOIN own AS head ON head.c = own.c - own.c % 20),
paths AS (SELECT c, s, d, s[:d] AS node FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(s) = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(list_filter(regexp_split_to_array(node[d].text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS own
  FROM paths GROUP BY node, d),
children AS (SELECT node[:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
below AS (
  SELECT node[:up] AS node, count_if(n_children = 0) AS n_leaves, sum(own) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM counted) GROUP BY ALL)
SELECT counted.conv_id, CAST(counted.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, counted.n_convs, n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, counted.ends_sha256
FROM counted JOIN below USING (node) LEFT JOIN nodes AS parent ON counted.d > 0 AND parent.node = counted.node[:counted.d - 1]"""

ORACLES: dict[str, str] = {
    "op4_minhash_near_dups": _NEAR,
    "op7_quality_rules": _QUALITY,
    "op10_embedding_near_dups": _EMBEDDINGS,
    "op11_prefix_trie": _TRIE,
}
