"""SQL twins of the operators' queries, written independently of them for another engine."""

from __future__ import annotations

#: Substrings: every window of 50 words, numbered within its document; a word goes if a window over it stands in an earlier document.
OP3 = r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM t WHERE len(w) >= 50),
keyed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM win),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed GROUP BY k),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM keyed JOIN firsts USING (k) WHERE first < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM t),
kept AS (
    SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) FILTER (WHERE hit.p IS NULL) AS rest, count(hit.p) AS n_removed
    FROM word LEFT JOIN hit ON word.doc_id = hit.doc_id AND word.p = hit.p GROUP BY word.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

#: Quality rules. Lines are normalised like the operator's: lower case, digits to 0, blanks to one space, trimmed.
OP5 = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
t AS (
    SELECT doc_id, source, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d),
gram AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM t WHERE len(w) >= 5),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM gram),
twice AS (SELECT doc_id, k FROM keyed GROUP BY doc_id, k HAVING count(*) > 1),
spread AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM keyed JOIN twice USING (doc_id, k)) GROUP BY doc_id),
line AS (SELECT doc_id, source, unnest(lines) AS x FROM t),
normal AS (
    SELECT doc_id, source, trim(regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '\s+', ' ', 'g'), ' ') AS x,
           len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
    FROM line),
counts AS (SELECT source, x, count(DISTINCT doc_id) AS n_docs FROM normal GROUP BY source, x),
hosts AS (SELECT source, count(DISTINCT doc_id) AS all_docs FROM normal GROUP BY source),
frequent AS (SELECT source, x FROM counts JOIN hosts USING (source) WHERE n_docs > 3 AND n_docs * 20 > all_docs),
share AS (
    SELECT doc_id, sum(n) FILTER (WHERE f.x IS NOT NULL) / sum(n) AS share
    FROM normal LEFT JOIN frequent f ON normal.source = f.source AND normal.x = f.x GROUP BY doc_id),
base AS (
    SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(spread.n, 0) AS BIGINT) AS n_repeat_words, coalesce(share.share, 0) AS share
    FROM t LEFT JOIN spread USING (doc_id) LEFT JOIN share USING (doc_id)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CAST(round(share * n_words) AS BIGINT) AS n_boilerplate FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_boilerplate,
       NOT base_failed AND NOT (share > 0 AND (share > 0.8 OR n_words - n_boilerplate < 10)) AS kept
FROM failed
"""

#: Suffix array: every string of 200 bytes; the bytes are characters of a text whose bytes are looked at one by one.
OP7 = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
piece AS (
    SELECT doc_id, pos, substring(h, CAST(2 * pos + 1 AS BIGINT), 1198) AS h
    FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) / 2 AS BIGINT), 400)) AS pos FROM t)),
win AS (SELECT doc_id, pos, unnest(range(0, CAST(len(h) / 2 AS BIGINT) - 199)) AS j, h FROM piece WHERE len(h) >= 400),
keyed AS (SELECT doc_id, pos + j AS i, substring(h, CAST(2 * j + 1 AS BIGINT), 400) AS k FROM win),
again AS (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM keyed JOIN again USING (k)),
turn AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM hit),
runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM turn),
span AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
gap AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
rest AS (
    SELECT t.doc_id, any_value(h) AS h, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(a) AS n_spans,
           coalesce(string_agg(substring(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a), '') AS head, coalesce(max(b), 0) AS last
    FROM t LEFT JOIN gap ON t.doc_id = gap.doc_id GROUP BY t.doc_id)
SELECT doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, n_removed, n_spans, sha256(unhex(head || substring(h, CAST(2 * last + 1 AS BIGINT)))) AS kept_sha256
FROM rest
"""

#: Decontamination: windows of items against windows of documents, for each length that items have.
OP8 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(13, len(w)) AS n FROM bw WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
lengths AS (SELECT DISTINCT n FROM grams),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n),
found AS (SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM places) p JOIN grams g ON p.n = g.n AND p.k = g.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Mixing: sources capped round by round, then blocks in the order of their hashes, each taken if it still fits.
OP9 = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size,
           CAST(CAST('0x' || substring(md5('7/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 1024 AS INT) AS block
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source),
rounds(round, source, s, w, target, capped) AS (
    SELECT 0, source, s, w, CAST(w AS DOUBLE) * sum(s) OVER () / sum(w) OVER (), false FROM sources
    UNION ALL
    SELECT round + 1, source, s, w,
           CASE WHEN stop THEN 3.0 * s ELSE w * (total - sum(CASE WHEN stop THEN 3.0 * s ELSE 0 END) OVER ()) / sum(CASE WHEN stop THEN 0 ELSE w END) OVER () END, stop
    FROM (SELECT *, capped OR target > 3 * s AS stop, sum(s) OVER () AS total, max(CASE WHEN NOT capped AND target > 3 * s THEN 1 ELSE 0 END) OVER () AS more FROM rounds)
    WHERE more = 1),
target AS (SELECT source, s, CAST(target AS DOUBLE) AS target, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS whole FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
blocks AS (
    SELECT b.source, block, words, whole, target - whole * s AS rest,
           row_number() OVER (PARTITION BY b.source ORDER BY md5('7/' || coalesce(b.source, '') || '/' || block), block) AS i
    FROM (SELECT source, block, CAST(sum(size) AS BIGINT) AS words FROM sized GROUP BY source, block) b JOIN target t ON b.source IS NOT DISTINCT FROM t.source),
fill(source, i, room, block, times) AS (
    SELECT source, i, rest - CASE WHEN words <= rest THEN words ELSE 0 END, block, whole + CASE WHEN words <= rest THEN 1 ELSE 0 END FROM blocks WHERE i = 1
    UNION ALL
    SELECT b.source, b.i, room - CASE WHEN words <= room THEN words ELSE 0 END, b.block, whole + CASE WHEN words <= room THEN 1 ELSE 0 END
    FROM fill JOIN blocks b ON b.source IS NOT DISTINCT FROM fill.source AND b.i = fill.i + 1)
SELECT doc_id, size, s AS source_size, target, CAST(size * times AS BIGINT) AS taken
FROM sized JOIN fill ON sized.source IS NOT DISTINCT FROM fill.source AND sized.block = fill.block JOIN target ON sized.source IS NOT DISTINCT FROM target.source
"""

#: Vectors: all pairs of a label, then what can be reached from each vector. Copies and scaled vectors are pairs like any other.
OP12 = r"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS i, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS (
    SELECT * FROM v
    WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pair AS (
    SELECT a.i AS a, b.i AS b FROM usable a JOIN usable b ON a.label = b.label AND a.i <> b.i AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM pair UNION SELECT r.a, p.b FROM reach r JOIN pair p ON r.b = p.a),
least AS (SELECT r.a AS i, min(v.vec_id) AS least FROM reach r JOIN v ON r.b = v.i GROUP BY r.a),
degree AS (SELECT a AS i, count(*) AS n FROM pair GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, CAST(least(vec_id, least) AS BIGINT) AS component_id, vec_id IS NOT DISTINCT FROM least(vec_id, least) AS kept
FROM v LEFT JOIN degree USING (i) LEFT JOIN least USING (i)
"""

#: Runs: words q apart are equal over at least 16 places of any run, so equal windows of 16 words give every period; the places of one
#: period are cut where they are not consecutive; a period goes where a smaller one covers the same words. CRC-32 is bit by bit.
OP13 = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           xor(list_reduce(
               list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END), 4294967295) AS h
    FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM e),
t AS MATERIALIZED (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w
    FROM f),
win AS (SELECT doc_id, unnest(range(0, n - 15)) AS i, w FROM t WHERE n >= 16),
keyed AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS k FROM win),
twice AS MATERIALIZED (SELECT doc_id, i, k FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
apart AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM twice x JOIN twice y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM apart),
long AS (SELECT doc_id, q, min(i) AS s, max(i) + 16 + q AS e FROM island GROUP BY doc_id, q, part HAVING max(i) + 16 + q - min(i) >= greatest(24, 3 * q)),
run AS MATERIALIZED (SELECT * FROM long x WHERE NOT EXISTS (SELECT 1 FROM long y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.e >= x.e)),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
           first({'s': s, 'l': e - s, 'q': q} ORDER BY (e - s) / q DESC, s, q) AS best
    FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM run),
word AS (SELECT doc_id, unnest(range(0, n)) AS i, unnest(w) AS word FROM t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
       CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

STATEMENTS = {
    "op3_substrings": OP3, "op5_line_rules": OP5, "op7_suffix_array": OP7, "op8_decontaminate": OP8, "op9_mixing": OP9, "op12_vector_join": OP12,
    "op13_periodic_runs": OP13,
}
