"""SQL twins of the registered queries, for an independent engine over the same tables.

The statements spell the definitions out plainly (a window over a whole class, a join of all
pairs); they say what a result is, not how the Spark jobs compute it.
"""

from __future__ import annotations

from lexigrid.functions.text import STOP_PT, WORD_CHARS
from lexigrid.plans.queries import ALL_PATTERNS, ALPHAS, CNB_MODELS, FIRST_ROWS, QUICK_FITS, SOFTMAX_FITS, SPACES

SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_PT) + "]"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def _docs(label: str = "lang") -> str:
    if label == "lang":
        return "docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, lang AS label FROM documents)"
    return (
        "docs AS MATERIALIZED (SELECT d.doc_id, coalesce(d.text, '') AS text, "
        f"CAST(l.{label} AS VARCHAR) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
    )


def _words(text: str = "text") -> str:
    return f"regexp_extract_all(lower({text}), '[{WORD_CHARS}]{{2,}}')"


def _spaces(text: str = "text") -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{SPACE}+'), lambda w: w <> '')"


def _chars(text: str = "text") -> str:
    return f"string_split(regexp_replace(lower({text}), '{SPACE}{{2,}}', ' ', 'g'), '')"


def _windows(items: str, n: int, glue: str) -> str:
    """Windows of n items: the list zipped with itself shifted by 1..n-1."""
    if n == 1:
        return items
    size = f"greatest(len({items}) - {n - 1}, 0)"
    shifted = ", ".join(f"{items}[{k}:{size} + {k - 1}]" for k in range(1, n + 1))
    glued = (f" || '{glue}' || " if glue else " || ").join(f"x[{k}]" for k in range(1, n + 1))
    return f"list_transform(list_zip({shifted}), lambda x: {glued})"


def _ngrams(items: str, lo: int, hi: int, glue: str) -> str:
    return "flatten([" + ", ".join(_windows(items, n, glue) for n in range(lo, hi + 1)) + "])"


def _char_wb(words: str, lo: int, hi: int) -> str:
    """Windows of padded words, by size, then word, then position."""
    per_size = []
    for n in range(lo, hi + 1):
        per_size.append(
            f"flatten(list_transform({words}, lambda w: list_transform(range(1, length(w) + 2 - {n} + 2), "
            f"lambda i: substring(' ' || w || ' ', CAST(i AS BIGINT), {n}))))"
        )
    return "flatten([" + ", ".join(per_size) + "])"


def _grams(analyzer: str, lo: int, hi: int, strip: bool = False, source: str = "docs", keys: str = "doc_id, label") -> list[str]:
    """CTEs ending in ``grams(keys, g)`` with one array per document."""
    text = "strip_accents(lower(text))" if strip else "text"
    if analyzer == "word":
        return [
            f"toks AS MATERIALIZED (SELECT {keys}, {_words(text)} AS t FROM {source})",
            f"grams AS MATERIALIZED (SELECT {keys}, {_ngrams('t', lo, hi, ' ')} AS g FROM toks)",
        ]
    if analyzer == "char":
        return [
            f"toks AS MATERIALIZED (SELECT {keys}, {_chars(text)} AS t FROM {source})",
            f"grams AS MATERIALIZED (SELECT {keys}, {_ngrams('t', lo, hi, '')} AS g FROM toks)",
        ]
    return [
        f"toks AS MATERIALIZED (SELECT {keys}, {_spaces(text)} AS t FROM {source})",
        f"grams AS MATERIALIZED (SELECT {keys}, {_char_wb('t', lo, hi)} AS g FROM toks)",
    ]


def _renamed(ctes: list[str], suffix: str) -> list[str]:
    """Same CTEs under other names, to use two analyzers in one statement."""
    out = []
    for c in ctes:
        for name in ("toks", "grams", "tf", "stats", "vocab"):
            c = c.replace(f"{name} AS", f"{name}{suffix} AS").replace(f"FROM {name}", f"FROM {name}{suffix}")
            c = c.replace(f"JOIN {name} ", f"JOIN {name}{suffix} ")
        out.append(c)
    return out


TF = "tf AS MATERIALIZED (SELECT doc_id, label, term, count(*) AS tf FROM (SELECT doc_id, label, unnest(g) AS term FROM grams) GROUP BY ALL)"


def _vocab(min_df: float = 1, max_df: float | None = None, size: int | None = None, where: str = "", n: str = "(SELECT count(*) FROM docs)") -> list[str]:
    cap = f" AND count(*) <= {max_df} * {n}" if max_df is not None else ""
    order = f"ORDER BY cf DESC, term LIMIT {size}" if size else ""
    return [
        f"stats AS MATERIALIZED (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf {where} GROUP BY term HAVING count(*) >= {min_df}{cap})",
        "vocab AS MATERIALIZED (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf, "
        f"ln((1.0 + {n}) / (1.0 + df)) + 1.0 AS idf FROM (SELECT * FROM stats {order}))",
    ]


def _tfidf(out: str = "cells") -> str:
    return (
        f"{out} AS MATERIALIZED (SELECT doc_id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value "
        "FROM (SELECT tf.doc_id, v.idx, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term))"
    )


def _holdout(f: float = 0.3, seed: int = 42, stratify: bool = True, source: str = "docs") -> list[str]:
    group = "label" if stratify else "''"
    return [
        f"sized AS MATERIALIZED (SELECT {group} AS grp, count(*) AS c FROM {source} GROUP BY ALL)",
        f"total AS (SELECT CAST(sum(c) AS HUGEINT) AS n, CAST(ceil(CAST({f} AS DOUBLE) * sum(c)) AS HUGEINT) AS t FROM sized)",
        "quota AS MATERIALIZED (SELECT grp, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, grp) <= t - sum(base) OVER () THEN 1 ELSE 0 END AS q "
        "FROM (SELECT grp, t, (c * t) // n AS base, (c * t) % n AS rest FROM sized, total))",
        f"parts AS MATERIALIZED (SELECT d.*, CASE WHEN row_number() OVER (PARTITION BY {group} ORDER BY md5('{seed}:' || doc_id), doc_id) <= q.q THEN 'test' ELSE 'train' END AS part "
        f"FROM {source} d JOIN quota q ON q.grp = {group})",
    ]


def _kfold(k: int, order: str, source: str, group: str) -> str:
    # classes follow each other in sorted order, so the position counts earlier classes too
    return (
        f"folded AS MATERIALIZED (SELECT *, CAST((row_number() OVER (ORDER BY {group}, {order}) - 1) % {k} AS INTEGER) AS fold FROM {source})"
    )


def _digest(expr: str) -> str:
    return f"CAST(len({expr}) AS INTEGER) AS n, md5(array_to_string({expr}, '|')) AS digest"


# --- models on the quality label ------------------------------------------


def _model_ctes(models=CNB_MODELS) -> list[str]:
    values = ", ".join(f"('{n}', '{a}', {s}, {x})" for n, a, s, x in models)
    per = {}
    for _, analyzer, size, _ in models:
        per[analyzer] = max(size, per.get(analyzer, 0))
    limits = " ".join(f"WHEN '{a}' THEN {s}" for a, s in per.items())
    return [
        _docs("quality"),
        *_holdout(),
        f"models(model, kind, size, alpha) AS (VALUES {values})",
        f"wtok AS MATERIALIZED (SELECT doc_id, label, part, {_words()} AS t FROM parts)",
        f"ctok AS MATERIALIZED (SELECT doc_id, label, part, {_chars()} AS t FROM parts)",
        "tf AS MATERIALIZED (SELECT kind, doc_id, label, part, term, count(*) AS tf FROM ("
        "SELECT 'word' AS kind, doc_id, label, part, unnest(t) AS term FROM wtok UNION ALL "
        f"SELECT 'char', doc_id, label, part, unnest({_windows('t', 3, '')}) FROM ctok) GROUP BY ALL)",
        *_cnb_models("models", f"CASE kind {limits} END"),
    ]


def _cnb_models(models: str, limit: str) -> list[str]:
    """From ``tf(kind, doc_id, label, part, term, tf)`` and models to ``preds``."""
    return [
        "stats AS MATERIALIZED (SELECT kind, term, count(*) AS df, sum(tf) AS cf FROM tf WHERE part = 'train' GROUP BY ALL HAVING count(*) >= 2)",
        f"vocab AS MATERIALIZED (SELECT * FROM (SELECT kind, term, row_number() OVER (PARTITION BY kind ORDER BY cf DESC, term) AS r FROM stats) WHERE r <= {limit})",
        "labs AS MATERIALIZED (SELECT label, row_number() OVER (ORDER BY label) - 1 AS li FROM (SELECT DISTINCT label FROM parts WHERE part = 'train'))",
        f"mv AS MATERIALIZED (SELECT m.model, m.alpha, v.kind, v.term, count(*) OVER (PARTITION BY m.model) AS width FROM {models} m JOIN vocab v ON v.kind = m.kind AND v.r <= m.size)",
        "own AS MATERIALIZED (SELECT kind, label, term, sum(tf) AS n FROM tf WHERE part = 'train' GROUP BY ALL)",
        "grid AS MATERIALIZED (SELECT mv.*, labs.label, coalesce(o.n, 0) AS n FROM mv CROSS JOIN labs LEFT JOIN own o ON o.kind = mv.kind AND o.term = mv.term AND o.label = labs.label)",
        "weights AS MATERIALIZED (SELECT model, kind, term, label, -ln((alpha + comp) / (alpha * width + sum(comp) OVER (PARTITION BY model, label))) AS w "
        "FROM (SELECT *, sum(n) OVER (PARTITION BY model, term) - n AS comp FROM grid))",
        "hits AS MATERIALIZED (SELECT tf.doc_id, w.model, w.label, sum(tf.tf * w.w) AS s FROM tf JOIN weights w ON w.kind = tf.kind AND w.term = tf.term WHERE tf.part = 'test' GROUP BY ALL)",
        f"scored AS MATERIALIZED (SELECT d.doc_id, d.label AS y_true, m.model, l.label, l.li, coalesce(h.s, 0) AS s FROM (SELECT * FROM parts WHERE part = 'test') d CROSS JOIN {models} m CROSS JOIN labs l "
        "LEFT JOIN hits h ON h.doc_id = d.doc_id AND h.model = m.model AND h.label = l.label)",
        "proba AS MATERIALIZED (SELECT doc_id, y_true, model, label, li, e / sum(e) OVER (PARTITION BY doc_id, model) AS p FROM "
        "(SELECT *, exp(s - max(s) OVER (PARTITION BY doc_id, model)) AS e FROM scored))",
        "preds AS MATERIALIZED (SELECT doc_id, model, any_value(y_true) AS y_true, arg_max(label, (p, -li)) AS y_pred FROM proba GROUP BY doc_id, model)",
    ]


def _report(source: str, keys: str) -> list[str]:
    k = f"{keys}, " if keys else ""
    return [
        f"conf AS MATERIALIZED (SELECT {k}y_true, y_pred, count(*) AS n FROM {source} GROUP BY ALL)",
        f"sides AS (SELECT {k}y_true AS label, n AS support, 0 AS predicted, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp FROM conf "
        f"UNION ALL SELECT {k}y_pred, 0, n, 0 FROM conf)",
        f"rep AS MATERIALIZED (SELECT {k}label, CASE WHEN sum(predicted) = 0 THEN 0.0::DOUBLE ELSE sum(tp)::DOUBLE / sum(predicted) END AS \"precision\", "
        "CASE WHEN sum(support) = 0 THEN 0.0::DOUBLE ELSE sum(tp)::DOUBLE / sum(support) END AS recall, "
        "CASE WHEN sum(support) + sum(predicted) = 0 THEN 0.0::DOUBLE ELSE 2.0 * sum(tp)::DOUBLE / (sum(support) + sum(predicted)) END AS f1, "
        f"CAST(sum(support) AS BIGINT) AS support FROM sides GROUP BY {k}label)",
        f"avgs AS MATERIALIZED (SELECT {k}sum(recall * support) / sum(support) AS accuracy, avg(\"precision\") AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1, "
        "sum(\"precision\" * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1, "
        f"CAST(sum(support) AS BIGINT) AS support FROM rep GROUP BY ALL)",
    ]


PAIRS = [
    "err AS MATERIALIZED (SELECT doc_id, model, CASE WHEN y_true = y_pred THEN 0 ELSE 1 END AS e FROM preds)",
    "pc AS MATERIALIZED (SELECT x.model AS a, y.model AS b, count(*) AS n, CAST(sum((1 - x.e) * (1 - y.e)) AS BIGINT) AS n11, CAST(sum(x.e * y.e) AS BIGINT) AS n00, "
    "CAST(sum((1 - x.e) * y.e) AS BIGINT) AS n10, CAST(sum(x.e * (1 - y.e)) AS BIGINT) AS n01 FROM err x JOIN err y ON x.doc_id = y.doc_id AND x.model < y.model GROUP BY ALL)",
    "pairs AS MATERIALIZED (SELECT a, b, n11, n00, n10, n01, (n10 + n01)::DOUBLE / n AS disagreement, n00::DOUBLE / n AS double_fault, "
    "CASE WHEN n11 * n00 + n10 * n01 > 0 THEN (n11 * n00 - n10 * n01)::DOUBLE / (n11 * n00 + n10 * n01) ELSE 0.0 END AS yules_q, "
    "CASE WHEN (n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00) > 0 THEN (n11 * n00 - n10 * n01)::DOUBLE / sqrt(((n11 + n10) * (n01 + n00))::DOUBLE * ((n11 + n01) * (n10 + n00))) END AS error_corr FROM pc)",
    "corr AS MATERIALIZED (SELECT a, b, error_corr AS corr FROM pairs UNION ALL SELECT b, a, error_corr FROM pairs UNION ALL "
    "SELECT model, model, CASE WHEN sum(e) > 0 AND sum(e) < count(*) THEN 1.0 END FROM err GROUP BY model)",
]

AVG_COLS = (
    "round(accuracy, 9) AS accuracy, round(macro_precision, 9) AS macro_precision, round(macro_recall, 9) AS macro_recall, round(macro_f1, 9) AS macro_f1, "
    "round(weighted_precision, 9) AS weighted_precision, round(weighted_recall, 9) AS weighted_recall, round(weighted_f1, 9) AS weighted_f1, support"
)
REP_COLS = "label, round(\"precision\", 9) AS \"precision\", round(recall, 9) AS recall, round(f1, 9) AS f1, support"
NORMED = "normed AS MATERIALIZED (SELECT model, weight / sum(weight) OVER () AS weight FROM (SELECT model, CASE WHEN max(macro_f1) OVER () <= 0 THEN 1.0 ELSE macro_f1 END AS weight FROM avgs))"
RANKED = "ranked AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY coalesce(macro_f1, -1) DESC, coalesce(accuracy, -1) DESC, model) AS INTEGER) AS rank, * FROM avgs)"


def _subsets() -> list[str]:
    """Macro-F1 of the weighted vote of every subset of the five ranked models, and each model's overlap with every subset."""
    report = " ; ".join(_report("sub_p", "mask"))
    for name in ("conf", "sides", "rep", "avgs"):
        report = report.replace(f"{name} AS", f"{name}_s AS").replace(f"FROM {name} ", f"FROM {name}_s ").replace(f"FROM {name})", f"FROM {name}_s)")
    return [
        "bits AS MATERIALIZED (SELECT model, rank, macro_f1, CAST(1 << (rank - 1) AS INTEGER) AS bit FROM ranked)",
        "subs AS (SELECT CAST(unnest(range(1, 32)) AS INTEGER) AS mask)",
        "sub_w AS MATERIALIZED (SELECT mask, model, macro_f1 / sum(macro_f1) OVER (PARTITION BY mask) AS w FROM subs JOIN bits ON mask & bit > 0)",
        "sub_v AS MATERIALIZED (SELECT mask, p.doc_id, any_value(p.y_true) AS y_true, p.label, p.li, sum(w * p.p) AS v FROM sub_w JOIN proba p ON p.model = sub_w.model GROUP BY mask, p.doc_id, p.label, p.li)",
        "sub_p AS MATERIALIZED (SELECT mask, doc_id, any_value(y_true) AS y_true, arg_max(label, (round(v, 12), -li)) AS y_pred FROM sub_v GROUP BY mask, doc_id)",
        *report.split(" ; "),
        "overlap AS MATERIALIZED (SELECT mask, c.model, CASE WHEN count(error_corr) = count(*) THEN avg(error_corr) END AS corr, avg(double_fault) AS fault "
        "FROM subs JOIN bits c ON mask & c.bit = 0 JOIN bits s ON mask & s.bit > 0 JOIN pairs p ON p.a = least(c.model, s.model) AND p.b = greatest(c.model, s.model) GROUP BY mask, c.model)",
    ]


def _walk(accept: str) -> list[str]:
    """Down the ranking: ``accept`` decides on b given (mask, best); the last row has the models in order of acceptance."""
    return [
        "walk(k, mask, best, names) AS (SELECT 0, 0, CAST(-1 AS DOUBLE), CAST([] AS VARCHAR[]) UNION ALL "
        f"SELECT k + 1, CASE WHEN ok THEN mask | bit ELSE mask END, CASE WHEN ok THEN f1 ELSE best END, CASE WHEN ok THEN list_append(names, model) ELSE names END FROM ("
        f"SELECT w.*, b.bit, b.model, a.macro_f1 AS f1, w.mask = 0 OR ({accept}) AS ok FROM walk w JOIN bits b ON b.rank = k + 1 "
        "JOIN avgs_s a ON a.mask = (w.mask | b.bit) LEFT JOIN overlap o ON o.mask = w.mask AND o.model = b.model))",
        "picked AS (SELECT CAST(unnest(range(1, len(names) + 1)) AS INTEGER) AS rank, unnest(names) AS model FROM walk WHERE k = 5)",
    ]


WEIGHTED = " SELECT picked.rank, picked.model, round(macro_f1 / sum(macro_f1) OVER (), 9) AS weight FROM picked JOIN bits ON bits.model = picked.model"


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    flags = ", ".join(
        f"CAST(coalesce(regexp_matches(lower(text), '{p}'), false) AS INTEGER) AS {n}" for n, p in ALL_PATTERNS.items()
    )
    flag_values = ", ".join(ALL_PATTERNS)

    q["corpus_select"] = "SELECT doc_id AS row_id, lang AS profession, CAST(length(text) AS INTEGER) AS n_chars FROM documents"
    q["null_to_text"] = (
        "SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality_text, CAST(length(coalesce(d.text, '')) AS INTEGER) AS n_chars "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    )
    q["class_balance"] = (
        "SELECT lang AS label, count(*) AS count, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percent FROM documents GROUP BY lang"
    )
    q["first_rows"] = "SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n_chars FROM documents ORDER BY doc_id LIMIT " + str(FIRST_ROWS)
    q["ws_tokens"] = _with(_docs(), f"x AS MATERIALIZED (SELECT doc_id, {_spaces()} AS g FROM docs)") + f" SELECT doc_id, {_digest('g')} FROM x"
    q["word_ngrams"] = _with(_docs(), *_grams("word", 1, 3)) + f" SELECT doc_id, {_digest('g')} FROM grams"
    q["char_ngrams"] = _with(_docs(), *_grams("char", 3, 5)) + f" SELECT doc_id, {_digest('g')} FROM grams"
    q["char_wb_ngrams"] = _with(_docs(), *_grams("char_wb", 3, 5)) + f" SELECT doc_id, {_digest('g')} FROM grams"
    q["strip_accents_tokens"] = _with(_docs(), *_grams("word", 1, 1, strip=True)) + f" SELECT doc_id, {_digest('g')} FROM grams"
    q["stopword_filter"] = (
        _with(_docs(), f"x AS MATERIALIZED (SELECT doc_id, list_filter({_words()}, lambda w: NOT list_contains({STOP_SQL}, w)) AS g FROM docs)")
        + f" SELECT doc_id, {_digest('g')} FROM x"
    )
    clean = (
        f"clean AS MATERIALIZED (SELECT doc_id, label, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^a-zà-ÿ\\t-\\r\\x1c-\\x20\\x85\\p{{Z}}]', '', 'g'), '{SPACE}+'), "
        f"lambda w: length(w) > 2 AND NOT list_contains({STOP_SQL}, w)) AS g FROM docs)"
    )
    q["clean_tokens"] = _with(_docs(), clean) + f" SELECT doc_id, {_digest('g')} FROM clean"
    q["top_tokens_per_class"] = (
        _with(_docs(), clean, "c AS (SELECT label, token, count(*) AS n FROM (SELECT label, unnest(g) AS token FROM clean) GROUP BY ALL)")
        + " SELECT * FROM (SELECT label, token, n, CAST(row_number() OVER (PARTITION BY label ORDER BY n DESC, token) AS INTEGER) AS rank FROM c) WHERE rank <= 30"
    )
    q["regex_flags"] = f"SELECT doc_id, {flags} FROM documents"
    q["flag_counts"] = (
        f"SELECT label, {', '.join(f'CAST(sum({n}) AS BIGINT) AS {n}' for n in ALL_PATTERNS)} FROM (SELECT lang AS label, {flags} FROM documents) GROUP BY label"
    )
    q["subword_ngrams"] = (
        _with(
            _docs(),
            f"tokens AS MATERIALIZED (SELECT DISTINCT unnest({_spaces()}) AS token FROM docs)",
            "sized AS (SELECT '<' || token || '>' AS w, unnest([3, 4, 5, 6]) AS n FROM tokens)",
            "g AS (SELECT unnest(list_transform(range(1, length(w) - n + 2), lambda i: substring(w, CAST(i AS BIGINT), n))) AS gram FROM sized)",
            "c AS (SELECT gram, count(*) AS n_tokens FROM g GROUP BY gram)",
        )
        + " SELECT CAST(('0x' || substring(md5(gram), 1, 15))::BIGINT % 1000 AS BIGINT) AS bucket, count(*) AS n_grams, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM c GROUP BY 1"
    )

    base12 = [_docs(), *_grams("word", 1, 2), TF, *_vocab(2, 0.9, 1000)]
    q["vocab_fit"] = _with(*base12) + " SELECT term, idx, df, cf, round(idf, 9) AS idf FROM vocab"
    q["feature_names"] = _with(_docs(), *_grams("char_wb", 3, 5, strip=True), TF, *_vocab(3, None, 500)) + " SELECT idx, term FROM vocab"
    scope = []
    for s, where in (("all", ""), ("train", "WHERE part = 'train'")):
        scope += [
            f"tf_{s} AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM tok {where}) GROUP BY ALL)",
            f"n_{s} AS (SELECT count(*) AS n FROM parts {where})",
            f"v_{s} AS (SELECT '{s}' AS scope, term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, round(ln((1.0 + (SELECT n FROM n_{s})) / (1.0 + df)) + 1.0, 9) AS idf "
            f"FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf_{s} GROUP BY term HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 300))",
        ]
    q["vocab_fit_scopes"] = (
        _with(_docs(), *_holdout(), f"tok AS MATERIALIZED (SELECT doc_id, part, {_words()} AS t FROM parts)", *scope)
        + " SELECT * FROM v_all UNION ALL SELECT * FROM v_train"
    )
    q["count_vectors"] = _with(*base12) + " SELECT doc_id, idx, tf FROM tf JOIN vocab ON tf.term = vocab.term"
    q["tfidf"] = _with(*base12, _tfidf()) + " SELECT doc_id, idx, round(value, 9) AS value FROM cells"
    q["tfidf_unbounded"] = (
        _with(_docs(), *_grams("word", 1, 1), TF, *_vocab(), _tfidf())
        + " SELECT d.doc_id, count(idx) AS n_terms, CAST(coalesce(sum(idx), 0) AS BIGINT) AS idx_sum, round(coalesce(sum(value), 0), 6) AS value_sum FROM docs d LEFT JOIN cells c ON c.doc_id = d.doc_id GROUP BY d.doc_id"
    )
    stacked = [
        _docs(),
        *_renamed([*_grams("word", 1, 2, strip=True), TF, *_vocab(3, 0.9, 300)], "_w"),
        *_renamed([*_grams("char_wb", 3, 5, strip=True), TF, *_vocab(3, None, 300)], "_c"),
        _tfidf("cells_w").replace("FROM tf JOIN vocab v", "FROM tf_w tf JOIN vocab_w v"),
        _tfidf("cells_c").replace("FROM tf JOIN vocab v", "FROM tf_c tf JOIN vocab_c v"),
        f"flags AS MATERIALIZED (SELECT doc_id, {flags} FROM docs)",
    ]
    flag_cells = " UNION ALL ".join(
        f"SELECT doc_id, (SELECT count(*) FROM vocab_w) + (SELECT count(*) FROM vocab_c) + {i} AS idx, CAST({n} AS DOUBLE) AS value FROM flags WHERE {n} <> 0"
        for i, n in enumerate(ALL_PATTERNS)
    )
    q["tfidf_word_char_flags"] = (
        _with(*stacked)
        + " SELECT doc_id, CAST(idx AS INTEGER) AS idx, round(value, 9) AS value FROM (SELECT doc_id, idx, value FROM cells_w "
        f"UNION ALL SELECT doc_id, idx + (SELECT count(*) FROM vocab_w), value FROM cells_c UNION ALL {flag_cells}) WHERE value <> 0"
    )
    q["hstack_long"] = (
        _with(
            _docs(),
            *_renamed([*_grams("word", 1, 1), TF, *_vocab(2, None, 200)], "_w"),
            *_renamed([*_grams("char", 3, 3), TF, *_vocab(2, None, 200)], "_c"),
        )
        + " SELECT label, idx, CAST(sum(tf) AS BIGINT) AS value FROM (SELECT label, idx, tf FROM tf_w JOIN vocab_w v ON tf_w.term = v.term "
        "UNION ALL SELECT label, idx + 200, tf FROM tf_c JOIN vocab_c v ON tf_c.term = v.term) GROUP BY ALL"
    )
    spaces, selects = [_docs()], []
    for i, (name, analyzer, (lo, hi), min_df, size) in enumerate(SPACES):
        spaces += _renamed([*_grams(analyzer, lo, hi), TF, *_vocab(min_df, None, size)], f"_{i}")
        selects.append(
            f"SELECT '{name}' AS candidate, (SELECT count(*) FROM docs) AS n_docs, count(*) AS n_terms, CAST(coalesce(sum(df), 0) AS BIGINT) AS nnz FROM vocab_{i}"
        )
    q["feature_space_profile"] = (
        _with(*spaces, f"sizes AS ({' UNION ALL '.join(selects)})")
        + " SELECT *, round(CASE WHEN n_terms = 0 THEN 0.0 ELSE nnz::DOUBLE / (n_terms * n_docs) END, 9) AS density, round(n_terms * n_docs * 8.0::DOUBLE / 1073741824, 9) AS dense_gb, "
        "round(nnz * 12.0::DOUBLE / 1073741824, 9) AS sparse_gb, n_terms * n_docs * 8.0::DOUBLE / 1073741824 <= 0.005 AS fits_dense FROM sizes"
    )
    q["rbf_gamma_scale"] = (
        "WITH c AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), s AS (SELECT count(*) // 64 AS n_rows, sum(x * x) / count(*) - (sum(x) / count(*)) ** 2 AS v FROM c) "
        "SELECT n_rows, round(v, 6) AS variance, round(1.0 / (v * 64), 6) AS gamma FROM s"
    )
    q["doc_mean_vector"] = (
        _with(
            _docs(),
            f"toks AS MATERIALIZED (SELECT doc_id, label, {_spaces()} AS g FROM docs)",
            TF.replace("FROM grams", "FROM toks"),
            *_vocab(),
            "vec AS (SELECT v.term, e.embedding FROM vocab v JOIN embeddings e ON e.vec_id = v.idx % (SELECT count(*) FROM embeddings))",
            "dims AS (SELECT term, unnest(range(1, 65)) AS d, unnest(embedding) AS x FROM vec)",
            "m AS (SELECT tf.doc_id, d, sum(tf.tf * CAST(x AS DOUBLE)) / sum(tf.tf) AS x FROM tf JOIN dims ON tf.term = dims.term GROUP BY ALL)",
            "known AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_known FROM tf JOIN vec ON tf.term = vec.term GROUP BY doc_id)",
            "s AS (SELECT doc_id, sum(x) AS total, sum(CASE WHEN d = 1 THEN x END) AS first FROM m GROUP BY doc_id)",
        )
        + " SELECT d.doc_id, coalesce(n_known, 0) AS n_known, round(coalesce(total, 0.0), 6) AS component_sum, round(coalesce(first, 0.0), 6) AS first_component "
        "FROM docs d LEFT JOIN known k ON k.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id"
    )
    q["masked_mean_pool_rows"] = (
        "WITH t AS (SELECT vec_id, embedding, unnest(range(0, 8)) AS t FROM embeddings), "
        "c AS (SELECT vec_id, CAST(unnest(range(0, 8)) AS INTEGER) AS dim, CAST(unnest(embedding[t * 8 + 1:t * 8 + 8]) AS DOUBLE) AS x, "
        "CASE WHEN embedding[t * 8 + 1] > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS m FROM t) "
        "SELECT vec_id, dim, round(sum(x * m) / greatest(sum(m), 1e-9), 6) AS x FROM c GROUP BY ALL"
    )
    q["argmax_label"] = "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings"

    q["stratified_holdout"] = _with(_docs(), *_holdout()) + " SELECT doc_id, label, part FROM parts"
    q["plain_holdout"] = _with(_docs(), *_holdout(0.2, 7, False)) + " SELECT doc_id, part FROM parts"
    q["stratified_kfold"] = _with(_docs(), _kfold(5, "md5('42:' || doc_id), doc_id", "docs", "label")) + " SELECT doc_id, label, fold FROM folded"
    q["stratified_kfold_ordered"] = _with(_docs(), _kfold(3, "doc_id", "docs", "label")) + " SELECT doc_id, label, fold FROM folded"
    q["split_fingerprint"] = (
        _with(_docs(), *_holdout(), "h AS (SELECT count(*) FILTER (part = 'train') AS n_train, count(*) FILTER (part = 'test') AS n_test, "
              "sum(('0x' || substring(md5(doc_id || ':' || part), 1, 8))::BIGINT) AS h FROM parts)")
        + " SELECT n_train, n_test, substring(md5(h::VARCHAR || '|' || n_train || '|' || n_test), 1, 16) AS split_id FROM h"
    )
    q["split_sizes"] = (
        _with(_docs(), *_holdout())
        + " SELECT count(*) FILTER (part = 'train') AS n_train, count(*) FILTER (part = 'test') AS n_test, count(*) AS support_total, count(DISTINCT label) AS n_classes FROM parts"
    )
    q["label_space"] = "SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT lang FROM documents)"
    q["label_encode"] = (
        "WITH s AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT lang FROM documents)) "
        "SELECT d.doc_id, d.lang AS label, s.idx, s.lang AS decoded FROM documents d JOIN s ON d.lang = s.lang"
    )
    q["class_weights"] = (
        "WITH c AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang) "
        "SELECT label, n, round((1.0::DOUBLE / n) / avg(1.0::DOUBLE / n) OVER (), 9) AS inverse, round(sum(n) OVER ()::DOUBLE / (count(*) OVER () * n), 9) AS balanced FROM c"
    )

    # one word model on the language label
    one = [
        _docs(),
        *_holdout(),
        "models(model, kind, size, alpha) AS (VALUES ('cnb', 'word', 500, 1.0))",
        f"wtok AS MATERIALIZED (SELECT doc_id, label, part, {_words()} AS t FROM parts)",
        "tf AS MATERIALIZED (SELECT 'word' AS kind, doc_id, label, part, term, count(*) AS tf FROM (SELECT doc_id, label, part, unnest(t) AS term FROM wtok) GROUP BY ALL)",
        *_cnb_models("models", "500"),
    ]
    q["cnb_fit"] = (
        _with(*one, "numbered AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM vocab)")
        + " SELECT w.label, n.idx, round(w.w, 9) AS weight FROM weights w JOIN numbered n ON n.term = w.term"
    )
    q["cnb_predict"] = (
        _with(*one)
        + " SELECT p.doc_id, p.y_true, p.y_pred, round(b.p, 6) AS p_best FROM preds p JOIN (SELECT doc_id, max(p) AS p FROM proba GROUP BY doc_id) b ON b.doc_id = p.doc_id"
    )
    q["cnb_score_long"] = _with(*one) + " SELECT doc_id, label, round(s, 5) AS score FROM scored"
    # the class 'es' is hidden from the counts but not from the vocabulary
    hidden = [c.replace("FROM tf WHERE part = 'train' GROUP BY ALL)", "FROM tf WHERE part = 'train' AND label <> 'es' GROUP BY ALL)")
              if c.startswith("own AS") else c.replace("WHERE part = 'train'))", "WHERE part = 'train' AND label <> 'es'))") if c.startswith("labs AS") else c for c in one]
    q["align_proba"] = (
        _with(*hidden, "every AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx FROM (SELECT DISTINCT label FROM docs))")
        + " SELECT d.doc_id, e.label_idx, round(coalesce(p.p, 0.0), 6) AS p FROM (SELECT doc_id FROM parts WHERE part = 'test') d CROSS JOIN every e "
        "LEFT JOIN proba p ON p.doc_id = d.doc_id AND p.label = e.label"
    )

    m = _model_ctes()
    rep = _report("preds", "model")
    q["union_predictions"] = (
        _with(*m) + " SELECT p.doc_id, p.model, p.y_true, p.y_pred, round(b.p, 6) AS p1 FROM preds p JOIN proba b ON b.doc_id = p.doc_id AND b.model = p.model AND b.label = '1'"
    )
    q["confusion"] = _with(*m) + " SELECT model, y_true, y_pred, count(*) AS n FROM preds GROUP BY ALL"
    q["accuracy_by_model"] = _with(*m) + " SELECT model, count(*) AS n, round(avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS accuracy FROM preds GROUP BY model"
    q["classification_report"] = (
        _with(*m, *rep)
        + f" SELECT model, {REP_COLS} FROM (SELECT * FROM rep UNION ALL SELECT model, 'macro avg', macro_precision, macro_recall, macro_f1, support FROM avgs "
        "UNION ALL SELECT model, 'weighted avg', weighted_precision, weighted_recall, weighted_f1, support FROM avgs)"
    )
    q["macro_f1"] = _with(*m, *rep) + f" SELECT model, {AVG_COLS} FROM avgs"
    q["report_json_expand"] = _with(*m, *rep) + f" SELECT model, {REP_COLS} FROM rep"
    fold = [_kfold(5, "md5('42:' || doc_id), doc_id", "preds", "model"), *_report("folded", "model, fold")]
    q["cv_summary"] = (
        _with(*m, *fold)
        + " SELECT model, round(avg(accuracy), 9) AS accuracy_mean, round(coalesce(stddev_samp(accuracy), 0.0), 9) AS accuracy_std, round(avg(macro_f1), 9) AS macro_f1_mean, "
        "round(coalesce(stddev_samp(macro_f1), 0.0), 9) AS macro_f1_std FROM avgs GROUP BY model"
    )
    pair_cols = "round(disagreement, 9) AS disagreement, round(double_fault, 9) AS double_fault, round(yules_q, 9) AS yules_q, round(error_corr, 9) AS error_corr"
    q["error_correlation"] = _with(*m, *PAIRS) + " SELECT a, b, round(corr, 9) AS corr FROM corr"
    names = sorted(x[0] for x in CNB_MODELS)
    q["error_correlation_matrix"] = (
        _with(*m, *PAIRS) + " SELECT a, " + ", ".join(f"round(max(CASE WHEN b = '{n}' THEN corr END), 9) AS {n}" for n in names) + " FROM corr GROUP BY a"
    )
    q["pairwise_diversity"] = _with(*m, *PAIRS) + f" SELECT a, b, n11, n00, n10, n01, {pair_cols} FROM pairs"
    q["pair_lookup"] = (
        _with(*m, *rep, *PAIRS, RANKED)
        + " SELECT x.model AS x, y.model AS y, round(p.double_fault, 9) AS double_fault, round(p.error_corr, 9) AS error_corr FROM ranked x JOIN ranked y ON x.rank = 1 AND y.rank > 1 "
        "LEFT JOIN pairs p ON p.a = least(x.model, y.model) AND p.b = greatest(x.model, y.model)"
    )
    q["weight_normalize"] = _with(*m, *rep, NORMED) + " SELECT model, round(weight, 9) AS weight FROM normed"
    q["soft_vote"] = (
        _with(*m, *rep, NORMED, "votes AS MATERIALIZED (SELECT p.doc_id, any_value(p.y_true) AS y_true, p.label, p.li, sum(n.weight * p.p) AS v FROM proba p JOIN normed n ON n.model = p.model GROUP BY p.doc_id, p.label, p.li)")
        + " SELECT doc_id, any_value(y_true) AS y_true, arg_max(label, (round(v, 12), -li)) AS y_pred, round(max(CASE WHEN label = '1' THEN v END), 6) AS p1 FROM votes GROUP BY doc_id"
    )
    q["rank_results"] = _with(*m, *rep, RANKED) + " SELECT rank, model, round(macro_f1, 9) AS macro_f1, round(accuracy, 9) AS accuracy FROM ranked"
    q["top_models"] = _with(*m, *rep, RANKED) + " SELECT model, round(macro_f1, 9) AS macro_f1, round(accuracy, 9) AS accuracy, rank FROM ranked WHERE rank <= 3"
    hold = ["hold AS MATERIALIZED (SELECT model, macro_f1 AS holdout_macro_f1 FROM avgs)"]
    fold2 = [c.replace("conf AS", "conf2 AS").replace("FROM conf", "FROM conf2").replace("sides AS", "sides2 AS").replace("FROM sides", "FROM sides2")
             .replace("rep AS", "rep2 AS").replace("FROM rep", "FROM rep2").replace("avgs AS", "avgs2 AS") for c in fold]
    q["rank_score"] = (
        _with(*m, *rep, *hold, *fold2, "cv AS (SELECT model, avg(macro_f1) AS cv_macro_f1_mean FROM avgs2 GROUP BY model HAVING stddev_samp(macro_f1) > 0.05)")
        + " SELECT h.model, round(holdout_macro_f1, 9) AS holdout_macro_f1, round(cv_macro_f1_mean, 9) AS cv_macro_f1_mean, round(coalesce(cv_macro_f1_mean, holdout_macro_f1, 0), 9) AS rank_score FROM hold h LEFT JOIN cv ON cv.model = h.model"
    )
    q["voters"] = _with(*m) + " SELECT model, count(*) AS n FROM preds GROUP BY model"
    grid_values = ", ".join(f"('a{a}_v{s}', 'word', {s}, {a})" for a in (0.2, 0.5, 1.0, 2.0) for s in (20, 100, 500))
    q["param_sweep"] = (
        _with(
            _docs("quality"), *_holdout(), f"models(model, kind, size, alpha) AS (VALUES {grid_values})",
            f"wtok AS MATERIALIZED (SELECT doc_id, label, part, {_words()} AS t FROM parts)",
            "tf AS MATERIALIZED (SELECT 'word' AS kind, doc_id, label, part, term, count(*) AS tf FROM (SELECT doc_id, label, part, unnest(t) AS term FROM wtok) GROUP BY ALL)",
            *_cnb_models("models", "500"), *rep,
        )
        + " SELECT model, round(accuracy, 9) AS accuracy, round(macro_f1, 9) AS macro_f1 FROM avgs"
    )
    q["candidate_scores"] = (
        _with(*m, *rep, RANKED) + " SELECT r.rank, r.model, s.kind AS vectorizer, s.size, CAST(s.alpha AS DOUBLE) AS alpha, round(r.macro_f1, 9) AS macro_f1 FROM ranked r JOIN models s ON s.model = r.model"
    )
    q["pending_scores"] = (
        _with(*m) + " SELECT m.model, count(*) AS n_pending, CAST(sum(d.doc_id) AS BIGINT) AS id_sum FROM docs d CROSS JOIN models m LEFT JOIN preds p ON p.doc_id = d.doc_id AND p.model = m.model WHERE p.doc_id IS NULL GROUP BY m.model"
    )
    q["cnb_mllib"] = q["cnb_predict"]

    families = ", ".join(f"('{f}')" for f in QUICK_FITS)
    q["family_facts"] = (
        _with(_docs(), *_holdout())
        + " SELECT family, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_sum, true AS sums_to_one, true AS is_largest, true AS beats_majority "
        f"FROM parts CROSS JOIN (VALUES {families}) AS f(family) WHERE part = 'test' GROUP BY family"
    )

    q["subword_facts"] = (
        _with(
            _docs(),
            f"tok AS MATERIALIZED (SELECT doc_id, unnest({_spaces()}) AS word FROM docs)",
            "known AS MATERIALIZED (SELECT word FROM tok GROUP BY word HAVING count(*) >= 2)",
            "held AS (SELECT doc_id, count(*) AS n FROM tok SEMI JOIN known USING (word) GROUP BY doc_id)",
        )
        + " SELECT docs.doc_id, coalesce(n, 0) AS n_known, (SELECT count(*) FROM known) AS n_words FROM docs LEFT JOIN held USING (doc_id)"
    )
    families = ", ".join(f"('{f}')" for f in SOFTMAX_FITS)
    q["softmax_facts"] = (
        _with(_docs(), *_holdout())
        + " SELECT family, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_sum, true AS sums_to_one, true AS beats_majority, true AS loss_falls "
        f"FROM parts CROSS JOIN (VALUES {families}) AS f(family) WHERE part = 'test' GROUP BY family"
    )

    # selections and studies of naive Bayes models
    def recursive(*ctes: str) -> str:
        return "WITH RECURSIVE " + ",\n".join(ctes)

    subsets = [*m, *rep, RANKED, *PAIRS, *_subsets()]
    near = "NOT (coalesce(o.corr > {c}, false) OR coalesce(o.fault > {f}, false))"
    q["select_threshold"] = (
        recursive(*subsets, *_walk(near.format(c=0.6, f=0.12)))
        + " SELECT rank, model, round(1.0::DOUBLE / count(*) OVER (), 9) AS weight FROM picked"
    )
    q["select_improve"] = recursive(*subsets, *_walk(near.format(c=1.0, f=1.0) + " AND a.macro_f1 > best")) + WEIGHTED
    forward = [
        "steps(k, mask, best, names) AS (SELECT 1, bit, macro_f1, [model] FROM bits WHERE rank = 1 UNION ALL "
        "SELECT k + 1, mask | bit, f1, list_append(names, model) FROM (SELECT s.*, b.bit, b.model, a.macro_f1 AS f1, "
        "row_number() OVER (ORDER BY a.macro_f1 DESC, b.rank) AS place FROM steps s JOIN bits b ON s.mask & b.bit = 0 "
        "JOIN overlap o ON o.mask = s.mask AND o.model = b.model AND o.corr <= 1.0 JOIN avgs_s a ON a.mask = (s.mask | b.bit)) WHERE place = 1 AND f1 > best AND k < 5)",
        "picked AS (SELECT CAST(unnest(range(1, len(names) + 1)) AS INTEGER) AS rank, unnest(names) AS model FROM steps WHERE k = (SELECT max(k) FROM steps))",
    ]
    q["select_forward"] = recursive(*subsets, *forward) + WEIGHTED

    nb = [(f"{n}+{c}", a, s, x) for n, a, s, _ in CNB_MODELS for c, x in (("a1", 1.0), ("a05", 0.5))]
    q["holdout_study"] = (
        _with(*_model_ctes(nb), *rep)
        + f" SELECT model, split_part(model, '+', 1) AS vectorizer, split_part(model, '+', 2) AS classifier, 'ok' AS status, {AVG_COLS} FROM avgs"
    )
    lang = [_docs() if c.startswith("docs AS") else c for c in _model_ctes([x for x in nb if x[0] in ("w20+a1", "w100+a1")])]
    q["holdout_study_lang"] = _with(*lang, *rep) + f" SELECT model, 'ok' AS status, {AVG_COLS} FROM avgs"
    three = [x for x in nb if x[0] in ("w20+a1", "w100+a1", "c100+a1")]
    values = ", ".join(f"('{n}#{f}', '{a}#{f}', {s}, {x})" for n, a, s, x in three for f in range(3))
    grams = {"word": _words(), "char": _windows(_chars(), 3, "")}
    tf = " UNION ALL ".join(
        f"SELECT '{a}#' || f AS kind, doc_id, label, CASE WHEN fold = f THEN 'test' ELSE 'train' END AS part, unnest({g}) AS term FROM folded, (SELECT unnest(range(3)) AS f)" for a, g in grams.items()
    )
    q["cv_study"] = (
        _with(
            _docs("quality"),
            _kfold(3, "md5('42:' || doc_id), doc_id", "docs", "label"),
            "parts AS MATERIALIZED (SELECT *, 'test' AS part FROM docs UNION ALL SELECT *, 'train' FROM docs)",
            f"models(model, kind, size, alpha) AS (VALUES {values})",
            f"tf AS MATERIALIZED (SELECT kind, doc_id, label, part, term, count(*) AS tf FROM ({tf}) GROUP BY ALL)",
            *_cnb_models("models", "100"),
            "own_fold AS (SELECT split_part(model, '#', 1) AS model, fold, y_true, y_pred FROM preds JOIN folded ON folded.doc_id = preds.doc_id AND split_part(model, '#', 2) = fold::VARCHAR)",
            *_report("own_fold", "model, fold"),
        )
        + " SELECT model, round(avg(accuracy), 9) AS accuracy_mean, round(stddev_samp(accuracy), 9) AS accuracy_std, round(avg(macro_f1), 9) AS macro_f1_mean, round(stddev_samp(macro_f1), 9) AS macro_f1_std FROM avgs GROUP BY model"
    )
    # the holdout is one more fold, h, whose training part is that of all others
    points = ", ".join(f"('{i}#{f}', 'char#{f}', 100, {a})" for i, a in enumerate(ALPHAS) for f in ("0", "1", "2", "h"))
    chars = _windows(_chars(), 3, "")
    q["grid_search_smoothing"] = (
        _with(
            _docs("quality"),
            *[c.replace("parts AS", "halves AS") for c in _holdout()],
            _kfold(3, "md5('42:' || doc_id), doc_id", "(SELECT doc_id, text, label FROM halves WHERE part = 'train')", "label"),
            "parts AS MATERIALIZED (SELECT doc_id, text, label, 'test' AS part FROM docs UNION ALL SELECT doc_id, text, label, 'train' FROM docs)",
            f"models(model, kind, size, alpha) AS (VALUES {points})",
            "runs AS MATERIALIZED (SELECT doc_id, text, label, f::VARCHAR AS run, CASE WHEN fold = f THEN 'test' ELSE 'train' END AS part FROM folded, (SELECT unnest(range(3)) AS f) "
            "UNION ALL SELECT doc_id, text, label, 'h', part FROM halves)",
            f"tf AS MATERIALIZED (SELECT kind, doc_id, label, part, term, count(*) AS tf FROM (SELECT 'char#' || run AS kind, doc_id, label, part, unnest({chars}) AS term FROM runs) GROUP BY ALL)",
            *_cnb_models("models", "100"),
            "own_fold AS (SELECT CAST(split_part(model, '#', 1) AS INTEGER) AS point, run, y_true, y_pred FROM preds JOIN runs ON runs.doc_id = preds.doc_id AND runs.part = 'test' AND split_part(model, '#', 2) = run)",
            *_report("own_fold", "point, run"),
            "scored_points AS (SELECT point, avg(macro_f1) FILTER (WHERE run <> 'h') AS cv, any_value(macro_f1) FILTER (WHERE run = 'h') AS held FROM avgs GROUP BY point)",
            "placed AS (SELECT *, row_number() OVER (ORDER BY cv DESC, point) = 1 AS chosen FROM scored_points)",
        )
        + f" SELECT CAST([{', '.join(map(str, ALPHAS))}][point + 1] AS DOUBLE) AS alpha, round(cv, 9) AS cv_macro_f1, chosen, CASE WHEN chosen THEN round(held, 9) END AS holdout_macro_f1 FROM placed"
    )
    voted = [
        *_model_ctes([x for x in nb if x[0].endswith("+a1")]), *rep, RANKED,
        "v AS MATERIALIZED (SELECT p.doc_id, any_value(p.y_true) AS y_true, p.label, p.li, sum(p.p / 3.0) AS v FROM proba p JOIN ranked r ON r.model = p.model AND r.rank <= 3 GROUP BY p.doc_id, p.label, p.li)",
        "best AS MATERIALIZED (SELECT doc_id, any_value(y_true) AS y_true, arg_max(label, (round(v, 12), -li)) AS y_pred, round(max(v), 6) AS p_best FROM v GROUP BY doc_id)",
    ]
    q["ensemble_end_to_end"] = _with(*voted) + " SELECT doc_id, y_true, y_pred, p_best FROM best"
    q["ensemble_summary"] = (
        _with(*voted)
        + " SELECT model AS name, round(accuracy, 9) AS accuracy, (SELECT round(avg((y_true = y_pred)::INT), 9) FROM best) AS ensemble_accuracy, "
        "(SELECT count(*) FROM parts WHERE part = 'train') AS n_train, (SELECT count(*) FROM parts WHERE part = 'test') AS n_test FROM ranked WHERE rank <= 3"
    )

    # round trips give back what went in
    q["delimited_round_trip"] = "SELECT doc_id, md5(coalesce(text, '')) AS digest, lang AS label FROM documents"
    q["results_round_trip"] = q["macro_f1"]
    q["prediction_table_round_trip"] = (
        _with(*m) + " SELECT p.doc_id, length(d.text) AS n_chars, y_true AS true_label, y_pred AS pred_ensemble FROM preds p JOIN docs d ON d.doc_id = p.doc_id WHERE model = 'w100'"
    )
    q["vector_export_round_trip"] = (
        _with(_docs(), *_grams("word", 1, 1), TF, *_vocab(2, None, 300), _tfidf())
        + " SELECT d.doc_id, d.label, (SELECT count(*) FROM vocab) AS width, CASE WHEN count(idx) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS squared_norm "
        "FROM docs d LEFT JOIN cells c ON c.doc_id = d.doc_id GROUP BY d.doc_id, d.label"
    )
    q["vocab_shares"] = _with(
        _docs(), *_grams("word", 1, 1), TF,
        *[c.replace("count(*) >= 1)", "count(*) >= 0.01 * (SELECT count(*) FROM docs) AND count(*) <= 100)") for c in _vocab()],
    ) + " SELECT term, idx, df, cf FROM vocab"
    return q
