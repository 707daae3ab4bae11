"""SQL twins of the training-data queries that SQL can express, for DuckDB."""

from __future__ import annotations

from . import quality, secret_scan


def quality_sql() -> str:
    rates = {"symbol_rate": "n_symbols * 10000 // greatest(word_chars, 1)", "word_length": "word_chars * 100 // greatest(n_words, 1)", "dup_line_rate": "n_dup_lines * 1000 // greatest(n_lines, 1)"}
    pairs = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS measure, {e} AS v FROM m WHERE n_words >= {quality.MIN_WORDS}" for k, e in rates.items())

    def quantiles(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
{name}_r AS (SELECT {by}measure, bin, sum(n) OVER (PARTITION BY {by}measure ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}measure) AS total
  FROM (SELECT {by}measure, bin, sum(n) AS n FROM sketch GROUP BY {by}measure, bin)),
{name} AS (SELECT {by}measure, max(total) AS total, min(bin) FILTER (WHERE upto >= ceil(total * 0.05::DOUBLE)) AS low, min(bin) FILTER (WHERE upto >= ceil(total * 0.5::DOUBLE)) AS mid FROM {name}_r GROUP BY {by}measure)"""

    def limit(measure: str, sign: int, name: str) -> str:
        wide = f"{quality.SPREAD} * (mid - low)"
        span = f"greatest({wide}, {quality.MARGINS[measure]})" if measure == "word_length" else f"{wide} + {quality.MARGINS[measure]}"
        return f"max(mid + {sign} * ({span})) FILTER (WHERE measure = '{measure}') AS {name}"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1) GROUP BY rid),
m AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[{quality.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON cov.rid = w.rid),
sketch AS (SELECT lang, source, measure, v - v % CAST(2 ** greatest(length(bin(v)) - 8, 0) AS BIGINT) AS bin, count(*) AS n FROM ({pairs}) GROUP BY ALL),
{quantiles("g", "lang, source")}, {quantiles("l", "lang")}, {quantiles("c", "")},
chosen AS (SELECT g.lang, g.source, g.measure,
    CASE WHEN g.total >= {quality.MIN_GROUP} THEN g.low WHEN l.total >= {quality.MIN_GROUP} THEN l.low ELSE c.low END AS low,
    CASE WHEN g.total >= {quality.MIN_GROUP} THEN g.mid WHEN l.total >= {quality.MIN_GROUP} THEN l.mid ELSE c.mid END AS mid
  FROM g JOIN l ON l.lang IS NOT DISTINCT FROM g.lang AND l.measure = g.measure JOIN c ON c.measure = g.measure),
limits AS (SELECT lang, source, {limit("symbol_rate", 1, "s")}, {limit("word_length", -1, "lo")}, {limit("word_length", 1, "hi")}, {limit("dup_line_rate", 1, "dup")} FROM chosen GROUP BY lang, source),
j AS (SELECT m.*, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
    coalesce({rates["symbol_rate"]} <= s AND {rates["word_length"]} BETWEEN lo AND hi AND {rates["dup_line_rate"]} <= dup, false) AS fine
  FROM m LEFT JOIN limits x ON x.lang IS NOT DISTINCT FROM m.lang AND x.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fine AS kept FROM j"""


def secrets_sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def spans(name: str, pattern: str, kind: int) -> str:
        p = quoted(pattern)
        return f"""
{name}_m AS (SELECT rid, t, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}) AS hits FROM d WHERE regexp_matches(t, {p})),
{name}_p AS (SELECT rid, hits[i] AS hit, CAST(list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0) AS BIGINT) AS a FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM {name}_m)),
{name} AS (SELECT rid, {kind} AS kind, a, a + length(hit) AS b, hit FROM {name}_p)"""

    head = quoted("^" + secret_scan.ASSIGN_HEAD)
    table = "[" + ", ".join(map(str, secret_scan.C_LOG_C)) + "]"
    width = secret_scan.WINDOW
    chars = f"list_transform(range({width}), lambda k: substring(run, s + k, 1))"
    words = f"len(list_filter(string_split_regex(hit, {quoted(secret_scan.SEPARATORS)}), lambda p: NOT (length(p) <= {secret_scan.WORD_MOST} AND regexp_matches(p, {quoted(secret_scan.WORD_FORM)})))) = 0"
    allowed = " OR ".join([f"contains(lower(hit), '{w}')" for w in secret_scan.ALLOWED_WORDS] + [f"regexp_matches(hit, {quoted(f)})" for f in secret_scan.ALLOWED_FORMS] + [words])
    text = "string_agg(['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || CAST(a AS VARCHAR) || ':' || CAST(b AS VARCHAR), ',' ORDER BY a, kind, b)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{spans("sa", secret_scan.ASSIGN, 0)}, {spans("sk", secret_scan.ACCESS, 1)}, {spans("sh", secret_scan.HEX, 2)}, {spans("sc", secret_scan.CANDIDATE, 3)},
base AS (SELECT rid, kind, a, b FROM sa WHERE length(regexp_replace(hit, {head}, '')) >= 12 UNION ALL SELECT rid, kind, a, b FROM sk UNION ALL SELECT rid, kind, a, b FROM sh),
bare AS (SELECT DISTINCT rid, a, b FROM (SELECT rid, a, b, unnest(range(a, b)) AS p FROM sc) c WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = c.rid AND base.a <= c.p AND c.p < base.b)),
own AS (SELECT rid, a, b, regexp_replace(hit, {quoted(secret_scan.KEYBOARD_RUNS)}, '', 'g') AS run FROM sc JOIN bare USING (rid, a, b) WHERE NOT ({allowed})),
runs AS (SELECT rid, a, b, run, {secret_scan.most_sum(secret_scan.MIXED_BITS)} AS most FROM own
  UNION ALL SELECT rid, a, b, run, {secret_scan.most_sum(secret_scan.HEX_BITS)} FROM (SELECT rid, a, b, unnest(regexp_extract_all(run, {quoted(secret_scan.HEX_RUN)})) AS run FROM own WHERE length(run) >= {width}) WHERE regexp_matches(run, '[0-9]') AND regexp_matches(run, '[a-fA-F]')),
sums AS (SELECT rid, a, b, most, run, s, sum({table}[n + 1]) AS total FROM (SELECT rid, a, b, most, run, s, c, count(*) AS n FROM (SELECT rid, a, b, most, run, s, unnest({chars}) AS c FROM (SELECT *, unnest(range(1, length(run) - {width} + 2)) AS s FROM runs)) GROUP BY ALL) GROUP BY rid, a, b, most, run, s),
entropy AS (SELECT DISTINCT rid, 3 AS kind, a, b FROM sums WHERE total <= most),
spans AS (SELECT rid, kind, a, b FROM base UNION ALL SELECT rid, kind, a, b FROM entropy),
g AS (SELECT rid, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  {text.replace("ORDER BY a, kind, b)", "ORDER BY a, kind, b) FILTER (WHERE kind < 3)")} AS base, {text} AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)"""


SQL = {"op2_quality": quality_sql(), "op10_secrets": secrets_sql()}
