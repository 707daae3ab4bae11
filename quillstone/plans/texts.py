"""Text functions as queries: cleaning, patterns, classification, quotes, vocabulary and field evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import quotes, similarity
from ..sources import views as v
from .registry import register


def docs(spark, sf_dir):
    return v.table(spark, sf_dir, "documents")


@register("f01_normalize_space", "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS clean FROM documents")
def f01(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(x.normalize_space(F.col("text"))).alias("clean"))


@register("f02_fix_digits", "SELECT c_custkey, array_to_string(list_transform(string_split(t, ' '), lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN translate(w, 'ОоOoЗбІIl', '000036111') ELSE w END), ' ') AS fixed FROM (SELECT c_custkey, 'Oslo 1О' || CAST(c_custkey AS VARCHAR) || ' Зб2l lb' AS t FROM customer)")
def f02(spark, sf_dir):
    t = F.concat(F.lit("Oslo 1О"), F.col("c_custkey").cast("string"), F.lit(" Зб2l lb"))
    return v.table(spark, sf_dir, "customer").select("c_custkey", x.fix_digits(t).alias("fixed"))


DATED = "CASE o_orderkey % 5 WHEN 0 THEN 'on ' || strftime(o_orderdate, '%Y-%m-%d') || '.' WHEN 1 THEN 'on ' || strftime(o_orderdate, '%-d.%-m.%Y') WHEN 2 THEN 'since 31.02.2001' WHEN 3 THEN 'to ' || strftime(o_orderdate, '%-d.%-m.%y') ELSE 'never' END"


def dated():
    d = F.col("o_orderdate")
    return F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("on "), F.date_format(d, "yyyy-MM-dd"), F.lit("."))).when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("on "), F.date_format(d, "d.M.yyyy"))).when(F.col("o_orderkey") % 5 == 2, "since 31.02.2001").when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("to "), F.date_format(d, "d.M.yy"))).otherwise("never")


@register("f04_date_search", f"SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) WHEN 3 THEN try_cast('20' || strftime(o_orderdate, '%y-%m-%d') AS DATE) END AS day, {DATED} LIKE 'since%' AS impossible FROM orders")
def f04(spark, sf_dir):
    return v.table(spark, sf_dir, "orders").select("o_orderkey", x.date_of(dated()).alias("day"), x.impossible_date(dated()).alias("impossible"))


# Number words.
NUMBERS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())} | {w: 20 + 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split())}


@register("f06_number_words", "SELECT o_orderkey, CAST(CASE WHEN k < 21 OR k % 10 = 0 THEN k ELSE k END AS INTEGER) AS number FROM (SELECT o_orderkey, o_orderkey % 100 AS k FROM orders)")
def f06(spark, sf_dir):
    words = F.create_map(*[c for w, n in NUMBERS.items() for c in (F.lit(w), F.lit(n))])
    names = F.create_map(*[c for w, n in NUMBERS.items() for c in (F.lit(n), F.lit(w))])
    k = (F.col("o_orderkey") % 100).cast("int")
    said = F.when((k < 20) | (k % 10 == 0), names[k]).otherwise(F.concat_ws(" ", names[(k - k % 10).cast("int")], names[(k % 10).cast("int")]))
    total = F.aggregate(F.split(said, " "), F.lit(0), lambda a, w: a + words[w])
    return v.table(spark, sf_dir, "orders").select("o_orderkey", total.alias("number"))


@register("f11_field_extraction", "SELECT doc_id, CASE WHEN len(m) = 1 THEN m[1] END AS value, CASE WHEN len(m) = 0 THEN 'missing' WHEN len(m) > 1 THEN 'ambiguous' END AS reason FROM (SELECT doc_id, list_distinct(regexp_extract_all(text, '([0-9]{3}-[0-9]{4})', 1)) AS m FROM documents)")
def f11(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", x.one_match(F.col("text"), r"([0-9]{3}-[0-9]{4})").alias("m")).select("doc_id", "m.value", "m.reason")


DOMAINS = {"de": (" der ", " die ", " und "), "en": (" the ", " and ", " of "), "es": (" el ", " los ", " y "), "fr": (" les ", " et ", " des ")}


def domain_scores_sql() -> str:
    rows = []
    for k, words in DOMAINS.items():
        score = " + ".join([f"3 * CAST(contains(head, '{w}') AS INTEGER) + CAST(contains(body, '{w}') AS INTEGER)" for w in words])
        rows.append(f"SELECT doc_id, '{k}' AS domain, {score} AS score FROM t")
    return " UNION ALL ".join(rows)


@register("f14_domain_classifier", f"WITH t AS (SELECT doc_id, lower(substring(text, 1, 200)) AS head, lower(text) AS body FROM documents), s AS ({domain_scores_sql()}), r AS (SELECT *, max(score) OVER (PARTITION BY doc_id) AS best FROM s), g AS (SELECT doc_id, min(domain) FILTER (WHERE score = best) AS domain, count(*) FILTER (WHERE score = best) AS ties, any_value(best) AS score FROM r GROUP BY doc_id) SELECT doc_id, CASE WHEN ties = 1 AND score >= 3 THEN domain END AS domain, CAST(score AS INTEGER) AS score FROM g")
def f14(spark, sf_dir):
    """Title hits weigh three, body hits one; a tie or too little evidence gives no domain."""
    body, head = F.lower("text"), F.lower(F.substring("text", 1, 200))
    scores = F.array(*[F.struct(F.lit(k).alias("domain"), sum((3 * head.contains(w).cast("int") + body.contains(w).cast("int") for w in words), F.lit(0)).alias("score")) for k, words in DOMAINS.items()])
    d = docs(spark, sf_dir).select("doc_id", scores.alias("s")).withColumn("best", F.array_max(F.transform("s", lambda e: e["score"])))
    won = F.filter("s", lambda e: e["score"] == F.col("best"))
    return d.select("doc_id", F.when((F.size(won) == 1) & (F.col("best") >= 3), won[0]["domain"]).alias("domain"), F.col("best").alias("score"))


@register("f17_field_confidence", v.sql(v.FACTS_SQL, body="SELECT source_doc_id, min(least(CASE json_extract_string(info, '$.method') WHEN 'm0' THEN 1.0 WHEN 'm1' THEN 0.9 ELSE 0.6 END::DOUBLE, coalesce(confidence, 0.5))) AS confidence, bool_and(valid_from IS NOT NULL) AS complete FROM facts GROUP BY source_doc_id"))
def f17(spark, sf_dir):
    method = F.get_json_object("info", "$.method")
    base = F.when(method == "m0", 1.0).when(method == "m1", 0.9).otherwise(0.6)
    return v.facts(spark, sf_dir).groupBy("source_doc_id").agg(F.min(F.least(base, F.coalesce("confidence", F.lit(0.5)))).alias("confidence"), F.bool_and(F.col("valid_from").isNotNull()).alias("complete"))


@register("f19_queue_priority", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body="SELECT id, CASE WHEN service_id IS NULL THEN 'new_person' WHEN json_extract_string(info, '$.date_range_error') <> '' THEN 'date_conflict' WHEN confidence < 0.5 THEN 'low_confidence' END AS queue_type FROM facts LEFT JOIN people USING (object_id)"))
def f19(spark, sf_dir):
    f = v.facts(spark, sf_dir).join(v.people(spark, sf_dir), "object_id", "left")
    return f.select("id", F.when(F.col("service_id").isNull(), "new_person").when(F.get_json_object("info", "$.date_range_error") != "", "date_conflict").when(F.col("confidence") < 0.5, "low_confidence").alias("queue_type"))


@register("f31_verbatim_quotes", "SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(lower(regexp_replace(d.text, '\\s+', ' ', 'g')), trim(lower(regexp_replace(b.text, '\\s+', ' ', 'g'))))")
def f31(spark, sf_dir):
    """Which benchmark passages stand verbatim in which documents, apostrophes, dashes, case and white space aside."""
    b = v.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("quote"))
    return quotes.holders(b, docs(spark, sf_dir).select("doc_id", "text"), "doc_id", x.fold_quote).select(F.col("query_id").alias("item_id"), "doc_id")


LEX = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\\pL\\pN]+'), lambda w: length(w) > 1))"


@register("f32_question_overlap", f"WITH c AS (SELECT conv_id, min(text) FILTER (WHERE turn = 0) AS q, min(text) FILTER (WHERE turn = 1) AS a FROM conversations GROUP BY conv_id), l AS (SELECT conv_id, {LEX.format('q')} AS q, {LEX.format('a')} AS a FROM c WHERE q IS NOT NULL AND a IS NOT NULL) SELECT conv_id, round(CASE WHEN len(q) = 0 THEN 1.0 ELSE len(list_intersect(q, a)) / len(q)::DOUBLE END, 6) AS share FROM l")
def f32(spark, sf_dir):
    turn = lambda n: F.min(F.when(F.col("turn") == n, F.col("text")))
    c = v.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turn(0).alias("q"), turn(1).alias("a")).filter("q is not null and a is not null")
    q, a = F.array_distinct(x.lexemes(F.col("q"))), F.array_distinct(x.lexemes(F.col("a")))
    share = F.when(F.size(q) == 0, 1.0).otherwise(F.size(F.array_intersect(q, a)) / F.size(q))
    return c.select("conv_id", F.round(share, 6).alias("share"))


@register("f34_unknown_terms", f"WITH asked AS (SELECT DISTINCT unnest({LEX.format('text')}) AS term FROM conversations WHERE role = 'user'), known AS (SELECT DISTINCT unnest({LEX.format('text')}) AS term FROM documents) SELECT term FROM asked WHERE term NOT IN (SELECT term FROM known)")
def f34(spark, sf_dir):
    terms = lambda df: df.select(F.explode(x.lexemes(F.col("text"))).alias("term")).distinct()
    asked = terms(v.table(spark, sf_dir, "conversations").filter("role = 'user'"))
    return asked.join(terms(docs(spark, sf_dir)), "term", "left_anti")


@register("p05_name_pattern", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)(^|[^\\pL])thing[\\pL]{0,4}([^\\pL]|$)')")
def p05(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.col("text").rlike(x.name_pattern("things"))).select("doc_id")


@register("p15_phrase_predicate", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)(^|[^\\pL\\pN_])of\\s+the([^\\pL\\pN_]|$)')")
def p15(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.col("text").rlike(x.phrase_pattern("of the"))).select("doc_id")


@register("p16_blank_values", "SELECT c_custkey FROM (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' N/A ' WHEN 2 THEN '____' WHEN 3 THEN '– . –' ELSE c_name END AS t FROM customer) WHERE t IS NULL OR lower(trim(t)) IN ('', '-', 'none', 'n/a', 'null') OR regexp_matches(t, '^[\\s_.\\-–—]*$')")
def p16(spark, sf_dir):
    k = F.col("c_custkey") % 6
    t = F.when(k == 0, None).when(k == 1, " N/A ").when(k == 2, "____").when(k == 3, "– . –").otherwise(F.col("c_name"))
    return v.table(spark, sf_dir, "customer").withColumn("t", t).filter(x.is_blank(F.col("t"))).select("c_custkey")


@register("p17_scope_filter", v.sql(v.REGISTRY_SQL, body="SELECT 'procedural' AS scope, id FROM registry WHERE domain = 'normative' AND validity = 'current' UNION ALL SELECT 'factual', id FROM registry WHERE domain IN ('leave', 'deployment')"))
def p17(spark, sf_dir):
    r = v.registry(spark, sf_dir).select("id", "domain", "validity")
    return r.filter("domain = 'normative' and validity = 'current'").select(F.lit("procedural").alias("scope"), "id").unionAll(r.filter("domain in ('leave', 'deployment')").select(F.lit("factual").alias("scope"), "id"))


@register("f38_evaluator_compare", """
WITH p AS (SELECT o_orderkey, o_orderkey % 6 AS k, o_orderdate, c_name, c_mktsegment, o_orderkey // 6 AS j FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT o_orderkey, ['date', 'number', 'name', 'category', 'contains', 'text'][k + 1] AS kind, CASE k
  WHEN 0 THEN j % 3 = 0 AND j % 5 <> 0 WHEN 1 THEN j % 50 = j % 75 WHEN 2 THEN j % 4 <> 0
  WHEN 3 THEN (j % 3 = 0 AND c_mktsegment = 'MACHINERY') OR (j % 3 = 1 AND c_mktsegment = 'BUILDING') OR (j % 3 = 2 AND c_mktsegment = 'HOUSEHOLD')
  WHEN 4 THEN right(c_name, 1) = CAST(j % 10 AS VARCHAR) OR contains(c_name, '0' || CAST(j % 10 AS VARCHAR)) ELSE j % 7 <> 0 END AS equal FROM p""")
def f38(spark, sf_dir):
    """Fields compared by kind: dates as dates, numbers as numbers, names as bags of words, categories by alias, parts, texts."""
    p = v.table(spark, sf_dir, "orders").join(v.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    j, kind = F.expr("o_orderkey div 6"), F.get(F.array(*[F.lit(k) for k in x.FIELD_KINDS]), (F.col("o_orderkey") % 6).cast("int"))
    later = F.date_format(F.date_add("o_orderdate", (j % 3).cast("int")), "yyyy-MM-dd")
    alias = F.get(F.array(*[F.lit(a) for a in ("machines", "building trade", "home")]), (j % 3).cast("int"))
    got = {
        "date": F.date_format("o_orderdate", "d.M.yyyy"),
        "number": F.lpad((j % 50).cast("string"), 4, "0"),
        "name": F.concat_ws(" ", F.upper("c_mktsegment"), F.col("c_name")),
        "category": F.lower("c_mktsegment"),
        "contains": F.concat("c_name", F.lit(" "), (j % 3).cast("string")),
        "text": F.concat(F.lit("  Said\t"), F.col("c_name"), F.lit("  ’so’ ")),
    }
    want = {
        "date": F.when(j % 5 == 0, F.lit("30.02.2001")).otherwise(later),
        "number": F.concat((j % 75).cast("string"), F.lit(" days")),
        "name": F.concat_ws(" ", F.initcap("c_name"), F.lower("c_mktsegment"), F.when(j % 4 == 0, F.lit("x"))),
        "category": alias,
        "contains": F.when(F.expr("right(c_name, 1)") == (j % 10).cast("string"), F.substring("c_name", 2, 30)).otherwise(F.concat(F.lit("0"), (j % 10).cast("string"))),
        "text": F.concat(F.lit("said "), F.lower("c_name"), F.lit(" 'so'"), F.when(j % 7 == 0, F.lit("!")).otherwise(F.lit(""))),
    }
    pick = lambda by: F.coalesce(*[F.when(kind == k, c) for k, c in by.items()])
    known = {"machines": "machinery", "building trade": "building", "home": "household"}
    return p.select("o_orderkey", kind.alias("kind"), pick(got).alias("got"), pick(want).alias("want")).select("o_orderkey", "kind", x.fields_agree(F.col("kind"), F.col("got"), F.col("want"), known).alias("equal"))


@register("k07_closest_names")
def k07(spark, sf_dir):
    """The three names most like each asked one, in whole or in a word, by matching-block ratio, of at least 0.55."""
    names = v.people(spark, sf_dir).select("object_id", "name")
    asked = v.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("query_id"), F.col("s_name").alias("asked"))
    return similarity.closest(names, asked, least=0.55, k=3)


@register("j10_similar_heads")
def j10(spark, sf_dir):
    """Each document with its class of documents whose heads of 3,000 characters are alike (ratio 0.60 or more)."""
    return similarity.similar_heads(docs(spark, sf_dir).select("doc_id", "text"))
