"""Fields, records, joins and orders: the smaller operators of extraction, retrieval upkeep and answers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import guard, quotes
from ..operators import retrieval as r
from ..operators import temporal as t
from ..sources import views as v
from .registry import register


@register("p10_guarded_cast", "SELECT c_custkey, CASE WHEN regexp_matches(s, '^\\d{4}-\\d{2}-\\d{2}$') THEN try_cast(s AS DATE) END AS day FROM (SELECT c_custkey, '2026-02-' || CAST(c_custkey % 40 AS VARCHAR) AS s FROM customer)")
def p10(spark, sf_dir):
    s = F.concat(F.lit("2026-02-"), (F.col("c_custkey") % 40).cast("string"))
    return v.table(spark, sf_dir, "customer").select("c_custkey", F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s.try_cast("date")).alias("day"))


@register("p13_folded_containment", "SELECT doc_id FROM documents WHERE contains(translate(regexp_replace(lower(text), '\\s+', ' ', 'g'), 'aceiopxy', 'асеіорху'), translate('the and', 'aceiopxy', 'асеіорху'))")
def p13(spark, sf_dir):
    fold = lambda c: F.translate(F.regexp_replace(F.lower(c), r"\s+", " "), "aceiopxy", "асеіорху")
    return v.table(spark, sf_dir, "documents").filter(F.contains(fold(F.col("text")), fold(F.lit("the and")))).select("doc_id")


@register("p14_siblings_null_safe", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON nullif(a.n_regionkey, 2) IS NOT DISTINCT FROM nullif(b.n_regionkey, 2) AND a.n_nationkey < b.n_nationkey")
def p14(spark, sf_dir):
    n = v.table(spark, sf_dir, "nation").select("n_nationkey", F.nullif("n_regionkey", F.lit(2)).alias("parent"))
    a, b = n.toDF("a", "pa"), n.toDF("b", "pb")
    return a.join(b, F.col("pa").eqNullSafe(F.col("pb")) & (F.col("a") < F.col("b"))).select("a", "b")


@register("j01_star_join", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, v.REGISTRY_SQL, body="SELECT f.id, p.name, p.subdivision, d.domain FROM facts f JOIN people p USING (object_id) JOIN registry d ON d.id = f.source_doc_id WHERE f.status = 'confirmed'"))
def j01(spark, sf_dir):
    docs = v.registry(spark, sf_dir).select(F.col("id").alias("source_doc_id"), "domain")
    return v.facts(spark, sf_dir).filter("status = 'confirmed'").join(v.people(spark, sf_dir), "object_id").join(docs, "source_doc_id").select("id", "name", "subdivision", "domain")


@register("j03_first_attribute", v.sql(v.FACTS_SQL, body="SELECT f.id, n.value AS doc_number, p.value AS place FROM facts f LEFT JOIN (SELECT source_doc_id, value, row_number() OVER (PARTITION BY source_doc_id ORDER BY id) AS rn FROM facts WHERE dimension = '4-NOT SPECIFIED') n ON n.source_doc_id = f.source_doc_id AND n.rn = 1 LEFT JOIN (SELECT source_doc_id, value, row_number() OVER (PARTITION BY source_doc_id ORDER BY id) AS rn FROM facts WHERE dimension = '5-LOW') p ON p.source_doc_id = f.source_doc_id AND p.rn = 1 WHERE f.dimension = '1-URGENT'"))
def j03(spark, sf_dir):
    f = v.facts(spark, sf_dir)
    attributes = t.attributes(f, {v.NUMBER: "doc_number", v.PLACE: "place"})
    return f.filter("dimension = '1-URGENT'").join(attributes, "source_doc_id", "left").select("id", "doc_number", "place")


@register("j05_numbers_of_both_sides", v.sql(v.FACTS_SQL, "pairs AS (SELECT a.id AS a_id, b.id AS b_id, a.source_doc_id AS da, b.source_doc_id AS db FROM facts a JOIN facts b ON a.object_id = b.object_id AND a.dimension = b.dimension AND a.id < b.id AND a.status = 'confirmed' AND b.status = 'confirmed' AND a.valid_from <= coalesce(b.valid_to, b.valid_from) AND b.valid_from <= coalesce(a.valid_to, a.valid_from))", body="SELECT a_id, b_id, (SELECT min(value) FROM facts WHERE source_doc_id = da AND dimension = '4-NOT SPECIFIED') AS a_number, (SELECT min(value) FROM facts WHERE source_doc_id = db AND dimension = '4-NOT SPECIFIED') AS b_number FROM pairs"))
def j05(spark, sf_dir):
    f = v.facts(spark, sf_dir)
    pairs = t.overlaps(f.filter("status = 'confirmed'"), "point", ["dimension"]).select("a_id", "b_id")
    numbers = f.filter(F.col("dimension") == v.NUMBER).groupBy("source_doc_id").agg(F.min("value").alias("number"))
    of = f.select("id", "source_doc_id").join(numbers, "source_doc_id", "left").select("id", "number")
    return pairs.join(of.toDF("a_id", "a_number"), "a_id").join(of.toDF("b_id", "b_number"), "b_id")


@register("j07_exists_subdivision", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body="SELECT id FROM facts f WHERE EXISTS (SELECT 1 FROM people p WHERE p.object_id = f.object_id AND p.subdivision = 'NATION_3') AND status = 'confirmed'"))
def j07(spark, sf_dir):
    return v.facts(spark, sf_dir).filter("status = 'confirmed'").join(v.people(spark, sf_dir).filter("subdivision = 'NATION_3'"), "object_id", "left_semi").select("id")


@register("j12_progressive_names", "WITH w AS (SELECT c_custkey, unnest(string_split(lower(c_mktsegment) || ' ' || CAST(c_nationkey AS VARCHAR), ' ')) AS word FROM customer), q AS (SELECT s_suppkey, unnest(['machinery', CAST(s_nationkey AS VARCHAR), 'nobody']) AS word FROM supplier), hits AS (SELECT s_suppkey, c_custkey, count(*) AS n FROM q JOIN w USING (word) GROUP BY 1, 2), best AS (SELECT *, max(n) OVER (PARTITION BY s_suppkey) AS top FROM hits) SELECT s_suppkey, count(*) AS candidates, min(c_custkey) AS first_id FROM best WHERE n = top GROUP BY s_suppkey")
def j12(spark, sf_dir):
    """Candidates that share most words with the question; a word that nobody has narrows nothing.

    Candidates of the same words are counted before they meet questions, and questions of the same words are one.
    """
    own = v.table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.split(F.concat_ws(" ", F.lower("c_mktsegment"), F.col("c_nationkey").cast("string")), " ")).alias("word"))
    asked = v.table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(F.lit("machinery"), F.col("s_nationkey").cast("string"), F.lit("nobody"))).alias("word"))
    words = lambda df, key: df.groupBy(key).agg(F.sort_array(F.collect_list("word")).alias("words"))  # noqa: E731, the words of a name
    alike = words(own, "c_custkey").groupBy("words").agg(F.count("*").alias("candidates"), F.min("c_custkey").alias("first_id"))
    questions = words(asked, "s_suppkey").withColumnRenamed("words", "question")
    kinds = questions.select("question").distinct().select("question", F.explode("question").alias("word"))
    hits = kinds.join(alike.withColumn("word", F.explode("words")), "word").groupBy("question", "words", "candidates", "first_id").agg(F.count("*").alias("n"))
    counts = hits.groupBy("question", "n").agg(F.sum("candidates").alias("candidates"), F.min("first_id").alias("first_id"))
    best = counts.groupBy("question").agg(F.max_by(F.struct("candidates", "first_id"), "n").alias("best"))
    return questions.join(best, "question").select("s_suppkey", "best.*")


@register("j15_any_of_terms", "SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM (SELECT unnest(['shingou', 'handat', 'leué']) AS term) WHERE contains(lower(text), term))")
def j15(spark, sf_dir):
    terms = F.array(*[F.lit(w) for w in ("shingou", "handat", "leué")])
    return v.table(spark, sf_dir, "documents").filter(F.exists(terms, lambda w: F.contains(F.lower("text"), w))).select("doc_id")


@register("k01_top_by_score", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 70")
def k01(spark, sf_dir):
    return v.table(spark, sf_dir, "events").orderBy(F.desc("value"), "event_id").limit(70).select("event_id", "value")


@register("k02_null_order", v.sql(v.FACTS_SQL, body="SELECT id, CAST(row_number() OVER (PARTITION BY object_id ORDER BY valid_to ASC NULLS FIRST, valid_from DESC NULLS LAST, id) AS INTEGER) AS place FROM facts"))
def k02(spark, sf_dir):
    order = Window.partitionBy("object_id").orderBy(F.asc_nulls_first("valid_to"), F.desc_nulls_last("valid_from"), "id")
    return v.facts(spark, sf_dir).select("id", F.row_number().over(order).alias("place"))


@register("k04_truncate_and_report", v.sql(v.FACTS_SQL, body="SELECT object_id, least(count(*), 12) AS shown, greatest(count(*) - 12, 0) AS left_out FROM facts WHERE status <> 'rejected' GROUP BY object_id"))
def k04(spark, sf_dir):
    n = F.count("*")
    return v.facts(spark, sf_dir).filter("status <> 'rejected'").groupBy("object_id").agg(F.least(n, F.lit(12)).cast("long").alias("shown"), F.greatest(n - 12, F.lit(0)).cast("long").alias("left_out"))


@register("k04_shown_conflicts", v.sql(v.FACTS_SQL, body="SELECT object_id, id, total - 12 AS left_out FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY valid_from DESC NULLS LAST, id) AS n, count(*) OVER (PARTITION BY object_id) AS total FROM facts WHERE status <> 'rejected') WHERE n <= 12 AND total > 12"))
def k04_shown(spark, sf_dir):
    """Of each list that is too long, the twelve rows shown and how many are left out."""
    f = v.facts(spark, sf_dir).filter("status <> 'rejected'").select("object_id", "id", "valid_from")
    long_ = f.groupBy("object_id").agg((F.count("*") - 12).alias("left_out")).filter("left_out > 0")
    order = Window.partitionBy("object_id").orderBy(F.desc_nulls_last("valid_from"), "id")
    shown = f.withColumn("n", F.row_number().over(order)).filter("n <= 12")
    return shown.join(long_, "object_id").select("object_id", "id", "left_out")


@register("k03_enforced_limit", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 200")
def k03(spark, sf_dir):
    """A query that others write gets the outermost limit, whatever limits it holds inside."""
    v.table(spark, sf_dir, "orders").createOrReplaceTempView("k03_orders")
    return guard.ask(spark, "SELECT o_custkey, count(*) AS n FROM (SELECT * FROM k03_orders LIMIT 1000000000) GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 100000", {"k03_orders"})


@register("k06_geometry_sort", "SELECT l_orderkey, array_to_string(list(CAST(l_linenumber AS VARCHAR) ORDER BY CAST(l_quantity AS BIGINT), l_extendedprice, l_linenumber), ',') AS lines FROM lineitem GROUP BY l_orderkey")
def k06(spark, sf_dir):
    """Blocks of a page in reading order: by the top edge, then the left one."""
    box = F.struct(F.col("l_quantity").cast("long").alias("y1"), F.col("l_extendedprice").alias("x1"), "l_linenumber")
    lines = F.transform(F.array_sort(F.collect_list(box)), lambda b: b["l_linenumber"].cast("string"))
    return v.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(lines, ",").alias("lines"))


@register("f16_subject_kind", v.sql(v.REGISTRY_SQL, body="SELECT id, coalesce(CASE WHEN id % 11 = 0 THEN 'equipment' END, CASE domain WHEN 'leave' THEN 'person' WHEN 'deployment' THEN 'person' WHEN 'normative' THEN 'act' END, CASE WHEN contains(text, '@') THEN 'person' END, 'unknown') AS kind FROM registry"))
def f16(spark, sf_dir):
    schema = F.when(F.col("id") % 11 == 0, "equipment")
    domain = F.when(F.col("domain").isin("leave", "deployment"), "person").when(F.col("domain") == "normative", "act")
    return v.registry(spark, sf_dir).select("id", F.coalesce(schema, domain, F.when(F.contains("text", F.lit("@")), "person"), F.lit("unknown")).alias("kind"))


@register("f18_record_builder", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body="SELECT source_doc_id, count(*) AS n_facts, count(*) FILTER (WHERE name IS NULL OR valid_from IS NULL) AS unresolved, string_agg(DISTINCT name, '|' ORDER BY name) AS subjects, min(confidence) AS confidence FROM facts LEFT JOIN people USING (object_id) WHERE status <> 'rejected' GROUP BY source_doc_id"))
def f18(spark, sf_dir):
    """A record a document: its facts as an array of structs, subjects, what stays unresolved, and the least confidence."""
    f = v.facts(spark, sf_dir).filter("status <> 'rejected'").join(v.people(spark, sf_dir).select("object_id", "name"), "object_id", "left")
    one = F.struct("id", "dimension", "value", "valid_from", "valid_to", "status", "confidence", "name")
    record = f.groupBy("source_doc_id").agg(F.array_sort(F.collect_list(one)).alias("facts"))
    get = lambda n: F.transform("facts", lambda s: s[n])
    return record.select(
        "source_doc_id", F.size("facts").cast("long").alias("n_facts"), F.size(F.filter("facts", lambda s: s["name"].isNull() | s["valid_from"].isNull())).cast("long").alias("unresolved"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(get("name"), lambda s: s.isNotNull()))), "|").alias("subjects"), F.array_min(get("confidence")).alias("confidence"),
    )


@register("f18_record_provenance", v.sql(v.FACTS_SQL, "docs AS (SELECT DISTINCT object_id, source_doc_id FROM facts WHERE status <> 'rejected')", "n AS (SELECT object_id, count(*) AS n FROM docs GROUP BY object_id)", "l AS (SELECT d.source_doc_id, sum(n.n - 1) AS links FROM docs d JOIN n USING (object_id) GROUP BY d.source_doc_id)", body="SELECT source_doc_id, string_agg(dimension || '=' || value || '@' || id || ':' || coalesce(CAST(round(confidence * 100) AS BIGINT), 50), '; ' ORDER BY id) AS provenance, CAST(any_value(links) AS BIGINT) AS links FROM facts JOIN l USING (source_doc_id) WHERE status <> 'rejected' GROUP BY source_doc_id"))
def f18_provenance(spark, sf_dir):
    """A record a document: where each of its values comes from, how sure it is, and its links to others by their subjects."""
    f = v.facts(spark, sf_dir).filter("status <> 'rejected'")
    docs = f.select("object_id", "source_doc_id").distinct()
    links = docs.join(docs.groupBy("object_id").agg((F.count("*") - 1).alias("others")), "object_id").groupBy("source_doc_id").agg(F.sum("others").alias("links"))
    sure = F.coalesce(F.round(F.col("confidence") * 100).cast("long"), F.lit(50)).cast("string")
    said = F.struct("id", F.concat("dimension", F.lit("="), "value", F.lit("@"), F.col("id").cast("string"), F.lit(":"), sure).alias("said"))
    of = f.groupBy("source_doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(said)), lambda s: s["said"]), "; ").alias("provenance"))  # a document's facts
    return of.join(links, "source_doc_id")


@register("f25_rrf_logical_units", "WITH a AS (SELECT doc_id // 10 AS unit, doc_id, 'a' AS branch, row_number() OVER (ORDER BY length(text) DESC, doc_id) AS rank FROM documents QUALIFY rank <= 70), b AS (SELECT doc_id // 10, doc_id, 'b', row_number() OVER (ORDER BY md5(text), doc_id) AS rank FROM documents QUALIFY rank <= 70), u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT unit, round(sum(1.0::DOUBLE / (60 + rank)), 8) AS rrf, count(DISTINCT branch) AS branches, string_agg(DISTINCT CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR)) AS parts FROM u GROUP BY unit")
def f25(spark, sf_dir):
    """Rank fusion where parts of one unit count together."""
    d = v.table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"), F.md5("text").alias("h"))
    one = d.orderBy(F.desc("n"), "doc_id").limit(70).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "doc_id"))).withColumn("branch", F.lit("a"))
    two = d.orderBy("h", "doc_id").limit(70).withColumn("rank", F.row_number().over(Window.orderBy("h", "doc_id"))).withColumn("branch", F.lit("b"))
    both = one.unionByName(two).withColumn("unit", F.expr("doc_id div 10"))
    return both.groupBy("unit").agg(F.round(F.sum(1.0 / (60 + F.col("rank"))), 8).alias("rrf"), F.count_distinct("branch").alias("branches"), F.array_join(F.array_sort(F.collect_set(F.col("doc_id").cast("string"))), ",").alias("parts"))


@register("f30_rerank_with_guard", "WITH c AS (SELECT label, vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS s FROM embeddings), x AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY a DESC, vec_id) AS ra, row_number() OVER (PARTITION BY label ORDER BY b DESC, vec_id) AS rb FROM c), pool AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rs FROM x WHERE ra <= 20) SELECT label, vec_id FROM pool WHERE rs <= 3 UNION SELECT label, vec_id FROM x WHERE ra = 1 OR rb = 1")
def f30(spark, sf_dir):
    """The pool's three best by a second score, and the first of each branch, whatever that score says."""
    c = v.table(spark, sf_dir, "embeddings").select("label", "vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate("abs")])
    best = r.top(r.top(c, 20, "vec_id", by="a", group="label").drop("rank"), 3, "vec_id", by="s", group="label")  # each keeps its best before anything moves
    guard = [r.top(c, 1, "vec_id", by=n, group="label").select("label", "vec_id") for n in "ab"]
    return best.select("label", "vec_id").union(guard[0]).union(guard[1]).distinct()


# Abbreviations with what they stand for, and one that stands for something else.
DECLARED = (("Збройних Сил України", "ЗСУ"), ("несанкціонований доступ", "НСД"), ("Верховної Ради", "ВР"), ("автоматизована система", "ЩЦ"))


@register("f33_synonyms", """
WITH o AS (SELECT o_orderkey % 4 AS k, o_orderkey // 4 % 3 AS form FROM orders)
SELECT ['ЗСУ', 'НСД', 'ВР'][k + 1] AS abbr, ['Збройних Сил України', 'несанкціонований доступ', 'Верховної Ради'][k + 1] AS full_form, ['declared', 'listed', 'bracketed'][form + 1] AS source, count(*) AS seen FROM o WHERE k < 3 GROUP BY ALL""")
def f33(spark, sf_dir):
    """Abbreviations that texts declare, with their full forms: those whose letters follow one another in the form."""
    k, form = (F.col("o_orderkey") % 4).cast("int"), F.expr("o_orderkey div 4 % 3")
    pick = lambda i: F.get(F.array(*[F.lit(d[i]) for d in DECLARED]), k)
    text = (
        F.when(form == 0, F.concat(F.lit("Форма одягу військовослужбовців. Порядок для "), pick(0), F.lit(" (далі – "), pick(1), F.lit(") такий")))
        .when(form == 1, F.concat(F.lit("3.1.2 "), pick(0), F.lit("; "), pick(1), F.lit(" термін\n")))
        .otherwise(F.concat(F.lit("цей захист, "), pick(0), F.lit(" ("), pick(1), F.lit(") діє")))
    )
    return x.declared_abbreviations(v.table(spark, sf_dir, "orders").select(text.alias("text")))


@register("f35_named_act_absent", "SELECT item_id, NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.title)) AS absent FROM (SELECT item_id, regexp_extract(text, '^[^.!?]+') AS title FROM benchmark) b")
def f35(spark, sf_dir):
    """Whether the title that a question names, its first sentence, stands in no document."""
    b = v.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.regexp_extract("text", r"^[^.!?]+", 0).alias("quote"))
    there = quotes.holders(b, v.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("query_id").distinct().withColumn("there", F.lit(True))
    return b.join(there, "query_id", "left").select(F.col("query_id").alias("item_id"), F.col("there").isNull().alias("absent"))


@register("s14_embed_missing")
def s14(spark, sf_dir):
    """Documents that have no vector yet get one: a signed hash of their lexemes in 64 dimensions, scaled to length 1.

    It stands in for a trained encoder, which has the same signature.
    """
    have = v.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    missing = v.table(spark, sf_dir, "documents").select("doc_id", "text").join(have, "doc_id", "left_anti")
    terms = missing.select("doc_id", F.explode(x.lexemes(F.col("text"))).alias("w")).groupBy("doc_id", F.pmod(F.xxhash64("w"), F.lit(64)).alias("i")).agg(F.sum(F.when(F.xxhash64(F.lit(1), "w") > 0, 1.0).otherwise(-1.0)).alias("x"))
    dense = terms.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("i", "x"))).alias("m")).withColumn("v", F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint")), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
    return dense.select("doc_id", F.transform("v", lambda e: F.when(size > 0, F.round(e / size, 6)).otherwise(0.0).cast("float")).alias("embedding"))


@register("s12_truth_by_fingerprint", "SELECT item_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids, count(*) AS n FROM (SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)) GROUP BY item_id")
def s12(spark, sf_dir):
    """The documents that hold each truth's fingerprint, found by the verbatim search."""
    b = v.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("quote"))
    exact = quotes.holders(b, v.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return exact.groupBy(F.col("query_id").alias("item_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda i: i.cast("string")), ",").alias("doc_ids"), F.count("*").alias("n"))


@register("d02_question_dates", "SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN DATE '2024-05-01' WHEN turn % 4 = 1 THEN DATE '2024-06-02' END AS day FROM conversations")
def d02(spark, sf_dir):
    q = F.when(F.col("turn") % 4 == 0, "who is absent on 2024-05-01?").when(F.col("turn") % 4 == 1, "who left on 2.6.2024").when(F.col("turn") % 4 == 2, "on 30.02.2024").otherwise("who?")
    return v.table(spark, sf_dir, "conversations").select("conv_id", "turn", x.date_of(q).alias("day"))


@register("d10_comparison", v.sql(v.FACTS_SQL, body="SELECT dimension, count(*) FILTER (WHERE year(valid_from) = 1997) AS before, count(*) FILTER (WHERE year(valid_from) = 1998) AS after, count(*) FILTER (WHERE year(valid_from) = 1998) - count(*) FILTER (WHERE year(valid_from) = 1997) AS change FROM facts WHERE status = 'confirmed' GROUP BY dimension"))
def d10(spark, sf_dir):
    before, after = (F.count_if(F.year("valid_from") == y) for y in (1997, 1998))
    return v.facts(spark, sf_dir).filter("status = 'confirmed'").groupBy("dimension").agg(before.alias("before"), after.alias("after"), (after - before).alias("change"))


@register("f29_split_by_group", "WITH parts AS (SELECT l_suppkey, l_orderkey % 200 * 30 AS a, l_orderkey % 200 * 30 + 25 AS b, l_orderkey % 7 = 0 AS hit FROM lineitem), m AS (SELECT *, CASE WHEN a > max(b) OVER w THEN 1 ELSE 0 END AS fresh FROM parts WINDOW w AS (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT l_suppkey, count(DISTINCT a) AS parts, count(DISTINCT a) FILTER (WHERE hit) AS hit_parts FROM m GROUP BY l_suppkey")
def f29(spark, sf_dir):
    """Parts of each document, and those that the search has found."""
    a = F.col("l_orderkey") % 200 * 30
    parts = v.table(spark, sf_dir, "lineitem").select("l_suppkey", a.alias("char_start"), (a + 25).alias("char_end"), (F.col("l_orderkey") % 7 == 0).alias("hit"))
    one = r.islands(parts.groupBy("l_suppkey", "char_start", "char_end").agg(F.bool_or("hit").alias("hit")), ["l_suppkey"])
    return one.groupBy("l_suppkey").agg(F.count("*").alias("parts"), F.count_if("hit").alias("hit_parts"))
