"""Search over documents and vectors, and its measures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import retrieval as r
from ..operators import segment
from ..sources import views as v
from .registry import register

WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\pL\\pN]+'), lambda w: length(w) > 1)"
INDEX = f"words AS (SELECT doc_id, {WORDS} AS w FROM documents), idx AS (SELECT term, doc_id, n AS length, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM words) GROUP BY term, doc_id, n)"
ASKED = f"q AS (SELECT item_id AS query_id, unnest(list_distinct({WORDS})) AS term FROM benchmark)"
BM25 = """
stats AS (SELECT count(*) AS n, sum(len(w)) / count(*)::DOUBLE AS mean FROM words),
freq AS (SELECT term, count(*) AS df FROM idx GROUP BY term),
bm AS (SELECT query_id, doc_id, CAST(sum(CAST(round(1000000.0::DOUBLE * (ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean)))) AS BIGINT)) AS DOUBLE) / 1000000.0::DOUBLE AS score, count(*) AS matched
  FROM q JOIN freq USING (term) JOIN idx USING (term) CROSS JOIN stats GROUP BY query_id, doc_id)"""


def asked(spark, sf_dir):
    return v.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def normative(spark, sf_dir):
    """The procedural scope: normative documents in force."""
    return v.registry(spark, sf_dir).filter("domain = 'normative' and validity = 'current'").select(F.col("id").alias("doc_id"), "type", "text")


NORMATIVE = "scope AS (SELECT id AS doc_id, type, text FROM registry WHERE domain = 'normative' AND validity = 'current')"
SCOPED = INDEX.replace("FROM documents", "FROM scope")


@register("f22_inverted_index_terms", f"WITH {INDEX} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS n FROM idx GROUP BY term")
def f22_index(spark, sf_dir):
    return r.inverted_index(v.table(spark, sf_dir, "documents"), "doc_id").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))


@register("f22_bm25_top10", f"WITH {INDEX}, {ASKED}, {BM25} SELECT query_id, doc_id, score, matched FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM bm) WHERE rank <= 10")
def f22(spark, sf_dir):
    q = asked(spark, sf_dir)
    return r.postings(v.table(spark, sf_dir, "documents"), q, "doc_id").bm25(10).select("query_id", "doc_id", "score", "matched")


@register("f22_any_term_rank", v.sql(v.REGISTRY_SQL, NORMATIVE, SCOPED, ASKED, """
size AS (SELECT query_id, count(*) AS size FROM q GROUP BY query_id),
found AS (SELECT query_id, doc_id, CAST(sum(CAST(round(1000000.0::DOUBLE * (0.1::DOUBLE * list_sum(list_transform(range(1, least(tf, 256) + 1), lambda k: 1.0::DOUBLE / (k * k))) / 1.64493406685::DOUBLE)) AS BIGINT)) // any_value(size) AS DOUBLE) / 1000000.0::DOUBLE AS score FROM q JOIN size USING (query_id) JOIN idx USING (term) GROUP BY query_id, doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM found WHERE score >= 0.02),
body AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM scope),
spots AS (SELECT query_id, doc_id, w, list_position(list_transform(w, lambda x: list_has_any(regexp_split_to_array(lower(x), '[^\\pL\\pN]+'), terms)), true) AS i FROM best JOIN (SELECT query_id, list(term) AS terms FROM q GROUP BY query_id) USING (query_id) JOIN body USING (doc_id) WHERE rank <= 70)
""", body="SELECT query_id, doc_id, score, array_to_string(w[greatest(i - 5, 1):greatest(i - 5, 1) + 14], ' ') AS headline FROM best JOIN spots USING (query_id, doc_id)"))
def f22_any(spark, sf_dir):
    """Full-text search within the procedural scope: any term, ranks of 0.02 or more, 70 a question, a headline of 15 words."""
    q, docs = asked(spark, sf_dir), normative(spark, sf_dir)
    best = r.postings(docs, q, "doc_id").any_term_rank(70).filter("score >= 0.02").select("query_id", "doc_id", "score")
    terms = q.select("query_id", F.array_distinct(x.lexemes(F.col("text"))).alias("terms"))
    body = docs.select("doc_id", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    said = F.flatten(F.transform("w", lambda w, i: F.transform(F.split(F.lower(w), r"[^\p{L}\p{N}]+"), lambda t: F.struct(t.alias("t"), (i + 1).alias("i")))))
    hits = best.join(terms, "query_id").join(body.withColumn("said", said), "doc_id")
    hit = F.array_min(F.transform(F.filter("said", lambda s: F.array_contains("terms", s["t"])), lambda s: s["i"]))
    hits = hits.withColumn("_from", F.greatest(hit - 5, F.lit(1)).cast("int"))
    return hits.select("query_id", "doc_id", "score", F.array_join(F.slice("w", F.col("_from"), F.lit(15)), " ").alias("headline"))


@register("a19_normative_search", v.sql(v.REGISTRY_SQL, NORMATIVE, SCOPED, ASKED, BM25.strip(), body="SELECT query_id, type AS source, score, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, type) AS rank FROM (SELECT query_id, type, max(score) AS score, arg_min(doc_id, (-score, doc_id)) AS doc_id FROM bm JOIN scope USING (doc_id) GROUP BY query_id, type)) WHERE rank <= 3"))
def a19(spark, sf_dir):
    """The three best sources of normative documents in force for each question, with the best document.

    The filter is inside the search: only such documents are indexed, counted and ranked.
    """
    q, docs = asked(spark, sf_dir), normative(spark, sf_dir)
    by_source = r.postings(docs.withColumnRenamed("type", "source"), q, "doc_id", "source").bm25(1, "source").drop("rank")
    return r.top(by_source, 3, "source").select("query_id", "source", "score", "doc_id")


def cosine_sql(a: str, b: str) -> str:
    return f"round(list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[]))), 6)"


NEAR = f"near AS (SELECT q.vec_id AS query_id, e.vec_id, e.label, {cosine_sql('e.embedding', 'q.embedding')} AS score FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id)"


def vectors(spark, sf_dir):
    e = v.table(spark, sf_dir, "embeddings")
    return e, e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@register("j13_nearest_vectors", f"WITH {NEAR} SELECT query_id, vec_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM near) WHERE rank <= 10")
def j13(spark, sf_dir):
    e, q = vectors(spark, sf_dir)
    return r.nearest(q, e, "vec_id", 10, but_itself=True).select("query_id", "vec_id", F.round("score", 4).alias("score"))


@register("f36_nearest_example_router", f"WITH {NEAR} SELECT query_id, CASE WHEN score >= 0.5 THEN label END AS label, round(score, 4) AS score FROM (SELECT query_id, label, max(score) AS score, row_number() OVER (PARTITION BY query_id ORDER BY max(score) DESC, label) AS rank FROM near GROUP BY query_id, label) WHERE rank = 1")
def f36(spark, sf_dir):
    """The label of the nearest example, if it is near enough."""
    e, q = vectors(spark, sf_dir)
    return r.nearest(q, e, "vec_id", 1, "label", but_itself=True, tie="label").select("query_id", F.when(F.col("score") >= 0.5, F.col("label")).alias("label"), F.round("score", 4).alias("score"))


@register("f36_router_by_mean_of_five", f"WITH {NEAR}, five AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY score DESC, vec_id) AS rank FROM near), m AS (SELECT query_id, label, CAST(floor(sum(CAST(round(score * 1000000) AS BIGINT)) / count(*)) AS BIGINT) AS mean FROM five WHERE rank <= 5 GROUP BY query_id, label) SELECT query_id, label, mean FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY mean DESC, label) AS r FROM m) WHERE r = 1")
def f36_mean(spark, sf_dir):
    """The label whose five nearest examples are nearest on the whole; their mean in millionths."""
    e, q = vectors(spark, sf_dir)
    five = r.nearest(q, e, "vec_id", 5, "label", but_itself=True, group="label")
    means = five.groupBy("query_id", "label").agg(F.sum(F.round(F.col("score") * 1e6).cast("long")).alias("_sum"), F.count("*").alias("_n")).select("query_id", "label", F.expr("floor(_sum / _n)").cast("long").alias("mean"))
    return r.top(means, 1, "label", by="mean").select("query_id", "label", "mean")


BRANCHES = f"{NEAR}, a AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM near), b AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY abs(label - query_id // 100 % 10), vec_id) AS rank FROM near), fused AS (SELECT query_id, vec_id, round(sum(w / (k + rank)), 8) AS rrf, count(*) AS sources FROM (SELECT query_id, vec_id, rank, {{wa}}::DOUBLE AS w, {{k}} AS k FROM a WHERE rank <= 70 UNION ALL SELECT query_id, vec_id, rank, {{wb}}::DOUBLE, {{k}} FROM b WHERE rank <= 70) GROUP BY query_id, vec_id)"


def branches(spark, sf_dir):
    e, q = vectors(spark, sf_dir)
    # one more than 70, as a query isn't its own; queries that want one label share these
    first = e.select("vec_id", "label").withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))).filter("n <= 71").drop("n")
    wanted = q.select("query_id", F.expr("query_id div 100 % 10").alias("wanted"))
    kinds = wanted.select("wanted").distinct()  # ten at most
    near = r.top(first.crossJoin(F.broadcast(kinds)).withColumn("far", -F.abs(F.col("label") - F.col("wanted"))), 71, "vec_id", by="far", group="wanted").drop("rank")
    labelled = r.top(wanted.join(near, "wanted").filter("vec_id <> query_id"), 70, "vec_id", by="far")
    return [r.nearest(q, e, "vec_id", 70, but_itself=True), labelled]


@register("f24_rrf", "WITH " + BRANCHES.format(wa=1, wb=1, k=60) + " SELECT query_id, vec_id, round(rrf, 6) AS rrf, sources FROM fused")
def f24(spark, sf_dir):
    return r.fuse(branches(spark, sf_dir), "vec_id").select("query_id", "vec_id", F.round("rrf", 6).alias("rrf"), "sources")


@register("f26_weighted_rrf", "WITH " + BRANCHES.format(wa=1, wb=5, k=10) + " SELECT query_id, vec_id, round(rrf, 6) AS rrf, sources FROM fused WHERE sources = 2")
def f26(spark, sf_dir):
    return r.fuse(branches(spark, sf_dir), "vec_id", 10, [1, 5]).filter("sources = 2").select("query_id", "vec_id", F.round("rrf", 6).alias("rrf"), "sources")


@register("f27_collapse_copies", "SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, substring(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 1, 80) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def f27(spark, sf_dir):
    return r.collapse(v.table(spark, sf_dir, "documents"), "text", "source", "doc_id").select("source", "doc_id")


@register("f20_stride_chunks", "SELECT doc_id, CAST(i AS INTEGER) AS ord, CAST(i * 1000 AS INTEGER) AS start, md5(substring(text, i * 1000 + 1, 1200)) AS chunk FROM (SELECT doc_id, text, unnest(range(greatest(CAST(ceil((length(text) - 200) / 1000.0) AS BIGINT), 1))) AS i FROM documents) WHERE length(substring(text, i * 1000 + 1, 1200)) >= 80")
def f20(spark, sf_dir):
    return segment.stride_chunks(v.table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "ord", "start", F.md5("chunk").alias("chunk"))


@register("f20_paragraph_chunks")
def f20_paragraphs(spark, sf_dir):
    """Chunks of whole paragraphs; the tables hold no blank lines, so sentences of ten words or more begin one here.

    The twin would need a fold over paragraphs; tests hold it against a plain one.
    """
    d = v.table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"([.!?]) (?=\S+(?: \S+){9})", "$1\n \n").alias("text"))
    return segment.paragraph_chunks(d, "doc_id").select("doc_id", "ord", "start", F.md5("chunk").alias("chunk"))


@register("f21_nested_units")
def f21_nested(spark, sf_dir):
    """Structural units with list items as parts of their point, of documents whose lines are numbered here."""
    lines = F.transform(F.split("text", "\n"), lambda l, i: F.concat((i % 3 + 1).cast("string"), F.lit(". "), l))
    return segment.units(v.table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text")), "doc_id", rule="nest")


@register("f21_structural_units")
def f21(spark, sf_dir):
    return segment.units(v.table(spark, sf_dir, "documents"), "doc_id")


@register("f28_quote_assembly", "WITH parts AS (SELECT l_partkey, l_orderkey * 8 + l_linenumber AS part, CAST(l_orderkey % 300 * 20 AS BIGINT) AS a, CAST(l_orderkey % 300 * 20 + l_quantity AS BIGINT) AS b FROM lineitem), marked AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY l_partkey ORDER BY a, b, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM parts), isl AS (SELECT *, sum(fresh) OVER (PARTITION BY l_partkey ORDER BY a, b, part ROWS UNBOUNDED PRECEDING) AS island FROM marked), groups AS (SELECT l_partkey, island, min(a) AS lo, max(b) AS hi, count(*) AS n FROM isl GROUP BY 1, 2) SELECT l_partkey, lo, least(hi, lo + 3000) AS hi, n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, lo) AS r FROM groups) WHERE r = 1")
def f28(spark, sf_dir):
    """The largest contiguous group of found parts, at most 3,000 characters of it."""
    lo = F.col("l_orderkey") % 300 * 20
    parts = v.table(spark, sf_dir, "lineitem").select("l_partkey", lo.alias("char_start"), (lo + F.col("l_quantity")).cast("long").alias("char_end"))
    # parts that begin together lie in one group, so they are counted before anything is put in order
    same = parts.groupBy("l_partkey", "char_start").agg(F.max("char_end").alias("char_end"), F.count("*").alias("n"))
    groups = r.islands(v.spread_by_size(same, "lineitem", spark, sf_dir, "l_partkey"), ["l_partkey"]).groupBy("l_partkey", "island").agg(F.min("char_start").alias("lo"), F.max("char_end").alias("hi"), F.sum("n").alias("n"))
    best = r.top(groups, 1, "lo", by="n", group="l_partkey")
    return best.select("l_partkey", "lo", F.least("hi", F.col("lo") + 3000).alias("hi"), "n")


@register("a43_hit_at_k", f"WITH {NEAR}, ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM near), first AS (SELECT r.query_id, min(rank) FILTER (WHERE r.label = q.label) AS hit FROM ranked r JOIN embeddings q ON q.vec_id = r.query_id WHERE rank <= 10 GROUP BY r.query_id) SELECT count(*) AS n, count(*) FILTER (WHERE hit <= 1) AS at1, count(*) FILTER (WHERE hit <= 5) AS at5, count(*) FILTER (WHERE hit IS NULL) AS missed, round(avg(hit), 6) AS mean_rank FROM first")
def a43(spark, sf_dir):
    e, q = vectors(spark, sf_dir)
    found = r.nearest(q, e, "vec_id", 10, "label", but_itself=True)
    truth = e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("truth"))
    first = found.join(truth, "query_id").groupBy("query_id").agg(F.min(F.when(F.col("label") == F.col("truth"), F.col("rank"))).alias("hit"))
    return first.agg(F.count("*").alias("n"), F.count_if(F.col("hit") <= 1).alias("at1"), F.count_if(F.col("hit") <= 5).alias("at5"), F.count_if(F.col("hit").isNull()).alias("missed"), F.round(F.avg("hit"), 6).alias("mean_rank"))


@register("a42_separability", f"WITH {NEAR}, best AS (SELECT query_id, max(score) AS s FROM near GROUP BY query_id), c AS (SELECT query_id // 100 % 2 = 0 AS answerable, s FROM best) SELECT round(min(s) FILTER (WHERE answerable), 6) AS low, round(max(s) FILTER (WHERE NOT answerable), 6) AS high, round(min(s) FILTER (WHERE answerable) - max(s) FILTER (WHERE NOT answerable), 6) AS gap, round(median(s) FILTER (WHERE answerable), 6) AS mid FROM c")
def a42(spark, sf_dir):
    e, q = vectors(spark, sf_dir)
    best = r.nearest(q, e, "vec_id", 1, but_itself=True).select("query_id", F.col("score").alias("s"))
    yes, no = F.when(F.expr("query_id div 100 % 2 = 0"), F.col("s")), F.when(F.expr("query_id div 100 % 2 <> 0"), F.col("s"))
    return best.agg(F.round(F.min(yes), 6).alias("low"), F.round(F.max(no), 6).alias("high"), F.round(F.min(yes) - F.max(no), 6).alias("gap"), F.round(F.median(yes), 6).alias("mid"))


@register("a44_router_confusion", f"WITH {NEAR}, first AS (SELECT query_id, label, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM near) WHERE rank = 1), c AS (SELECT q.label AS expected, f.label = q.label AS good, score >= 0.5 AS sure FROM first f JOIN embeddings q ON q.vec_id = f.query_id) SELECT expected, count(*) AS n, count(*) FILTER (WHERE good) AS top1, count(*) FILTER (WHERE sure) AS routed, count(*) FILTER (WHERE sure AND NOT good) AS confidently_wrong FROM c GROUP BY expected")
def a44(spark, sf_dir):
    """How a router by the nearest example fares on examples, each left out of its own search."""
    e, q = vectors(spark, sf_dir)
    first = r.nearest(q, e, "vec_id", 1, "label", but_itself=True).select("query_id", F.struct("label", "score").alias("f"))
    truth = e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("expected"))
    good, sure = F.col("f.label") == F.col("expected"), F.col("f.score") >= 0.5
    return first.join(truth, "query_id").groupBy("expected").agg(F.count("*").alias("n"), F.count_if(good).alias("top1"), F.count_if(sure).alias("routed"), F.count_if(sure & ~good).alias("confidently_wrong"))


@register("f25_search_rrf_by_unit", v.sql("documents_ AS (SELECT doc_id, text FROM documents)", INDEX, ASKED, BM25.strip(), """
size AS (SELECT query_id, count(*) AS size FROM q GROUP BY query_id),
rk AS (SELECT query_id, doc_id, CAST(sum(CAST(round(1000000.0::DOUBLE * (0.1::DOUBLE * list_sum(list_transform(range(1, least(tf, 256) + 1), lambda k: 1.0::DOUBLE / (k * k))) / 1.64493406685::DOUBLE)) AS BIGINT)) // any_value(size) AS DOUBLE) / 1000000.0::DOUBLE AS score FROM q JOIN size USING (query_id) JOIN idx USING (term) GROUP BY query_id, doc_id),
both_ AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, 'a' AS branch FROM bm UNION ALL SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id), 'b' FROM rk)""", body="SELECT query_id, doc_id // 10 AS unit, CAST(sum(CAST(round(1000000.0::DOUBLE / (60 + rank)) AS BIGINT)) AS DOUBLE) / 1000000.0::DOUBLE AS rrf, count(DISTINCT branch) AS branches, string_agg(DISTINCT CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR)) AS parts FROM both_ WHERE rank <= 70 GROUP BY query_id, unit"))
def f25_search(spark, sf_dir):
    """Two lexical branches of 70 fused by reciprocal ranks, where the parts of one unit count together."""
    q = asked(spark, sf_dir)
    found = r.postings(v.table(spark, sf_dir, "documents"), q, "doc_id")
    branches_ = [ranked.select("query_id", "doc_id", "rank", F.lit(n).alias("branch")) for n, ranked in (("a", found.bm25(70)), ("b", found.any_term_rank(70)))]
    both = branches_[0].unionByName(branches_[1]).withColumn("unit", F.expr("doc_id div 10"))
    return both.groupBy("query_id", "unit").agg((F.sum(F.round(1e6 / (60 + F.col("rank"))).cast("long")) / 1e6).alias("rrf"), F.count_distinct("branch").alias("branches"), F.array_join(F.array_sort(F.collect_set(F.col("doc_id").cast("string"))), ",").alias("parts"))
