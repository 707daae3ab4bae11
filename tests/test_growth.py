"""What grows no faster than its input, and what odd inputs give."""

import datetime as dt
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from quillstone.plans import dialogue, registry


def joined_rows(spark, df):
    """The rows that each join of a query gave, by the metrics of its run."""
    df.collect()
    store = spark._jsparkSession.sharedState().statusStore()
    last = max(store.executionsList().apply(i).executionId() for i in range(store.executionsList().size()))
    metrics, nodes, out = store.executionMetrics(last), store.planGraph(last).allNodes().iterator(), []
    while nodes.hasNext():
        node = nodes.next()
        found = node.metrics().iterator()
        while found.hasNext():
            m = found.next()
            if "Join" in node.name() and m.name() == "number of output rows" and metrics.get(m.accumulatorId()).isDefined():
                out.append(int(metrics.get(m.accumulatorId()).get().replace(",", "")))
    return out


def test_names_meet_by_their_words(spark, tmp_path):
    """3,000 names of the same words and 300 questions don't meet one by one."""
    spark.range(3000).select(F.col("id").alias("c_custkey"), F.lit("MACHINERY").alias("c_mktsegment"), (F.col("id") % 5).cast("int").alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(300).select(F.col("id").alias("s_suppkey"), (F.col("id") % 7).cast("int").alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    df = registry.queries()["j12_progressive_names"](spark, str(tmp_path))
    assert max(joined_rows(spark, df)) <= 300
    got = {r.s_suppkey: (r.candidates, r.first_id) for r in df.collect()}
    assert got == {i: (600, i % 7) if i % 7 < 5 else (3000, 0) for i in range(300)}


def test_rules_read_texts_as_sql_does(spark, tmp_path):
    """words with accents, line ends other than \\n, and ends before a last line end."""
    texts = ["thé and of", "the été y", "é the x yé ", "les\rmots y", "the a of b", "short\n", "short", "a\nb", "the\nof", "drop_it", "édrop", "x" * 41, "los \u0085 et", "los ſof", "Kupdate", "leſ y ", "leſa y "]
    spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = c.execute(f"SELECT conv_id, template FROM ({registry.oracle_sql()['d01_rule_router']})").fetchall()
    got = dialogue.d01(spark, str(tmp_path)).select("conv_id", "template").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_places_on_a_page_are_rounded_as_in_sql(spark, tmp_path):
    """F8: SQL rounds a number that it makes whole, halves to the even one."""
    rows = [(1, 1, 5.0, 39999.5), (1, 2, 9.0, 40000.2), (1, 3, 7.0, 19999.7), (2, 1, 2.5, 100.0), (2, 2, 2.6, 100.0), (2, 3, 3.5, 20000.0), (3, 1, 1.0, 59999.4), (3, 2, 0.5, 60000.5), (3, 3, 1.5, 59999.5)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = c.execute(f"SELECT page, block FROM ({registry.oracle_sql()['f12_block_beside_label']})").fetchall()
    assert sorted(map(tuple, registry.queries()["f12_block_beside_label"](spark, str(tmp_path)).select("page", "block").collect())) == sorted(want)


def test_numbers_of_a_long_text(spark):
    """a text's words are looked up once, not once for each word."""
    from quillstone.functions import forms

    said = "тридцять п'ять 12 діб і 0012 та двадцять, 99999999999999999999 " * 300
    began = time.time()
    assert spark.createDataFrame([(said,)], "t string").select(forms.attested_numbers(F.col("t")).alias("n")).first().n == [5, 12, 20, 30, 35]
    assert time.time() - began < 50


def test_identity_rules_compute_each_part_once(spark):
    """a rule's text stands in the plan as often as it is asked for, not as often as its parts are used."""
    from quillstone.functions import identity

    df = spark.createDataFrame([("x",)], "text string")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.maxPlanStringLength", 2**30)
    try:
        assert plan(df.transform(identity.identified, "text").select("identity.*")).count("Голова") <= 2
        assert plan(df.select(identity.canonical(F.col("text")).alias("c"))).count("‐-―") <= 1
        assert plan(df.select(identity.is_act(F.col("text")).alias("c"))).count(r"[^{}]*") <= 1
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")


def test_vectors_meet_in_tasks_without_pairs_of_rows(spark, tmp_path):
    """No row for each of the 90,000 pairs of a query and a vector."""
    part = lambda k: (F.col("id") * 7919 % (97 + k) - 48).cast("float")
    spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*[part(k) for k in range(4)]).alias("embedding"), (F.col("id") % 10).cast("int").alias("label")).write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("f24_rrf", "f26_weighted_rrf", "a43_hit_at_k", "a44_router_confusion", "a42_separability", "f36_router_by_mean_of_five", "j13_nearest_vectors", "f36_nearest_example_router"):
        assert max([0, *joined_rows(spark, registry.queries()[name](spark, str(tmp_path)))]) < 10_000, name


@pytest.mark.parametrize("cells", [4_000_000, 50])
def test_nearest_vectors_match_a_plain_comparison(spark, monkeypatch, cells):
    """Ties, equal vectors, zeros, nulls and other lengths, in blocks of any size, of all and of each group."""
    import random

    from quillstone.operators import retrieval

    monkeypatch.setattr(retrieval, "CELLS", cells)
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(4)], rng.randint(0, 2)) for i in range(120)] + [(200, [0.0] * 4, 1), (201, None, 1), (202, [1.0, None, 0.0, 0.0], 0), (203, [1.0, 2.0], 2)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    q = e.filter("vec_id % 20 = 0 or vec_id > 200").selectExpr("vec_id as query_id", "embedding")

    def score(a, b):
        if a is None or b is None or None in a or None in b or len(a) != len(b):
            return None
        size = sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5
        return round(sum(x * y for x, y in zip(a, b, strict=True)) / size, 6) if size else None

    def best(group):
        out = set()
        for i, a, _ in rows:
            if i % 20 and i <= 200:
                continue
            for g in {r[2] for r in rows} if group else {None}:
                of = sorted(((score(a, b), j) for j, b, lab in rows if j != i and g in (None, lab)), key=lambda s: (s[0] is None, -(s[0] or 0), s[1]))
                out |= {(i, j, s, k + 1) for k, (s, j) in enumerate(of[:7])}
        return out

    for group in (None, "label"):
        got = retrieval.nearest(q, e, "vec_id", 7, "label", but_itself=True, group=group)
        assert {tuple(r) for r in got.select("query_id", "vec_id", F.col("score") + 0.0, "rank").collect()} == best(group)


def test_a_growing_table_is_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    """what a task puts in order is bounded by rows, not by a fixed number of tasks."""
    from quillstone.sources import views

    monkeypatch.setattr(views, "TASK_ROWS", 100)
    rows = spark.range(2000).selectExpr("id % 300 as l_orderkey", "id % 20 as l_partkey", "cast(id % 50 + 1 as double) as l_quantity", "cast(id as int) as l_linenumber")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert views.spread_by_size(rows, "lineitem", spark, str(tmp_path), "l_partkey").rdd.getNumPartitions() == 20
    df = registry.queries()["f28_quote_assembly"](spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 20


def test_terms_are_counted_before_they_meet_questions(spark, tmp_path):
    """a term of 400 documents is one row where it meets the questions' terms."""
    spark.range(400).selectExpr("id as doc_id", "concat('common word', id % 100) as text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "user", "common word7 word8 none")], "conv_id long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    df = registry.queries()["f34_attested_terms"](spark, str(tmp_path))
    assert max(joined_rows(spark, df)) <= 101
    assert sorted(map(tuple, df.select("term", "hits").collect())) == [("word7", 4), ("word8", 4)]
