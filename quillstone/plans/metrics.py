"""Counters, reports, percentiles and traces."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources import views as v
from .registry import register


@register("a36_run_report", v.sql(v.FACTS_SQL, v.REGISTRY_SQL, body="SELECT 'status' AS counter, status AS key, count(*) AS n FROM facts GROUP BY status UNION ALL SELECT 'domain', coalesce(domain, '(none)'), count(*) FROM registry GROUP BY domain UNION ALL SELECT 'method', json_extract_string(info, '$.method'), count(*) FROM facts GROUP BY 2 UNION ALL SELECT 'gap', 'valid_to', count(*) FROM facts WHERE valid_to IS NULL UNION ALL SELECT 'gap', 'valid_from', count(*) FROM facts WHERE valid_from IS NULL"))
def a36(spark, sf_dir):
    f = v.facts(spark, sf_dir)
    gaps = F.array(*[F.when(F.col(c).isNull(), c) for c in ("valid_to", "valid_from")])
    pairs = F.concat(F.array(F.struct(F.lit("status").alias("counter"), F.col("status").alias("key")), F.struct(F.lit("method").alias("counter"), F.get_json_object("info", "$.method").alias("key"))), F.transform(gaps, lambda g: F.struct(F.lit("gap").alias("counter"), g.alias("key"))))
    one = f.select(F.explode(pairs).alias("p")).select("p.*").filter("key is not null")
    two = v.registry(spark, sf_dir).select(F.lit("domain").alias("counter"), F.coalesce("domain", F.lit("(none)")).alias("key"))
    return one.unionAll(two).groupBy("counter", "key").agg(F.count("*").alias("n"))


@register("a37_counters", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, v.REGISTRY_SQL, v.QUEUE_SQL, body="SELECT (SELECT count(*) FROM registry WHERE validity = 'current') AS current_docs, (SELECT count(*) FROM facts WHERE status = 'confirmed') AS confirmed, (SELECT count(*) FROM facts WHERE status = 'unconfirmed') AS drafts, (SELECT count(*) FROM people) AS people, (SELECT count(*) FROM queue WHERE NOT resolved) AS open_tasks, (SELECT count(DISTINCT document_id) FROM queue WHERE NOT resolved AND queue_type <> 'new_person') AS pending_docs"))
def a37(spark, sf_dir):
    q = v.review_queue(spark, sf_dir).filter("not resolved")
    parts = [
        v.registry(spark, sf_dir).agg(F.count_if(F.col("validity") == "current").alias("current_docs")),
        v.facts(spark, sf_dir).agg(F.count_if(F.col("status") == "confirmed").alias("confirmed"), F.count_if(F.col("status") == "unconfirmed").alias("drafts")),
        v.people(spark, sf_dir).agg(F.count("*").alias("people")),
        q.agg(F.count("*").alias("open_tasks"), F.count_distinct(F.when(F.col("queue_type") != "new_person", F.col("document_id"))).alias("pending_docs")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out.select("current_docs", "confirmed", "drafts", "people", "open_tasks", "pending_docs")


@register("a38_latency_percentiles", "WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, any_value(n) AS n, max(value) FILTER (WHERE i = round_even(0.5 * (n - 1), 0)) AS p50, max(value) FILTER (WHERE i = round_even(0.9 * (n - 1), 0)) AS p90, max(value) AS top FROM r GROUP BY event_type")
def a38(spark, sf_dir):
    """Nearest-rank percentiles: the value at round-half-even(share * (n - 1)); ranks are counted, values never collected.

    A histogram of value ranges, eight to a doubling, tells in which range a rank lies; only that range's distinct values
    are put in order.
    """
    e = v.table(spark, sf_dir, "events").select("event_type", "value", (F.signum("value") * (1 + F.floor(8 * F.log2(1 + F.abs("value"))))).alias("range"))
    c = e.groupBy("event_type", "range", "value").agg(F.count("*").alias("c"))
    own = Window.partitionBy("event_type")
    ranges = c.groupBy("event_type", "range").agg(F.sum("c").alias("c"), F.max("value").alias("top"))  # some hundreds a type
    ranges = ranges.withColumns({"upto": F.sum("c").over(own.orderBy("range")), "n": F.sum("c").over(own), "top": F.max("top").over(own)})
    shares = F.explode(F.array(F.lit(0.5), F.lit(0.9))).alias("share")
    asked = ranges.select("event_type", "range", "n", "top", (F.col("upto") - F.col("c")).alias("before"), "upto", shares).withColumn("rank", F.bround(F.col("share") * (F.col("n") - 1), 0))
    asked = asked.filter("rank >= before and rank < upto").drop("upto")
    within = c.join(asked, ["event_type", "range"]).withColumn("upto", F.col("before") + F.sum("c").over(Window.partitionBy("event_type", "share").orderBy("value")))
    at = lambda s: F.min(F.when((F.col("share") == s) & (F.col("upto") > F.col("rank")), F.col("value")))
    return within.groupBy("event_type").agg(F.max("n").alias("n"), at(0.5).alias("p50"), at(0.9).alias("p90"), F.max("top").alias("top"))


@register("a38_latest_series", "SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 60")
def a38_series(spark, sf_dir):
    order = Window.partitionBy("event_type").orderBy(F.desc("ts"), F.desc("event_id"))
    return v.table(spark, sf_dir, "events").withColumn("rn", F.row_number().over(order)).filter("rn <= 60").select("event_type", "event_id", "value")


@register("a39_trace_summary", "WITH t AS (SELECT user_id, event_id // 10 AS turn, list(event_type ORDER BY event_id) AS steps, count(*) FILTER (WHERE event_type = 'error') AS errors, sum(value) AS secs FROM events GROUP BY ALL), s AS (SELECT unnest(steps) AS step, errors FROM t) SELECT step, count(*) AS n, count(*) FILTER (WHERE errors > 0) AS in_failed FROM s GROUP BY step")
def a39(spark, sf_dir):
    e = v.table(spark, sf_dir, "events").withColumn("turn", F.expr("event_id div 10"))
    traces = e.groupBy("user_id", "turn").agg(F.collect_list("event_type").alias("steps"), F.count_if(F.col("event_type") == "error").alias("errors"))  # ten at most
    return traces.select("errors", F.explode("steps").alias("step")).groupBy("step").agg(F.count("*").alias("n"), F.count_if(F.col("errors") > 0).alias("in_failed"))


@register("f47_trace_gate", "SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 0) AS without_source, count(*) FILTER (WHERE event_type = 'error') = 0 AS passed, min(ts) AS since FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def f47(spark, sf_dir):
    e = v.table(spark, sf_dir, "events").filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    errors = F.count_if(F.col("event_type") == "error")
    return e.agg(F.count("*").alias("n"), errors.alias("errors"), F.count_if(F.get_json_object("props", "$.k").try_cast("int") == 0).alias("without_source"), (errors == 0).alias("passed"), F.min("ts").alias("since"))


@register("a41_majority_vote", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn, max(n) OVER (PARTITION BY user_id) AS best FROM c) SELECT user_id, max(event_type) FILTER (WHERE rn = 1) AS winner, max(n) AS votes, count(*) FILTER (WHERE n = best) > 1 AS split FROM r GROUP BY user_id")
def a41(spark, sf_dir):
    c = v.table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    best = c.groupBy("user_id").agg(F.min_by("event_type", F.struct(-F.col("n"), F.col("event_type"))).alias("winner"), F.max("n").alias("votes"))
    ties = c.join(best, "user_id").filter("n = votes").groupBy("user_id").agg((F.count("*") > 1).alias("split"))
    return best.join(ties, "user_id")
