"""Extraction from forms and questions: names after ranks, blocks beside labels, dates as evaluated, slots, test rosters."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..sources import views as v
from .registry import register

# Month names.
MONTHS = "january february march april may june july august september october november december".split()

BLOCKS = "SELECT l_orderkey AS page, l_linenumber AS block, CAST(l_quantity AS BIGINT) AS x, CAST(l_extendedprice AS BIGINT) // 20000 AS y FROM lineitem"


@register("f12_block_beside_label", f"WITH b AS ({BLOCKS}), c AS (SELECT l.page, o.block, CASE WHEN o.y = l.y AND o.x > l.x THEN 0 WHEN o.y < l.y THEN 1 WHEN o.y > l.y THEN 2 END AS side, abs(o.y - l.y) AS dy, abs(o.x - l.x) AS dx FROM b l JOIN b o ON o.page = l.page AND o.block <> 1 WHERE l.block = 1) SELECT page, arg_min(block, (side, dy, dx, block)) AS block FROM c WHERE side IS NOT NULL GROUP BY page")
def f12(spark, sf_dir):
    """The block that belongs to a page's label: on its row to the right, else the nearest above, else below."""
    b = v.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("block"), F.rint("l_quantity").cast("long").alias("x"), F.expr("CAST(rint(l_extendedprice) AS BIGINT) div 20000").alias("y"))  # SQL rounds where Spark's cast cuts
    label = b.filter("block = 1").select("page", F.col("x").alias("lx"), F.col("y").alias("ly"))
    c = b.filter("block <> 1").join(label, "page")
    side = F.when((F.col("y") == F.col("ly")) & (F.col("x") > F.col("lx")), 0).when(F.col("y") < F.col("ly"), 1).when(F.col("y") > F.col("ly"), 2)
    order = F.struct(side.alias("side"), F.abs(F.col("y") - F.col("ly")).alias("dy"), F.abs(F.col("x") - F.col("lx")).alias("dx"), "block")
    return c.filter(side.isNotNull()).groupBy("page").agg(F.min_by("block", order).alias("block"))


@register("f05_evaluator_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 2 THEN '31 february 2001' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS canonical FROM orders")
def f05(spark, sf_dir):
    """A date as the evaluator compares it: ISO from ISO, d.m.yyyy or d month yyyy; an impossible one stays as it is."""

    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    months = F.array(*[F.lit(m) for m in MONTHS])
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "d.M.yyyy")).when(k == 2, "31 february 2001").otherwise(F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.get(months, F.month(d) - 1), F.year(d).cast("string")))
    t = v.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    part = lambda p, i: F.regexp_extract("t", p, i)
    dotted, named = r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", r"^(\d{1,2}) ([a-z]+) (\d{4})$"
    iso = lambda y, m, dd: F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(dd, 2, "0")).try_cast("date")
    month = F.array_position(months, part(named, 2)).cast("string")
    day = F.coalesce(F.col("t").try_cast("date"), iso(part(dotted, 3), part(dotted, 2), part(dotted, 1)), iso(part(named, 3), month, part(named, 1)))
    return t.select("o_orderkey", F.coalesce(day.cast("string"), F.col("t")).alias("canonical"))


# Fixed patterns of what a question may name.
SLOTS = {"number": r"([0-9]{4,})", "name": r"(?:^|[.] )([A-Z][a-z]{4,})", "place": r" in ([a-z]{5,})", "state": r" (and|und|et|y) "}
WRITE = r"(?:^|[^a-z])(?:drop|delete|update|insert)(?:[^a-z]|$)"


@register("d03_question_slots", "SELECT conv_id, turn, " + ", ".join(f"nullif(regexp_extract(text, '{p}', 1), '') AS {n}" for n, p in SLOTS.items()) + f", regexp_matches(lower(text), '{WRITE}') AS destructive, NOT regexp_matches(text, '{SLOTS['state']}') AS unknown_domain FROM conversations WHERE role = 'user'")
def d03(spark, sf_dir):
    """What a question names: number, name, place and state; whether it wants to write, and whether its domain is unknown."""
    c = v.table(spark, sf_dir, "conversations").filter("role = 'user'")
    slots = [F.nullif(F.regexp_extract("text", p, 1), F.lit("")).alias(n) for n, p in SLOTS.items()]
    return c.select("conv_id", "turn", *slots, F.lower("text").rlike(WRITE).alias("destructive"), (~F.col("text").rlike(SLOTS["state"])).alias("unknown_domain"))


@register("p01_at_date_grid", v.sql(v.FACTS_SQL, body="SELECT day, count(*) AS n FROM (SELECT DATE '1997-01-15' + CAST(i * 30 AS INTEGER) AS day FROM range(24) t(i)) d JOIN facts ON valid_from <= day AND (valid_to IS NULL OR valid_to >= day) WHERE status = 'confirmed' AND dimension = '2-HIGH' GROUP BY day"))
def p01(spark, sf_dir):
    """Facts that hold on each of a stated set of 24 days; open facts and closed ones alike, no fact twice a day."""
    days = spark.range(24).select(F.date_add(F.lit("1997-01-15").cast("date"), (F.col("id") * 30).cast("int")).alias("day"))
    f = v.facts(spark, sf_dir).filter("status = 'confirmed' and dimension = '2-HIGH'")
    holds = (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("day")))
    return f.join(F.broadcast(days), holds).groupBy("day").agg(F.count("*").alias("n"))  # 24 rows


def roster(spark: SparkSession, n: int = 300, seed: int = 42):
    """A made-up roster of n people: the same rows for the same seed, wherever they are made."""

    def pick(what: str, weights: dict[str, int]) -> Column:
        place = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(what), F.col("id").cast("string"))), 1, 8), 16, 10).cast("long") % sum(weights.values())
        out, upto = F, 0
        for value, weight in weights.items():
            upto += weight
            out = out.when(place < upto, value)
        return out

    return spark.range(n).select(F.concat(F.lit("UNIT-"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("service_id"), pick("rank", ROSTER_RANKS).alias("rank"), pick("unit", ROSTER_UNITS).alias("subdivision"))


ROSTER_RANKS = {"soldier": 60, "sergeant": 25, "captain": 12, "major": 3}
ROSTER_UNITS = {"staff": 15, "first": 90, "second": 90, "third": 90, "support": 15}


def _pick_sql(what: str, weights: dict[str, int]) -> str:
    place = f"CAST('0x' || substring(md5('42/{what}/' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT) % {sum(weights.values())}"
    upto, cases = 0, ""
    for value, weight in weights.items():
        upto += weight
        cases += f" WHEN {place} < {upto} THEN '{value}'"
    return f"CASE{cases} END"


@register("s18_roster_generator", f"SELECT 'UNIT-' || lpad(CAST(i AS VARCHAR), 4, '0') AS service_id, {_pick_sql('rank', ROSTER_RANKS)} AS rank, {_pick_sql('unit', ROSTER_UNITS)} AS subdivision FROM range(300) t(i)")
def s18(spark, sf_dir):
    return roster(spark)
