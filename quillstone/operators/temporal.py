"""Operators on facts: intervals, canonical copies, source attributes and supersession.

An interval is closed; a null end is open; a null start matches no date. All are joins, aggregations and windows keyed
by object or source document, so they spread over those keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def at_date(day: str) -> Column:
    """Whether a fact holds on a day."""
    d = F.lit(day).cast("date")
    return (F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") >= d))


def in_period(first: str, last: str) -> Column:
    """Whether a fact holds on some day of a period."""
    return (F.col("valid_from") <= F.lit(last).cast("date")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit(first).cast("date")))


def same_text(value: Column | str) -> Column:
    """A value as a key: a straight apostrophe counts as a curly one."""
    return F.translate(F.col(value) if isinstance(value, str) else value, "'", "’")


def first_by(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row for each combination of keys (nulls are equal): the first in order."""
    names = [f"_k{i}" for i in range(len(keys))]
    df = df.withColumns({n: k if isinstance(k, Column) else F.col(k) for n, k in zip(names, keys, strict=True)})
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*names).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank", *names)


def distinct_facts(df: DataFrame, *more: str) -> DataFrame:
    """Copies of a fact from several documents count once: that of the smallest document, then id."""
    keys = ["object_id", "dimension", same_text("value"), "valid_from", "valid_to", *more]
    return first_by(df, keys, [F.col("source_doc_id").asc_nulls_last(), F.col("id")])


def attributes(facts: DataFrame, codes: dict[str, str], status: str | None = None) -> DataFrame:
    """(source_doc_id, one column a code): each document's value of the fact with the smallest id, in one aggregation."""
    own = facts.filter(F.col("dimension").isin(list(codes)))
    if status:
        own = own.filter(F.col("status") == status)
    return own.groupBy("source_doc_id").agg(*[F.min_by("value", F.when(F.col("dimension") == code, F.col("id"))).alias(name) for code, name in codes.items()])


def latest(facts: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """(keys, value): the value with the latest start, nulls last, then the smallest id."""
    best = F.max_by(value, F.struct(F.coalesce("valid_from", F.lit("0001-01-01").cast("date")), -F.col("id")))
    return facts.groupBy(*keys).agg(best.alias(value))


def overlaps(facts: DataFrame, open_end: str, same: list[str]) -> DataFrame:
    """Pairs (a, b) of facts of one object that overlap; an open end is 'infinite', or the 'point' of its start.

    Facts fall into buckets of 64 days that they touch, so a pair only meets in a bucket that both touch, and is kept
    in the first of those; an object with many facts is spread over its buckets. Open ends stop at the last start.
    """
    end = F.coalesce("valid_to", F.lit("9999-12-31").cast("date") if open_end == "infinite" else F.col("valid_from"))
    f = facts.filter("valid_from is not null").withColumn("_end", end).filter("_end >= valid_from")
    last = f.agg(F.max(F.datediff("valid_from", F.lit("1970-01-01").cast("date"))).alias("_last"))
    day = F.datediff("valid_from", F.lit("1970-01-01").cast("date"))
    f = f.crossJoin(F.broadcast(last)).withColumn("_from", F.floor(day / 64))  # last is one row
    f = f.withColumn("_to", F.floor(F.least(F.datediff("_end", F.lit("1970-01-01").cast("date")), F.col("_last")) / 64))
    f = f.withColumn("_bucket", F.explode(F.sequence("_from", F.greatest("_from", "_to")))).select("id", "object_id", "dimension", "value", "valid_from", "_end", "_from", "_bucket")
    a, b = f.alias("a"), f.alias("b")
    met = (F.col("a.object_id") == F.col("b.object_id")) & (F.col("a._bucket") == F.col("b._bucket")) & (F.col("a.id") < F.col("b.id"))
    for name in same:
        met &= F.col(f"a.{name}") == F.col(f"b.{name}")
    met &= (F.col("a.valid_from") <= F.col("b._end")) & (F.col("b.valid_from") <= F.col("a._end"))
    met &= F.col("a._bucket") == F.greatest("a._from", "b._from")
    return a.join(b, met).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("a.object_id").alias("object_id"), F.col("a.dimension").alias("a_dimension"), F.col("b.dimension").alias("b_dimension"), F.col("a.value").alias("a_value"), F.col("b.value").alias("b_value"))


def supersede(facts: DataFrame) -> DataFrame:
    """Adds closed_at and new_status for values that hold one at a time (an object and dimension).

    Facts are put in order of their start. Each is closed by the next start; of equal starts only the smallest id
    counts, and a fact without a start, stay unconfirmed. So at most one confirmed fact is open at the end.
    """
    ranked = facts.withColumn("_tie", F.row_number().over(Window.partitionBy("object_id", "dimension", "valid_from").orderBy("id")))
    ranked = ranked.withColumn("_good", F.col("valid_from").isNotNull() & (F.col("_tie") == 1))
    order = Window.partitionBy("object_id", "dimension", "_good").orderBy("valid_from", "id")
    closed = F.when(F.col("_good"), F.lead("valid_from").over(order))
    return ranked.withColumn("closed_at", closed).withColumn("new_status", F.when(F.col("_good"), "confirmed").otherwise("unconfirmed")).drop("_tie", "_good")


def merged_values(facts: DataFrame) -> DataFrame:
    """(id, object_id, dimension, valid_from, closed_at, copies, sources): runs of facts that say the same, in order of start.

    The first of a run holds until a fact with another value begins; the others are its copies, their documents its
    sources. Apostrophes are folded. Facts without a start take no part.
    """
    order = Window.partitionBy("object_id", "dimension").orderBy("valid_from", "id")
    said = F.translate("value", "'", "’")
    f = facts.filter("valid_from is not null").withColumn("_new", F.when(said == F.lag(said).over(order), 0).otherwise(1))
    f = f.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = f.groupBy("object_id", "dimension", "_run").agg(F.min_by("id", F.struct("valid_from", "id")).alias("id"), F.min("valid_from").alias("valid_from"), F.count("*").alias("copies"), F.count_distinct("source_doc_id").alias("sources"))
    closed = F.lead("valid_from").over(Window.partitionBy("object_id", "dimension").orderBy("_run"))
    return runs.select("id", "object_id", "dimension", "valid_from", closed.alias("closed_at"), "copies", "sources")


def claims(tasks: DataFrame, order: list[Column], workers: int, each: int = 1) -> DataFrame:
    """Adds worker to the first tasks in an order, `each` for each of so many workers, dealt in turn: no task comes twice.

    The first are taken before they are numbered, so only workers times each rows meet in one task.
    """
    first = tasks.orderBy(*order).limit(workers * each)
    place = F.row_number().over(Window.orderBy(*order))
    return first.withColumn("worker", ((place - 1) % workers).cast("long"))
