"""Which texts hold which quotes, for a stated set of quotes.

A text that holds a quote has all its inner words, whole and in order. So each quote has a key, a hash of up to five of
its inner words, texts meet quotes at the hashes of their own word runs, and only those pairs are compared. A quote of
two words or fewer has no inner word and is compared with every text, in blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import cut
from .retrieval import BLOCK_QUERIES, compared

RUN = 5
SPACE = r"\s"


def _run_hash(words: str, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(words, at + k) for k in range(n)])


def holders(quotes: DataFrame, texts: DataFrame, key: str, fold: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(query_id, key): texts (key, text) that contain a quote (query_id, quote), both folded; null quotes and texts never."""
    asked = quotes.filter("quote is not null").select("query_id", fold(F.col("quote")).alias("_quote"))
    asked = asked.withColumn("_w", F.split("_quote", SPACE)).withColumn("_n", F.least(F.lit(RUN), F.size("_w") - 2))
    own = texts.filter("text is not null").select(key, fold(F.col("text")).alias("_body"))
    words = own.withColumn("_w", F.split("_body", SPACE))
    lengths = [r[0] for r in asked.filter("_n > 0").select("_n").distinct().collect()]  # at most five numbers
    met = None
    for n in lengths:
        keys = asked.filter(F.col("_n") == n).select("query_id", _run_hash("_w", F.lit(1), n).alias("_key"))
        keys = F.broadcast(keys) if keys.count() <= 10 * BLOCK_QUERIES else keys  # 16 bytes a quote
        runs = F.transform("_w", _runs_of(n))
        part = words.select(key, F.explode(F.array_distinct(runs)).alias("_key")).join(keys, "_key").select("query_id", key)
        met = part if met is None else met.unionByName(part)
    short = asked.filter("_n <= 0").select("query_id", "_quote")
    found = None
    if met is not None:
        near = cut(met.distinct())
        near = F.broadcast(near) if near.count() <= 10 * BLOCK_QUERIES else near  # pairs of ids, so that texts needn't move
        both = texts.join(near, key).join(asked.select("query_id", "_quote"), "query_id")
        found = both.filter(F.contains(fold(F.col("text")), F.col("_quote"))).select("query_id", key)
    if not short.isEmpty():
        alone = compared(short, own, lambda pairs: pairs.filter(F.contains("_body", F.col("_quote"))).select("query_id", key))
        found = alone if found is None else found.unionByName(alone)
    if found is None:
        return asked.join(own, F.lit(False)).select("query_id", key)
    return found


def _runs_of(n: int) -> Callable[[Column, Column], Column]:
    def run(_: Column, i: Column) -> Column:
        return _run_hash("_w", i, n)

    return run
