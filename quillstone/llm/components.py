"""Connected components of a graph of bigint nodes by rounds of contraction; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh_name, written

#: Copies of one key beyond which its rows are not shuffled by it.
HOT_COPIES = 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); root is one node of the component, the same for all of it.

    In each round a node moves to the least of itself and its neighbours, and the edges move with their ends. That
    keeps connected what was, and at least halves long chains. Rounds end when no edge is left. Self-loops and
    repeated edges do no harm; no edges give no rows.
    """
    left = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "moves")
        moves.append(move)
        of_a, of_b = move.toDF("a", "ra"), move.toDF("b", "rb")
        moved = left.join(of_a, "a").join(of_b, "b").filter("ra <> rb")
        fresh = written(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        discard(left)
        left = fresh
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found, rounds = moves[-1], moves[:-1]
    while rounds:
        step, later = rounds.pop(), found.toDF("root", "last")
        found = step.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    out = written(found, "roots")
    discard(left, *moves)
    return out


def classes(docs: DataFrame, links, key: str) -> DataFrame:
    """(doc_id, key, root, component_id) of docs (doc_id, key), written; links: a function from the distinct keys to edges.

    root tells components apart; component_id is the smallest doc_id of the component, null if none has an id.
    """
    low = written(docs.groupBy(key).agg(F.min("doc_id").alias("low"), F.count("*").alias("copies")), "distinct")
    roots = components(links(low))
    linked = roots.toDF(key, "root").join(low, key)
    lowest = linked.groupBy("root").agg(F.min("low").alias("component"))
    of_linked = linked.join(lowest, "root").select(key, "root", "component", F.lit(True).alias("linked"))
    found = low.join(of_linked, key, "left")
    of_key = written(found.select(key, "copies", F.coalesce("root", key).alias("root"), F.when(F.col("linked"), F.col("component")).otherwise(F.col("low")).alias("component_id")), "classes")
    # keys of many copies are few, at most a row for HOT_COPIES rows: they are broadcast, so that no task gets all copies
    hot, names = of_key.filter(F.col("copies") > HOT_COPIES).drop("copies"), ["doc_id", key, "root", "component_id"]
    members = docs.join(of_key.filter(F.col("copies") <= HOT_COPIES), key).select(names)
    if not hot.isEmpty():
        members = members.unionByName(docs.join(F.broadcast(hot), key).select(names))
    out = written(members, "members")
    discard(low, of_key, roots)
    return out


def one_of_each(df: DataFrame, found: DataFrame, key: str, with_key) -> DataFrame:
    """One row of df for each component of found (doc_id, key, root): that of the smallest doc_id, nulls last.

    Of rows of one component with the same id, the one with the smallest key stays; of those with the same key, the one
    whose text and other columns hash lowest, so reruns agree. with_key(df, name) adds the key of each row.
    """
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", key)).alias("b"))
    best = written(best.select(F.col("b.doc_id").alias("b_id"), F.col(f"b.{key}").alias("b_key")), "kept")
    # a row that repeats both is looked at only if there is one
    rows = found.join(best, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col(key) == F.col("b_key")), "left_semi").count()
    name, mine = fresh_name(df, "_key"), fresh_name(df, "_hash")
    keyed = with_key(df, name)
    same = keyed["doc_id"].cast("long").eqNullSafe(best["b_id"]) & (keyed[name] == best["b_key"])
    out = keyed.join(best, same, "left_semi")
    if rows > best.count():
        out = out.withColumn(mine, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")]))
        least = out.groupBy(F.col("doc_id").alias("l_id"), F.col(name).alias("l_key")).agg(F.min(mine).alias("l_hash"))
        out = out.join(least, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col(name) == F.col("l_key")) & (F.col(mine) == F.col("l_hash")), "left_semi").dropDuplicates(["doc_id", name])
    return out.select([F.col(f"`{c}`") for c in df.columns])
