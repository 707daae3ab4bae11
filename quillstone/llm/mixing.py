"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are counted in words. Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the total; a
target never passes 3 times its source's size, and what that cuts off is shared by weight among the others.

Each source's documents fall by hash into up to 1,024 blocks. A pass draws a source's blocks in a permuted order of
its own; a source is drawn for as many full passes as its target holds, then for part of one. The block at which the
target is reached is opened in the same way: up to 1,024 sub-blocks, then the documents of the last sub-block, the
longest first, as long as they fit, and one more if it comes closer. So the words taken miss a target by at most half
the smallest document left there.

The numbers of draws (quotas) of all sources are split exactly among the output shards: a binary tree over the shards
halves them, and at each node the left half gets a random subset of the node's draws, chosen without replacement, so
its numbers by source are multivariate-hypergeometric. They are drawn source by source, each hypergeometric given those
before it, and in groups of FAN sources first where there are more, so no row holds more than FAN sources. A shard takes
disjoint runs of each source's permuted draws and orders its documents by a hash of its own. All randomness is hashing
with a seed, so reruns agree.

Everything on the path is a DataFrame function. Documents are aggregated before anything is shuffled, by source and
bucket; a source with a third of all rows is spread over its blocks. The plan tables have at most 1,024 rows a source
and pass; they are counted, and broadcast only if small; else they are joined by salted keys. Targets are found over a
row a source, about 40 bytes, in one task. Texts are only read, and joined with the plan as they are.

A null text has size 0. A document of size 0 is taken 0 words, and never drawn. Rows that repeat an id and text are
numbered, and each is drawn for itself. No rows give no rows. Extra columns pass through; one named like an added column
is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, words_of, written

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BUCKETS = 1024
DOCS_PER_BLOCK = 64
SHARDS = 16
SEED = 42
#: Words that one task shuffles within a shard.
WORDS_PER_SLICE = 2_000_000
#: Rows of a plan table (about 100 bytes each) up to which it is broadcast, and salts of the join beyond.
BROADCAST_ROWS = 100_000
SALTS = 16
#: Sources, or groups of them, that a node of the splitting tree draws for in one row.
FAN = 256


def with_sizes(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds size (words of the text) and _hash."""
    return df.withColumns({"size": F.size(words_of(F.col("text"))).cast("long"), "_hash": F.xxhash64(F.lit(seed), "doc_id", "text")})


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _meet(rows: DataFrame, table: DataFrame, met: Column, how: str = "inner") -> DataFrame:
    """Rows (with _hash) joined with a plan table, broadcast if it is small, else by salted keys, as sources may be hot."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), met, how)
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.lit(7), "_hash"), F.lit(SALTS)).cast("int")
    return rows.join(salted, met & (salt == F.col("_salt")), how).drop("_salt")


def _units(rows: DataFrame) -> DataFrame:
    """(doc_id, source, size, _hash, copies): rows that repeat an id and text are one unit."""
    return rows.groupBy("doc_id", "source", "size", "_hash").agg(F.count("*").alias("copies"))


def _numbered(units: DataFrame, first: Column | None = None) -> DataFrame:
    """A row for each copy of a unit, each but number 0 with a hash of its own; first: the number of the unit's first copy."""
    first = F.lit(0).cast("long") if first is None else first
    each = units.withColumn("_number", F.explode(F.sequence(first, first + F.col("copies") - 1)))
    return each.withColumn("_hash", F.when(F.col("_number") > 0, F.xxhash64("_hash", "_number")).otherwise(F.col("_hash"))).drop("_number", "copies")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _blocks_for(n: Column) -> Column:
    """A power of two up to BUCKETS, of about DOCS_PER_BLOCK documents a block."""
    wanted = F.greatest(F.lit(1), F.least(F.lit(BUCKETS), F.floor(n / DOCS_PER_BLOCK)))
    return F.pow(F.lit(2), F.length(F.bin(wanted)) - 1).cast("long")


def targets(cells: DataFrame) -> DataFrame:
    """(source, n, source_size, weight, place, target) from (source, ..., words, n); a row a source, so its windows are small."""
    sums = cells.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    sums = sums.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", F.get(weights, F.col("place") % len(WEIGHTS)).cast("long"))
    # the sources that stop at their cap are those with the least cap a weight; the rest share what is left by weight
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    out = sums.withColumn("cap", MOST_REPEATS * F.col("source_size"))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    out = out.withColumn("level", left / F.sum("weight").over(onward))
    out = out.withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("place"), F.col("level")))).over(every)["level"]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return out.select("source", "n", "source_size", "weight", "place", target.alias("target"))


def _fill(units: DataFrame, keys: list[str], unit: str, tag: int, seed: int) -> DataFrame:
    """Of units (keys, source, unit, words, room), in permuted order: whole if it still fits, and the room left at it."""
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(seed), F.lit(tag), "source", unit), unit)
    upto = F.sum("words").over(order)
    out = units.withColumns({"_upto": upto, "_rank": F.row_number().over(order) - 1})
    return out.withColumns({"whole": F.col("_upto") <= F.col("room"), "left": F.col("room") - (F.col("_upto") - F.col("words"))})


def hypergeometric(n: Column, a: Column, m: Column, u: Column) -> Column:
    """How many of m things drawn without replacement from n are among a of them; u, uniform from 0 to 1, picks the value.

    The weights of the values within eight deviations (and eight more) of the mean are multiplied up from the lowest; what
    lies beyond has a chance under 10**-14.
    """
    share = a / F.greatest(n, F.lit(1))
    spread = F.ceil(8 * F.sqrt(m * share * (1 - share) * (n - m) / F.greatest(n - 1, F.lit(1))) + 8)
    low = F.greatest(F.lit(0).cast("long"), m + a - n, F.floor(m * share) - spread)
    high = F.least(a, m, F.floor(m * share) + spread)
    # arrays of one element give values names, so that they aren't computed anew for each value
    bound = F.array(F.struct(n.alias("n"), a.alias("a"), m.alias("m"), u.alias("u"), low.cast("long").alias("low"), high.cast("long").alias("high")))

    def rise(v: Column, k: Column) -> Column:
        return ((v["a"] - k) * (v["m"] - k)).cast("double") / ((k + 1) * (v["n"] - v["a"] - v["m"] + k + 1)).cast("double")

    def values(v: Column) -> Column:
        return F.when(v["high"] > v["low"], F.sequence(v["low"], v["high"] - 1)).otherwise(F.array().cast("array<bigint>"))

    def add(v: Column):
        def step(s: Column, k: Column) -> Column:
            w = s["w"] * rise(v, k)
            return F.struct(w.alias("w"), (s["t"] + w).alias("t"))

        return F.aggregate(values(v), F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("t")), step, lambda s: s["t"])

    def pick(v: Column) -> Column:
        def step(s: Column, k: Column) -> Column:
            w = s["w"] * rise(v, k)
            on = s["t"] < v["goal"]
            return F.struct(F.when(on, w).otherwise(s["w"]).alias("w"), F.when(on, s["t"] + w).otherwise(s["t"]).alias("t"), F.when(on, k + 1).otherwise(s["k"]).alias("k"))

        return F.aggregate(values(v), F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("t"), v["low"].alias("k")), step, lambda s: s["k"])

    known = F.transform(bound, lambda v: F.struct(*[v[f].alias(f) for f in ("n", "a", "m", "low", "high")], (v["u"] * add(v)).alias("goal")))
    return F.transform(known, pick)[0]


def _left(nodes: DataFrame, most: Column, depth: int, seed: int) -> DataFrame:
    """(lo, hi, place, x): of each node's quotas (lo, hi, place, quota), the numbers that its left half draws.

    most: how many draws those are in all, by lo and hi. Groups of FAN ** k sources are drawn for first, k falling to 0.
    """
    drawn = None
    for k in reversed(range(depth)):
        child = F.expr(f"place div {FAN**k}")
        sums = nodes.groupBy("lo", "hi", child.alias("child")).agg(F.sum("quota").alias("n"))
        if drawn is None:
            of = sums.withColumns({"parent": F.lit(0).cast("long"), "m": most})
        else:
            of = sums.withColumn("parent", F.expr(f"child div {FAN}")).join(drawn.withColumnsRenamed({"place": "parent", "x": "m"}), ["lo", "hi", "parent"])
        rows = of.groupBy("lo", "hi", "parent", "m").agg(F.array_sort(F.collect_list(F.struct("child", "n"))).alias("children"), F.sum("n").alias("n"))  # FAN at most

        level = k  # of this round

        def step(state: Column, c: Column) -> Column:
            u = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "lo", "hi", c["child"]), F.lit(1 << 53)) / float(1 << 53)
            x = F.array(hypergeometric(state["n"], c["n"], state["m"], u))
            return F.transform(x, lambda v: F.struct((state["n"] - c["n"]).alias("n"), (state["m"] - v).alias("m"), F.concat(state["out"], F.array(F.struct(c["child"].alias("place"), v.alias("x")))).alias("out")))[0]

        start = F.struct(F.col("n"), F.col("m").cast("long").alias("m"), F.array().cast("array<struct<place:bigint,x:bigint>>").alias("out"))
        drawn = rows.select("lo", "hi", F.explode(F.aggregate("children", start, step, lambda s: s["out"])).alias("c")).select("lo", "hi", "c.*")
    return drawn


def _split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, place, quota): the leaves of the splitting tree below the quotas (place, quota) of all sources."""
    total, last = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.coalesce(F.max("place"), F.lit(0))).first()  # two numbers
    depth = 1
    while FAN**depth <= last:
        depth += 1
    node = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.col("place").cast("long").alias("place"), F.col("quota").cast("long").alias("quota"))
    width = 1
    while width < shards:
        width *= 2
        inner, leaves = node.filter("hi - lo > 1"), node.filter("hi - lo = 1")
        mid = F.expr("(lo + hi) div 2").cast("int")
        most = F.floor(F.lit(total) * mid / shards) - F.floor(F.lit(total) * F.col("lo") / shards)
        both = inner.join(_left(inner, most, depth, seed), ["lo", "hi", "place"])
        left = both.select("lo", mid.alias("hi"), "place", F.col("x").alias("quota"))
        right = both.select(mid.alias("lo"), "hi", "place", (F.col("quota") - F.col("x")).alias("quota"))
        node = written(leaves.unionByName(left).unionByName(right), "nodes")
    return node.select(F.col("lo").alias("shard"), "place", "quota")


class MixPlan:
    """The tables that say what is drawn, from sized documents (doc_id, source, size, _hash)."""

    def __init__(self, sized: DataFrame, shards: int = SHARDS, seed: int = SEED) -> None:
        self.shards, self.seed = shards, seed
        drawn = sized.filter("size > 0")
        bucket = F.pmod("_hash", F.lit(BUCKETS))
        cells = written(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.count_if(F.col("size") > 0).alias("n_drawn")), "cells")
        of = targets(cells).withColumn("blocks", _blocks_for(F.col("n"))).withColumn("passes", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
        self.sources = written(of.withColumn("room", F.floor(F.col("target") - F.col("passes") * F.col("source_size"))), "sources")
        sources = _small(self.sources.withColumnRenamed("source", "s_source"))
        blocks = cells.filter("words > 0").join(sources, _same("source", "s_source")).groupBy("source", F.pmod("bucket", "blocks").alias("block"), "passes", "room", "place")
        blocks = written(blocks.agg(F.sum("words").alias("words"), F.sum("n_drawn").alias("n")), "blocks")
        # one row a draw: the full passes, then the blocks of the last pass that fit, then the block that is opened
        passes = [F.when(F.col("passes") > p, F.lit(p)) for p in range(MOST_REPEATS)]
        full = blocks.withColumn("pass", F.explode(F.filter(F.array(*passes), lambda p: p.isNotNull())))
        part = _fill(blocks, ["source"], "block", 9, seed).filter("left > 0").withColumn("pass", F.col("passes").cast("int"))
        draws = full.select("source", "place", "block", "pass", F.lit(True).alias("whole")).unionByName(part.select("source", "place", "block", "pass", "whole"))
        draws = draws.withColumn("whole", F.col("whole"))
        opened = F.min(F.when(~F.col("whole"), F.col("_rank"))).over(Window.partitionBy("source"))
        self.opened = written(part.withColumn("_first", opened).filter("_rank = _first").select("source", "block", "words", "n", F.col("left").alias("room")), "opened")
        first_open = self.opened.select(F.col("source").alias("o_source"), F.col("block").alias("o_block"))
        draws = draws.join(_small(first_open), _same("source", "o_source"), "left").filter("whole or block = o_block").drop("o_source", "o_block")
        order = Window.partitionBy("source").orderBy("pass", ~F.col("whole"), F.xxhash64(F.lit(seed), F.col("pass"), "source", "block"), "block")
        draws = written(draws.withColumn("draw", (F.row_number().over(order) - 1).cast("long")), "draws")
        self.draws = written(self._dealt(draws), "plan")
        self._open(drawn)

    def _dealt(self, draws: DataFrame) -> DataFrame:
        """(source, block, entries): the draws of each block with their shards."""
        each = draws.groupBy("place").agg(F.count("*").alias("quota"))
        by_source = _split(each, self.shards, self.seed).withColumnRenamed("place", "d_place").filter("quota > 0")
        upto = F.sum("quota").over(Window.partitionBy("d_place").orderBy("shard"))
        runs = by_source.withColumn("upto", upto).select("shard", "d_place", F.explode(F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("d_draw"))
        dealt = draws.join(runs, (F.col("place") == F.col("d_place")) & (F.col("draw") == F.col("d_draw")))
        return dealt.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "whole", "shard"))).alias("entries"))  # three at most

    def _open(self, drawn: DataFrame) -> None:
        """Of the opened blocks: the sub-blocks that are whole, and the documents of the last that fit."""
        opened = self.opened.select(F.col("source").alias("o_source"), F.col("block").alias("o_block"), "room", _blocks_for(F.col("n")).alias("subs"))
        opened = opened.join(_small(self.sources.select(F.col("source").alias("p_source"), "blocks")), _same("o_source", "p_source")).drop("p_source")
        here = _meet(drawn, opened, _same("source", "o_source") & (F.pmod(F.pmod("_hash", F.lit(BUCKETS)), "blocks") == F.col("o_block")))
        here = written(here.withColumn("sub", F.pmod(F.shiftright("_hash", 10), "subs")).select("source", "doc_id", "size", "_hash", "sub", "subs", "room"), "opened-docs")
        subs = here.groupBy("source", "sub", "subs", "room").agg(F.sum("size").alias("words"))
        filled = _fill(subs, ["source"], "sub", 10, self.seed).filter("left > 0")
        first = F.min(F.when(~F.col("whole"), F.col("_rank"))).over(Window.partitionBy("source"))
        filled = filled.withColumn("_first", first).filter("whole or _rank = _first")
        self.subs = written(filled.select("source", "sub", "subs", "whole", F.col("left")), "subs")
        last = self.subs.filter("not whole").select(F.col("source").alias("l_source"), F.col("sub").alias("l_sub"), "left")
        docs = _meet(here, last, _same("source", "l_source") & (F.col("sub") == F.col("l_sub")))
        units = docs.groupBy("source", "_hash", "doc_id", "left").agg(F.sum("size").alias("size"))
        gathered = units.groupBy("source", "left").agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("order"), "_hash", "doc_id", "size"))).alias("docs"))  # one sub-block
        unit = "struct<size:bigint,_hash:bigint,doc_id:bigint>"
        start = F.struct(F.col("left").cast("long").alias("left"), F.array().cast(f"array<{unit}>").alias("out"), F.lit(None).cast(unit).alias("spare"))

        def take(state: Column, x: Column) -> Column:
            fits = x["size"] <= state["left"]
            one = F.struct(x["size"].alias("size"), x["_hash"].alias("_hash"), x["doc_id"].cast("long").alias("doc_id")).cast(unit)
            left = F.when(fits, state["left"] - x["size"]).otherwise(state["left"])
            out = F.when(fits, F.concat(state["out"], F.array(one))).otherwise(state["out"])
            return F.struct(left.alias("left"), out.alias("out"), F.when(fits, state["spare"]).otherwise(F.least(state["spare"], one)).alias("spare"))

        def end(state: Column) -> Column:
            # the smallest document that didn't fit comes closer to the target than none if it passes it by less than is missing
            closer = state["spare"]["size"] - state["left"] < state["left"]
            return F.when(closer, F.concat(state["out"], F.array(state["spare"]))).otherwise(state["out"])

        picked = gathered.select("source", F.explode(F.aggregate("docs", start, take, end)).alias("d"))
        self.picked = written(picked.select("source", "d._hash", "d.doc_id"), "picked")

    def apply(self, df: DataFrame) -> DataFrame:
        """Adds source_size, target, taken and shards (one for each time that the row is drawn) to sized documents."""
        sources = self.sources.select(F.col("source").alias("s_source"), "source_size", "target", "blocks")
        out = _meet(df.drop("source_size", "target", "taken", "shards"), sources, _same("source", "s_source")).withColumn("_block", F.pmod(F.pmod("_hash", F.lit(BUCKETS)), "blocks"))
        plan = self.draws.select(F.col("source").alias("d_source"), F.col("block").alias("d_block"), "entries")
        out = _meet(out, plan, _same("source", "d_source") & (F.col("_block") == F.col("d_block")) & (F.col("size") > 0), "left")
        in_part = F.exists("entries", lambda e: ~e["whole"])
        subs = self.subs.select(F.col("source").alias("u_source"), "sub", "subs", F.col("whole").alias("u_whole"))
        out = _meet(out, subs, _same("source", "u_source") & (F.pmod(F.shiftright("_hash", 10), "subs") == F.col("sub")) & in_part, "left")
        picked = self.picked.select(F.col("source").alias("k_source"), F.col("_hash").alias("k_hash"), F.col("doc_id").alias("k_id"))
        mine = _same("source", "k_source") & (F.col("_hash") == F.col("k_hash")) & _same("doc_id", "k_id") & ~F.coalesce("u_whole", F.lit(True))
        out = _meet(out, picked, mine, "left")
        fits = F.coalesce(F.col("u_whole") | F.col("k_hash").isNotNull(), F.lit(False))
        entries = F.coalesce(F.filter("entries", lambda e: e["whole"] | fits), F.array().cast("array<struct<pass:int,whole:boolean,shard:int>>"))
        out = out.withColumn("shards", F.transform(entries, lambda e: e["shard"])).withColumn("taken", F.col("size") * F.size("shards"))
        return out.select(*[c for c in df.columns if c not in ("source_size", "target", "taken", "shards")], "source_size", "target", "taken", "shards")


def _sized(df: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """The units of df, and its rows (doc_id, source, size, _hash), each copy with a hash of its own; both written."""
    units = written(_units(with_sizes(df, seed).select("doc_id", "source", "size", "_hash")), "units")
    return units, written(_numbered(units), "sized")


def assign(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shards) for each row of documents."""
    _, sized = _sized(df, seed)
    return MixPlan(sized, shards, seed).apply(sized).drop("_hash")


def _apart(work: DataFrame, repeated: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of work, the copies of repeated units each with a hash of its own.

    Copies that are alike in all columns are counted before they meet, so a row repeated ever so often is one row.
    """
    again = repeated.select(F.col("_hash").alias("r_hash")).distinct()
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    single = work.join(again, F.col("_hash") == F.col("r_hash"), "left_anti")
    alike = F.xxhash64(*[F.col("_row").getField(c) for c in columns])
    many = work.join(again, F.col("_hash") == F.col("r_hash"), "left_semi").withColumn("_alike", alike)
    many = many.groupBy("doc_id", "source", "size", "_hash", "_alike").agg(F.first("_row").alias("_row"), F.count("*").alias("copies"))
    first = F.sum("copies").over(Window.partitionBy("_hash", "doc_id", "source").orderBy("_alike")) - F.col("copies")
    return single.unionByName(_numbered(many.withColumn("_first", first), F.col("_first")).select(single.columns))


def mix(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row as often as it is drawn, dealt out by shard and shuffled within each."""
    units, sized = _sized(df, seed)
    work = with_sizes(packed(df, doc_id="doc_id", source="source", text="text"), seed).drop("text")
    repeated = units.filter("copies > 1")
    if not repeated.isEmpty():
        work = _apart(work, repeated, [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    plan = MixPlan(sized, shards, seed)
    drawn = plan.apply(work)
    words = plan.sources.agg(F.sum("target")).first()[0] or 0  # one number
    slices = max(8, math.ceil(words / shards / WORDS_PER_SLICE))
    rows = drawn.select("_row", "_hash", F.posexplode("shards").alias("_turn", "_shard"))
    salt = F.pmod(F.xxhash64("_hash", "_turn"), F.lit(slices))  # a shard may be larger than a task
    local = F.xxhash64(F.lit(seed), "_shard", "_hash", "_turn")
    return rows.withColumn("_local", local).repartition("_shard", salt).sortWithinPartitions("_shard", "_local").select("_row.*")
