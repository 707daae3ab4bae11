"""Near copies by SimHash and anchor-point covering, checked by exact Jaccard similarity; no similar pair is lost.

A text's words are those of simhash; it has the set of its shingles of 5 words, or of the whole sequence if it has
fewer words. Two texts are linked if the Jaccard similarity of their sets is at least 0.8 (as hashes of 64 bits).
Equal sets are one, found by a digest, before anything is compared.

First, sets meet by the operator of op1: a set's fingerprint is the SimHash of its shingles, and it is sent to the
anchors of a covering code. Similar texts differ by up to about a third of their bits, too far for a covering of 64 bits
at once, so the fingerprint is cut in thirds, and each third has its own covering for 2 bits. Fingerprints within 8 bits
have a third within 2, so they always meet at an anchor. At an anchor, each set is paired with the next of a like size
whose whole fingerprint differs by at most NEAR_BITS; whole sets then decide.

No bound on bits follows from a similarity, so links may lie beyond the covering. What it has not connected is made
whole by an exact prefix filter. All shingles have one global order: the frequent ones last, as far as a sketch of SKETCH counters tells them, then by
hash. Sets of n and m shingles that are similar share at least 0.8 / 1.8 * (n + m), so they share one of the first
n - ceil(0.8 n) + 1 of n; sets meet at these. Any order is exact; the sketch only keeps the groups small. Sets that meet
at several shingles do so at the first. At a meeting, pairs go whose sizes or places in the order can't reach the
similarity, then those whose marks can't: a mark counts a set's shingles in MARK classes, and no two sets share more
than the lesser counts. Only the others leave the task that found them, and are compared by their whole sets.

Only what connects is wanted, so this comparing goes in rounds, too, over what has no link yet: first the next neighbours in a group, then near ones, then
all of a group whose components still differ. A group of alike texts thus gives about as many pairs as it has texts.

A null, empty or blank text has the empty set; those are one group of copies. Texts of any length have all their
shingles. Repeated rows are copies like any other. No rows give no links. Extra columns take part in no comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import discard, slices, thrifty, with_columns, written
from .components import classes, components, one_of_each

SHINGLE_WORDS = 5
SEED = 42
#: Similar: intersection / union >= TENTHS / 10.
TENTHS = 8
SKETCH = 1 << 20
#: The first bit and the length of each part of a fingerprint that has a covering of its own.
PARTS = ((0, 22), (22, 21), (43, 21))
#: Bits by which whole fingerprints may differ to be paired at an anchor; the sets decide, so this only saves comparing.
NEAR_BITS = 14
#: The distances in a group up to which pairs are compared, by round; the last round has no bound.
REACHES = (1, 8, None)
#: The distance in a group up to which rows are tried before they are written.
TRIED = 64
#: Rows of pairs in a batch.
BATCH = 20_000
#: Classes of shingles that a set's mark counts.
MARK = 256


def shingles_of(text: str | None) -> np.ndarray:
    """The sorted, distinct hashes of one text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE_WORDS:
        found = [b" ".join(words)]
    else:
        found = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh64_digest, found, repeat(SEED))), ">u8").astype(np.uint64))


def key_of(shingles: np.ndarray) -> int:
    """A signed digest of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def prefix_length(n: int) -> int:
    return n - (TENTHS * n + 9) // 10 + 1


def fingerprint_of(shingles: np.ndarray) -> int:
    """The signed SimHash of a set."""
    return int(np.uint64(simhash.majority(shingles.astype(">u8").view(np.uint8).reshape(-1, 8))).view(np.int64))


def keys(df: DataFrame) -> DataFrame:
    """(doc_id, key, size, fp) of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, sizes, fps = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles_of(text)
                found.append(key_of(s))
                sizes.append(len(s))
                fps.append(fingerprint_of(s))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64()), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64())], names=["doc_id", "key", "size", "fp"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(thrifty(run), "doc_id bigint, key bigint, size int, fp bigint")


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, size, fp) for each anchor within 2 of each part of the fingerprints; the part is in the anchor's top bits."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            size, fp = part.column("size").to_numpy(), part.column("fp").to_numpy()
            for k, (first, bits) in enumerate(PARTS):
                rows, anchor = simhash.anchors_of(fp.view(np.uint64) >> np.uint64(first) & np.uint64((1 << bits) - 1), bits)
                yield pa.RecordBatch.from_arrays([pa.array((anchor | np.uint64(k << 24)).astype(np.int32)), pa.array(size[rows]), pa.array(fp[rows])], names=["anchor", "size", "fp"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fa, na, fb, nb): each fingerprint and size with the next one at its anchor that may be similar."""
    for x in _groups(batches, ["anchor", "size", "fp"]):
        lag, at, size = 1, np.arange(len(x["fp"])), x["size"].astype(np.int64)
        while True:
            at = at[at + lag < len(x["fp"])]
            # sizes rise in a group, so a set that is too large for one stays so at greater distances
            at = at[(x["anchor"][at] == x["anchor"][at + lag]) & (10 * size[at] >= TENTHS * size[at + lag])]
            if not len(at):
                break
            near = np.bitwise_count(x["fp"][at].view(np.uint64) ^ x["fp"][at + lag].view(np.uint64)) <= NEAR_BITS
            own = at[near]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(x[n][i]) for i in (own, own + lag) for n in ("fp", "size")], names=["fa", "na", "fb", "nb"])
            at, lag = at[~near], lag + 1


def covered(sets: DataFrame) -> DataFrame:
    """(a, b): pairs of keys of distinct sets (key, size, fp) that meet at an anchor and may be similar.

    Sets of one fingerprint and size go to the anchors once, and are paired with the one of the least key.
    """
    points = written(sets.filter("size > 0").groupBy("fp", "size").agg(F.min("key").alias("least")), "points")
    sent = points.select("size", "fp").mapInArrow(thrifty(_sent), "anchor int, size int, fp bigint")
    met = sent.repartition("anchor").sortWithinPartitions("anchor", "size", "fp").mapInArrow(thrifty(_paired), "fa bigint, na int, fb bigint, nb int").distinct()
    near = met.join(points.toDF("fa", "na", "a"), ["fa", "na"]).join(points.toDF("fb", "nb", "b"), ["fb", "nb"]).select("a", "b")
    alike = sets.join(points, ["fp", "size"]).filter("key <> least").select("least", "key")
    out = written(near.unionAll(alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "covered")
    discard(points)
    return out


def levels(df: DataFrame) -> bytes:
    """For each counter of the sketch, how frequent its shingles are: 0 up to twice the mean, then by powers of two.

    A task counts up to 255 in each counter, which is enough for an order.
    """
    width = SKETCH // 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        for batch in slices(batches, "text"):
            found = np.concatenate([shingles_of(x) for x in batch.column("text").to_pylist()])
            counts += np.bincount((found % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        if counts.any():
            part = np.minimum(counts, 255).astype(np.uint8).reshape(64, width)
            yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array([x.tobytes() for x in part], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[block] = total.get(block, 0) + np.frombuffer(counts, np.uint8).astype(np.int32)
        for block, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["block", "counts"])

    summed = df.select("text").mapInArrow(thrifty(count), "block int, counts binary").repartition("block").mapInArrow(thrifty(add), "block int, counts binary")
    counts = np.zeros((64, width), np.int64)
    for block, part in summed.collect():  # 64 rows of 64 KiB
        counts[block] = np.frombuffer(part, np.int32)
    over = counts.ravel() / max(2 * counts.mean(), 1)
    return np.ceil(np.log2(np.maximum(over, 1))).astype(np.uint8).tobytes()


def prefixes(df: DataFrame, level: bytes) -> DataFrame:
    """(shingle, size, place, key): the first shingles of each set in the global order; a task gives a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.frombuffer(level, np.uint8), set()
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                s = shingles_of(text)
                key = key_of(s)
                if len(s) and key not in seen:
                    seen.add(key)
                    s = s[np.lexsort((s, table[(s % np.uint64(SKETCH)).astype(np.int64)]))]
                    p = prefix_length(len(s))
                    out.append((s[:p].view(np.int64), np.full(p, len(s), np.int32), np.arange(p, dtype=np.int32), np.full(p, key, np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["shingle", "size", "place", "key"])

    return df.select("text").mapInArrow(thrifty(run), "shingle bigint, size int, place int, key bigint")


def _values(column: pa.Array) -> np.ndarray:
    """A column as an array; marks as rows of counts."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, MARK)
    return column.to_numpy()


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The batches, sorted by the first name, cut so that each value of it is whole, without values that are alone."""
    held, by = None, names[0]

    def met(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        same = np.zeros(len(x[by]), bool)
        same[1:] = x[by][1:] == x[by][:-1]
        same[:-1] |= same[1:]
        return {n: x[n][same] for n in names}

    for batch in batches:
        x = {n: _values(batch.column(n)) for n in names}
        if held is not None:
            x = {n: np.concatenate([held[n], x[n]]) for n in names}
        if not len(x[by]):
            continue
        cut = int(np.searchsorted(x[by], x[by][-1]))
        yield met({n: x[n][:cut] for n in names})
        held = {n: x[n][cut:] for n in names}
    if held is not None:
        yield met(held)


def _near(x: dict[str, np.ndarray], at: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows `at`, those with a row of their group `lag` on that isn't too large, and which of these may be similar."""
    at = at[at + lag < len(x["key"])]
    to = at + lag
    n, m = x["size"][at].astype(np.int64), x["size"][to].astype(np.int64)
    # sizes rise in a group, so a set that is too large for one stays so at greater distances
    near = (x["shingle"][at] == x["shingle"][to]) & (10 * n >= TENTHS * m)
    at, to, n, m = at[near], to[near], n[near], m[near]
    most = np.minimum(n - x["place"][at], m - x["place"][to])  # if this is the first shingle that both have
    return at, (10 + TENTHS) * most >= TENTHS * (n + m)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """Keys as well mixed numbers, whose sum tells a set of keys."""
    x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def meetings(rows: DataFrame) -> DataFrame:
    """(shingle, size, place, key): the prefix rows that may be similar to another one of their shingle, written.

    Beyond TRIED rows on, all that aren't too large may be. Where the same sets meet at several shingles, only the first
    one in the order is kept: it is the first that any two of them have.
    """
    names = ["shingle", "size", "place", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _groups(batches, names):
            fresh = np.ones(len(x["key"]), bool)  # sets of several tasks come repeatedly
            fresh[1:] = (x["shingle"][1:] != x["shingle"][:-1]) | (x["key"][1:] != x["key"][:-1])
            x = {n: v[fresh] for n, v in x.items()}
            keep = np.zeros(len(x["key"]), bool)
            at = np.arange(len(x["key"]))
            for lag in range(1, TRIED + 1):
                at, good = _near(x, at, lag)
                if lag == TRIED:
                    good[:] = True
                    keep |= np.isin(x["shingle"], x["shingle"][at])  # the whole group may meet later
                keep[at[good]] = True
                keep[at[good] + lag] = True
                if not len(at):
                    break
            x = {n: v[keep] for n, v in x.items()}
            if len(x["key"]):
                start = np.flatnonzero(np.concatenate([[True], x["shingle"][1:] != x["shingle"][:-1]]))
                length = np.diff(np.append(start, len(x["key"])))
                who = np.add.reduceat(_mixed(x["key"]), start).view(np.int64)
                where = np.add.reduceat(x["place"].astype(np.int64), start)
                yield pa.RecordBatch.from_arrays([*(pa.array(x[n]) for n in names), pa.array(np.repeat(who, length)), pa.array(np.repeat(where, length))], names=[*names, "who", "places"])

    schema = "shingle bigint, size int, place int, key bigint, who bigint, places bigint"
    met = written(rows.repartition("shingle").sortWithinPartitions("shingle", "size", "key").mapInArrow(thrifty(run), schema), "met")
    first = met.groupBy("who").agg(F.min(F.struct("places", "shingle"))["shingle"].alias("shingle")).select("shingle").distinct()
    out = written(met.join(first, "shingle", "left_semi").select(*names), "meetings")
    discard(met)
    return out


def candidates(met: DataFrame, beyond: int, reach: int | None) -> DataFrame:
    """(a, b): pairs more than `beyond` and up to `reach` apart in a group, not connected yet (root), that may be similar.

    met: (shingle, size, place, key, mark, root). Two sets share at most the lesser count of each class of their marks.
    """
    names = ["shingle", "size", "place", "key", "mark", "root"]

    def possible(x: dict[str, np.ndarray], at: np.ndarray, to: np.ndarray) -> np.ndarray:
        least = np.minimum(x["mark"][at], x["mark"][to])
        most = least.sum(1, dtype=np.int64) + (least == 255).any(1) * (1 << 40)  # a full count has no bound
        return (10 + TENTHS) * most >= TENTHS * (x["size"][at].astype(np.int64) + x["size"][to])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _groups(batches, names):
            lag, at = 1, np.arange(len(x["key"]))
            while reach is None or lag <= reach:
                at, good = _near(x, at, lag)
                if not len(at):
                    break
                good &= (lag > beyond) & (x["root"][at] != x["root"][at + lag])
                one = at[good]
                for i in range(0, len(one), BATCH):
                    own = one[i : i + BATCH]
                    own = own[possible(x, own, own + lag)]
                    if len(own):
                        p, q = x["key"][own], x["key"][own + lag]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], names=["a", "b"])
                lag += 1

    return met.repartition("shingle").sortWithinPartitions("shingle", "size", "key").mapInArrow(thrifty(run), "a bigint, b bigint").distinct()


def _wanted(keys: DataFrame) -> np.ndarray:
    """A table of SKETCH bits that holds all keys (key); others may hit it, too."""
    table = np.zeros(SKETCH, bool)
    table[keys.select(F.pmod("key", F.lit(SKETCH)).alias("at")).distinct().toArrow().column("at").to_numpy()] = True  # at most SKETCH rows
    return np.packbits(table)


def _of_wanted(df: DataFrame, keys: DataFrame, make, schema: str, kind: pa.DataType) -> DataFrame:
    """(key, size, value): once for each key in the table, make(set) of its set; a task gives a key once."""
    bits = _wanted(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.unpackbits(bits), set()
        for batch in slices(batches, "text"):
            out = {}
            for text in batch.column("text").to_pylist():
                s = shingles_of(text)
                key = key_of(s)
                if table[key % SKETCH] and key not in seen:
                    seen.add(key)
                    out[key] = len(s), make(s)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([n for n, _ in out.values()], pa.int32()), pa.array([v for _, v in out.values()], kind)], names=["key", "size", "value"])

    return df.select("text").mapInArrow(thrifty(run), f"key bigint, size int, value {schema}").dropDuplicates(["key"])


def mark_of(shingles: np.ndarray) -> bytes:
    """How many of a set's shingles fall in each of MARK classes, up to 255."""
    return np.minimum(np.bincount((shingles >> np.uint64(32)).astype(np.int64) % MARK, minlength=MARK), 255).astype(np.uint8).tobytes()


def verified(pairs: DataFrame, df: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose whole sets, made anew from the texts, are similar."""
    asked = pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key")))
    sets = written(_of_wanted(df, asked, lambda s: s.view(np.int64), "array<bigint>", pa.list_(pa.int64())), "sets")
    both = pairs.join(sets.toDF("a", "na", "sa"), "a").join(sets.toDF("b", "nb", "sb"), "b")
    out = written(both.filter((10 + TENTHS) * F.size(F.array_intersect("sa", "sb")) >= TENTHS * (F.col("na") + F.col("nb"))).select("a", "b"), "links")
    discard(sets)
    return out


def links(df: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the keys of the documents' sets (key, size, fp) as all similar pairs do."""
    pairs = covered(sets)
    found = verified(pairs, df)
    discard(pairs)
    return found.unionAll(rest(df, found))


def rest(df: DataFrame, found: DataFrame) -> DataFrame:
    """Edges (a, b) that connect, together with the found ones, the keys as all similar pairs do."""
    bare = meetings(prefixes(df, levels(df)))
    marks = _of_wanted(df, bare, mark_of, "binary", pa.binary())
    met = written(bare.join(marks.select("key", F.col("value").alias("mark")), "key"), "marked")
    out, roots, beyond = found.limit(0), components(found), 0
    for reach in REACHES:
        labelled = met.join(roots.toDF("key", "found"), "key", "left").withColumn("root", F.coalesce("found", "key"))
        pairs = written(candidates(labelled, beyond, reach), "candidates")
        fresh = verified(pairs, df)
        discard(pairs, roots)
        out = out.unionAll(fresh)
        if reach is not None:
            roots, beyond = components(found.unionAll(out)), reach
    discard(bare, met)
    return out


def cluster(df: DataFrame) -> DataFrame:
    """(doc_id, key, root, component_id) for each row; component_id is the smallest doc_id reachable over links."""
    found = written(keys(df), "keys")
    return classes(found.select("doc_id", "key"), lambda _: links(df, found.select("key", "size", "fp").distinct()), "key")


def with_keys(df: DataFrame, name: str) -> DataFrame:
    """Adds the digest of each text's set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield with_columns(batch, [name], [pa.array([key_of(shingles_of(x)) for x in batch.column("text").to_pylist()], pa.int64())])

    return df.mapInArrow(thrifty(run), T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(df: DataFrame) -> DataFrame:
    """The documents (doc_id, text, ...) without near copies: of each component, the one with the smallest doc_id.

    Rows are told apart by id and digest, so ids that several documents share lose none and keep no copy.
    """
    return one_of_each(df, cluster(df), "key", with_keys)
