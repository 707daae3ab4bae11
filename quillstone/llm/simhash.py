"""SimHash near-dedup by anchor-point covering.

The anchors are the words of a covering code of length 64: the Hamming code on bits 1 to 63 beside a free bit 0. Its
covering radius is 1, so every 64-bit point has an anchor within 1. Two fingerprints that differ in at most 2 bits
have a point that lies within 1 of both (half the threshold, rounded up); the anchor of that point lies within
1 + 1 = 2 of both. So each fingerprint goes to every anchor within 2: 33 of them, or 2 for a fingerprint that is an
anchor itself, found from its syndrome without a search. Linked fingerprints always meet at an anchor, and at most
2,081 distinct fingerprints can lie within 2 of one anchor, so no group is unbounded, whatever the data.

Fingerprints are made distinct before they are replicated, so exact copies, however many, cost one. At an anchor all
its fingerprints are compared, and links come out as a star for each local component, never as all pairs. Components
of those links come from contraction rounds, each a written table.

A text's words are lower-cased in A-Z; it has the shingles of 3 words, repeats included, or the whole sequence if it
has fewer words. A null, empty or blank text has no shingle and the fingerprint zero, which links like any other.
Repeated rows come out repeated; a null doc_id never names a component unless no other id is there. An empty table has no
components. Extra columns stay out of the shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, with_columns, written
from .components import classes, one_of_each

SHINGLE_WORDS = 3
SEED = 42
THRESHOLD = 2
#: Pairs that are compared at once.
BLOCK_PAIRS = 8_000_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)


def fingerprint_of(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
    return majority(np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED))), np.uint8).reshape(-1, 8))


def majority(digests: np.ndarray) -> int:
    """The unsigned number whose bits are those set in over half of the digests (rows of 8 bytes)."""
    counts = np.zeros(2048, np.int64)
    for at in range(0, len(digests), 1 << 16):
        counts += np.bincount((digests[at : at + (1 << 16)] + _LANES).ravel(), minlength=2048)
    ones = np.einsum("lv,vb->lb", counts.reshape(8, 256), _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint as a (signed) bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = np.array([fingerprint_of(x) for x in batch.column(text).to_pylist()], np.uint64).view(np.int64)
            yield with_columns(batch, [out], [pa.array(found)])

    return df.mapInArrow(run, T.StructType([f for f in df.schema.fields if f.name.lower() != out.lower()] + [T.StructField(out, T.LongType())]))


def anchors_of(fp: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for each anchor within 2 of each unsigned fingerprint of a length in bits.

    The Hamming code is the longest that leaves a free bit: on bits 1 to 63 of 64, on bits 1 to 15 of 21. Two flips of
    free bits lead from an anchor to another one.
    """
    n, end = len(fp), 1 << bits.bit_length() - 1
    free = [np.uint64(1 << i) for i in (0, *range(end, bits))]
    syndrome = np.zeros(n, np.uint64)
    for bit in range(1, end):  # the exclusive or of the places of all set bits: zero for an anchor
        syndrome ^= (fp >> np.uint64(bit) & np.uint64(1)) * np.uint64(bit)
    base = np.where(syndrome > 0, fp ^ np.uint64(1) << syndrome, fp)
    rows, found = [np.arange(n)] * (1 + len(free)), [base, *(base ^ x for x in free)]
    off, on = np.flatnonzero(syndrome), np.flatnonzero(syndrome == 0)
    for i in range(1, end):  # two flips i and i ^ syndrome lead to an anchor, too
        j = syndrome[off] ^ np.uint64(i)
        pick = j > np.uint64(i)
        rows.append(off[pick])
        found.append(fp[off[pick]] ^ np.uint64(1 << i) ^ np.uint64(1) << j[pick])
    for x, y in combinations(free, 2):
        rows.append(on)
        found.append(fp[on] ^ x ^ y)
    return np.concatenate(rows), np.concatenate(found)


def local_links(anchor: np.ndarray, fp: np.ndarray, threshold: int) -> np.ndarray:
    """For rows sorted by anchor, the least row that each is connected to by links inside its anchor's group."""
    n = len(anchor)
    label = np.arange(n)
    lag, at = 1, np.arange(n)
    ends_a, ends_b = [], []
    while True:
        at = at[at + lag < n]
        at = at[anchor[at] == anchor[at + lag]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= threshold]
        ends_a.append(near)
        ends_b.append(near + lag)
        lag += 1
    if not ends_a:
        return label
    a, b = np.concatenate(ends_a), np.concatenate(ends_b)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            fp = batch.column("fp").slice(at, 20_000).to_numpy().view(np.uint64)
            rows, anchor = anchors_of(fp)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[rows].view(np.int64))], names=["anchor", "fp"])


def _compare(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(anchor: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            same = np.zeros(len(anchor), bool)
            same[1:] = anchor[1:] == anchor[:-1]
            same[:-1] |= same[1:]  # a fingerprint alone at an anchor has no partner there
            anchor, fp = anchor[same], fp[same]
            if not len(anchor):
                return
            starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            sizes = np.diff(np.append(starts, len(anchor)))
            block = np.cumsum(sizes.astype(np.int64) ** 2) // BLOCK_PAIRS
            borders = np.append(starts[np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))], len(anchor))
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                own = fp[a:b]
                label = local_links(anchor[a:b], own.view(np.uint64), threshold)
                moved = np.flatnonzero(label != np.arange(b - a))
                if len(moved):
                    yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[label[moved]])], names=["a", "b"])

        held_a, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            anchor = np.concatenate([held_a, batch.column("anchor").to_numpy()])
            fp = np.concatenate([held_f, batch.column("fp").to_numpy()])
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            yield from links(anchor[:cut], fp[:cut])
            held_a, held_f = anchor[cut:], fp[cut:]
        yield from links(held_a, held_f)

    return run


def near_links(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (fp) as links of at most threshold (0 to 2) bits do."""
    if not 0 <= threshold <= 2:
        raise ValueError("the covering holds for thresholds up to 2")
    anchors = fps.select("fp").mapInArrow(_replicate, "anchor bigint, fp bigint")
    met = anchors.repartition("anchor").sortWithinPartitions("anchor")
    return met.mapInArrow(_compare(threshold), "a bigint, b bigint")


def cluster(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, fp, root, component_id) for each row; component_id is the smallest doc_id reachable over links, root the
    fingerprint that names the component."""
    docs = written(fingerprints(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fp"), "fingerprints")
    return classes(docs, lambda distinct: near_links(distinct, threshold), "fp")


def keep_one(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents (doc_id, text, ...) without near copies: of each component, the one with the smallest doc_id.

    Rows are told apart by id and fingerprint, so ids that several documents share lose none and keep no copy.
    """
    return one_of_each(df, cluster(df, threshold=threshold), "fp", lambda d, name: fingerprints(d, out=name))


def hex_of(fp):
    """A bigint column as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
