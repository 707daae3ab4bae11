"""Media columns with content-defined payload chunking.

A payload is stored as the 8-bit samples of a WAV file. A rolling gear hash over the file's bytes cuts it into chunks:
a cut lies where the hash of the last 16 bytes has its mask bits clear, between the least and the most size. A chunk's
digest names it. A first, narrow pass counts digests with a grouped aggregation; those that occur twice or more set
bits in a Bloom filter, 16 bits for each of them up to a bound. In the second pass a chunk that the filter doesn't know is unique and stays in
its document's row; any other goes to the shared chunks, which are made distinct by digest. A document's row is its
manifest: the ordered digests of its chunks. To read media back, manifests join the shared chunks by digest; equal
media are read once and joined with their copies. Every reassembled file is checked against its stored digest, and all
that is returned is computed from the bytes read back.

So only chunks that may repeat are shuffled, a copy costs a manifest, and a full filter only means more shuffling,
never a wrong result. A null text counts as an empty one, which is padded to 192 spaces like any other. Texts of any
length are stored whole; repeated rows give repeated results. No rows give no rows. Extra columns are not stored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shared_dir, slices, written

UNIT = 192
RATE = 8000
LEAST, MOST = 512, 16384
#: A cut where these bits of the 16-bit gear hash are clear: once in 2,048 bytes.
MASK = 0x7FF0
#: The least and the most bits of the filter: 8 KiB and 128 MiB. A filter over its bound knows more chunks than repeat.
FILTER_LEAST, FILTER_MOST = 1 << 16, 1 << 30
LEVEL = 6

_state = 0x2545F4914F6CDD1D
_gear = []
for _ in range(256):  # xorshift
    _state ^= _state << 13 & (1 << 64) - 1
    _state ^= _state >> 7
    _state ^= _state << 17 & (1 << 64) - 1
    _gear.append(_state & 0xFFFF)
GEAR = np.array(_gear, np.uint16)


def payload_of(text: str | None) -> tuple[bytes, int]:
    """The text's UTF-8 bytes padded with spaces to a positive multiple of UNIT, and their number before that."""
    data = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, -(-len(data) // UNIT)) * UNIT
    return data.ljust(size, b" "), len(data)


def wav_of(payload: bytes) -> bytes:
    """The payload as the samples of a mono WAV file of 8 bits a sample."""
    n = len(payload)
    return b"RIFF" + struct.pack("<I", 36 + n) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", n) + payload


def samples_of(wav: bytes) -> bytes:
    """The samples of such a file."""
    (n,) = struct.unpack_from("<I", wav, 40)
    if wav[:4] != b"RIFF" or wav[36:40] != b"data" or len(wav) != 44 + n:
        raise ValueError("no such WAV file")
    return wav[44:]


def cuts_of(data: bytes) -> list[int]:
    """The ends of the chunks."""
    g = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < 16:  # the hash of the last 2 * width bytes, from those of width bytes
        g[width:] = g[width:] + (g[:-width] << np.uint16(width)) if width < len(g) else g[width:]
        width *= 2
    marks = (np.flatnonzero((g & np.uint16(MASK)) == 0) + 1).tolist()
    out, at, n, i = [], 0, len(data), 0
    while n - at > LEAST:
        while i < len(marks) and marks[i] < at + LEAST:
            i += 1
        cut = marks[i] if i < len(marks) and marks[i] <= at + MOST else at + MOST
        if cut >= n:
            break
        out.append(cut)
        at = cut
    return [*out, n]


def chunks_of(data: bytes) -> list[bytes]:
    at, out = 0, []
    for end in cuts_of(data):
        out.append(data[at:end])
        at = end
    return out


def digest_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def features_of(wav: bytes) -> dict:
    """What op6 returns of one stored file."""
    payload = samples_of(wav)
    samples = np.frombuffer(payload, np.uint8).astype(np.int64)
    centred = samples - 128
    crossings = int(np.count_nonzero((centred[1:] < 0) != (centred[:-1] < 0)))
    bins = np.bincount(samples >> 5, minlength=8)
    feature = f"n={len(samples)};sum={int(samples.sum())};energy={int((centred * centred).sum())};crossings={crossings};bins={'/'.join(map(str, bins.tolist()))}"
    return {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-16:]), "media_bytes": len(wav), "feature": feature}


_FEATURES = "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, feature string"
_FEATURE_TYPES = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "feature": pa.string()}


def filter_places(digests: np.ndarray, bits: int) -> np.ndarray:
    """The bits (three columns) of a filter of so many bits for digests, rows of two unsigned 64-bit numbers."""
    a, b = digests[:, 0], digests[:, 1]
    return np.stack([(a + np.uint64(k) * b) % np.uint64(bits) for k in range(3)], axis=1)


def _count_digests(df: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            digests = [digest_of(c) for x in batch.column(text).to_pylist() for c in chunks_of(wav_of(payload_of(x)[0]))]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary())], names=["digest"])

    return df.select(text).mapInArrow(run, "digest binary").groupBy("digest").agg(F.count("*").alias("n"))


def repeat_filter(df: DataFrame, text: str = "text") -> np.ndarray:
    """The Bloom filter of the digests that occur twice or more, as bytes; sized by their counted number."""
    repeated = written(_count_digests(df, text).filter("n > 1").select("digest"), "repeated")
    size = max(FILTER_LEAST, min(FILTER_MOST, 1 << (16 * repeated.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(-1, 2)
            places = np.unique(filter_places(raw, size).ravel()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array((np.int64(1) << (places & 63)))], names=["word", "bits"])

    words = repeated.mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(size // 64, np.int64)
    for part in words.toArrow().to_batches():  # at most size / 64 rows
        out[part.column("word").to_numpy()] = part.column("bits").to_numpy()
    discard(repeated)
    return out.view(np.uint8)


class MediaStore:
    """A written store of media: manifests with their unique chunks, and the shared chunks by digest."""

    def __init__(self, manifests: DataFrame, chunks: DataFrame) -> None:
        #: doc_id, row, n_bytes, media_sha256, digests, blobs (null where the chunk is shared)
        self.manifests = manifests
        #: digest, blob
        self.chunks = chunks

    @staticmethod
    def write(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> MediaStore:
        docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        spark = df.sparkSession
        known = spark.sparkContext.broadcast(repeat_filter(docs))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            squeeze = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=False).compress
            sent: set[bytes] = set()
            for batch in slices(batches, "text"):
                rows: list[tuple] = []
                wavs, n_bytes = [], []
                for x in batch.column("text").to_pylist():
                    payload, n = payload_of(x)
                    wavs.append(wav_of(payload))
                    n_bytes.append(n)
                parts = [chunks_of(w) for w in wavs]
                digests = [[digest_of(c) for c in own] for own in parts]
                raw = np.frombuffer(b"".join(d for own in digests for d in own), "<u8").reshape(-1, 2)
                places = filter_places(raw, 8 * len(known.value))
                hit = ((known.value[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1).tolist()
                k, shared = 0, []
                for i, row, wav, own, names in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), wavs, parts, digests, strict=True):
                    blobs = []
                    for chunk, name in zip(own, names, strict=True):
                        blobs.append(None if hit[k] else squeeze(chunk))
                        if hit[k] and name not in sent:
                            if len(sent) > 200_000:
                                sent.clear()
                            sent.add(name)
                            shared.append((name, squeeze(chunk)))
                        k += 1
                    rows.append((i, row, hashlib.sha256(wav).hexdigest(), names, blobs))
                none = [None] * len(shared)
                ids, at, shas, names, blobs = (list(c) for c in zip(*rows, strict=True))
                columns = [
                    pa.array(["manifest"] * len(rows) + ["chunk"] * len(shared)), pa.array(ids + none, pa.int64()), pa.array(at + none, pa.int64()), pa.array(n_bytes + none, pa.int64()), pa.array(shas + none, pa.string()),
                    pa.array(names + [[d] for d, _ in shared], pa.list_(pa.binary())), pa.array(blobs + [[b] for _, b in shared], pa.list_(pa.binary())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "doc_id", "row", "n_bytes", "media_sha256", "digests", "blobs"])

        schema = "kind string, doc_id bigint, row bigint, n_bytes bigint, media_sha256 string, digests array<binary>, blobs array<binary>"
        raw = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema)
        path = f"{shared_dir(spark)}/quillstone/media-{uuid.uuid4().hex}"
        raw.write.partitionBy("kind").option("compression", "none").parquet(path)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
        store = spark.read.schema(schema.replace("kind string, ", "") + ", kind string").parquet(path)
        shared = store.filter("kind = 'chunk'").select(F.col("digests")[0].alias("digest"), F.col("blobs")[0].alias("blob"))
        return MediaStore(store.filter("kind = 'manifest'").drop("kind"), written(shared.groupBy("digest").agg(F.min("blob").alias("blob")), "chunks"))

    def _whole(self) -> tuple[DataFrame, DataFrame]:
        """Media of whose chunks all or some are in their own rows, and distinct media all of whose chunks are shared."""
        own = F.exists("blobs", lambda b: b.isNotNull())
        return self.manifests.filter(own), self.manifests.filter(~own)

    def read(self) -> DataFrame:
        """(doc_id, n_bytes, features..., media_sha256) for each stored row, from the bytes read back."""
        some, none = self._whole()
        missing = F.exists("blobs", lambda b: b.isNull())
        direct = _reassembled(some.filter(~missing).select("doc_id", "n_bytes", "media_sha256", "digests", "blobs"), keep="doc_id bigint, n_bytes bigint, ")
        lone = none.groupBy("media_sha256").agg(F.min("row").alias("row"))
        of_lone = none.select("row", "digests").join(lone, "row")
        gaps = some.filter(missing).select("row", "digests", "blobs", "media_sha256")
        wanted = of_lone.select("row", "media_sha256", "digests", F.array().cast("array<binary>").alias("blobs")).unionByName(gaps)
        refs = wanted.select("row", F.posexplode(F.transform("digests", lambda d, i: F.struct(d.alias("digest"), F.get("blobs", i).isNull().alias("gone")))).alias("i", "c"))
        refs = refs.filter("c.gone").select("row", "i", F.col("c.digest").alias("digest"))
        found = refs.join(self.chunks, "digest").groupBy("row").agg(F.collect_list(F.struct("i", "blob")).alias("more"))
        full = wanted.join(found, "row")
        place = F.map_from_entries("more")
        full = full.select("media_sha256", "digests", F.transform("digests", lambda d, i: F.coalesce(F.get("blobs", i), place[i])).alias("blobs"))
        fetched = _reassembled(full, keep="")
        copies = some.filter(missing).unionByName(none).select("doc_id", "n_bytes", "media_sha256")
        names = ["doc_id", "n_bytes", *_FEATURE_TYPES, "media_sha256"]
        return direct.select(names).unionByName(copies.join(fetched, "media_sha256").select(names))


def _reassembled(df: DataFrame, keep: str) -> DataFrame:
    """Puts the chunks together in order, checks each chunk's digest and the whole, and adds the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "blobs"):
            rows = []
            for sha, names, blobs in zip(*(batch.column(c).to_pylist() for c in ("media_sha256", "digests", "blobs")), strict=True):
                chunks = [expand(b) for b in blobs]
                wav = b"".join(chunks)
                if [digest_of(c) for c in chunks] != names or hashlib.sha256(wav).hexdigest() != sha:
                    raise ValueError(f"stored media {sha} can't be reconstructed")
                rows.append(features_of(wav))
            kept = [n for n in batch.schema.names if n not in ("digests", "blobs")]
            columns = [batch.column(n) for n in kept] + [pa.array([r[n] for r in rows], t) for n, t in _FEATURE_TYPES.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *_FEATURE_TYPES])

    return df.mapInArrow(run, f"{keep}media_sha256 string, {_FEATURES}")
