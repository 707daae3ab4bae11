"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task gathers the distinct pre-tokens of a block of texts, lays them out as one array of symbols and keeps an
inverted index from the rank of a pair, by narrow bands of ranks, to the positions where such pairs stand. It then goes
through the bands in rank order, applies to each word there its lowest rank wherever it stands without overlap, all words
at once, and looks again only at the two neighbours of what it has merged; a band is left when none of its pairs is. So
each word gets what merging its lowest-ranked pair again and again gives, and a long word takes work by its length and
the pairs that it merges. A block holds a bounded number of distinct words; words met before come from a bounded memory.
Blocks don't depend on one another, so nothing is shuffled and a lost task is simply run again.

A pre-token that is a token as a whole is that token, as in the library; no merges are replayed for it. With the pattern
WORDS, texts are cut at spaces first, as its pre-tokens are; with any other pattern, the pattern alone cuts them.

Nulls count as empty texts and give no ids. Empty texts give an empty list. Texts of any length are encoded whole;
repeated rows give repeated results. A column named like an added one is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import release_memory, slices, thrifty, with_columns
from .pairs import NONE, PairTable, apart

#: Distinct new words that a block replays together, and words that a task remembers.
BLOCK_WORDS = 100_000
MEMORY_WORDS = 300_000
BLOCK_BYTES = 5 << 20
#: The inverted index has a list of positions for each band of 2 ** BAND ranks.
BAND = 5

#: Fixed value: the public pattern for which texts may be cut at spaces.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARKS = frozenset(".,;:!?")
#: A space between or after other white space. Elsewhere each space begins a pre-token, whatever surrounds it, so a text
#: may be cut before its spaces.
ODD = r"[\s\x1c-\x1f\x{85}\p{Z}] (?:[\s\x1c-\x1f\x{85}\p{Z}]|\z)"


class ReplayEncoder:
    """Encodes with the ranks of a vocabulary file as lines of base64 token and rank."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        pairs = [line.split() for line in vocabulary.splitlines() if line]
        self.rank_of = {base64.b64decode(a): int(b) for a, b in pairs}
        self.token_of = {b: a for a, b in self.rank_of.items()}
        self.pattern = regex.compile(pattern)
        self.usual = pattern == WORDS
        self.byte_rank = np.array([self.rank_of.get(bytes([b]), -1) for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in self.rank_of.items():
            for i in range(1, len(token)):
                a, b = self.rank_of.get(token[:i]), self.rank_of.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        merged = np.array(merged, np.int32)
        self.table = PairTable(np.array(left), np.array(right), merged, merged)
        self._forget()

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, end to end, and how many each has."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.byte_rank[np.frombuffer(b"".join(words), np.uint8)]
        n = len(symbol)
        if (symbol < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        word = np.repeat(np.arange(len(words), dtype=np.int32), length)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        if n:
            ends = np.cumsum(length) - 1
            after[ends] = -1
            before[(ends - length + 1)[length > 0]] = -1
        alive = np.ones(n, bool)
        pair = np.full(n, NONE, np.int32)
        at = np.flatnonzero(after >= 0)
        pair[at] = self.table.ranks(symbol[at], symbol[at + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(positions: np.ndarray) -> None:
            bands = pair[positions] >> BAND
            order = np.argsort(bands, kind="stable")
            positions, bands = positions[order], bands[order]
            stop = int(np.searchsorted(bands, NONE >> BAND))
            if not stop:
                return
            starts = np.flatnonzero(np.concatenate([[True], bands[1:stop] != bands[: stop - 1]])).tolist()
            for a, b, band in zip(starts, [*starts[1:], stop], bands[starts].tolist(), strict=True):
                have = index.get(band)
                if have is None:
                    index[band] = [positions[a:b]]
                    heapq.heappush(heap, band)
                else:
                    have.append(positions[a:b])

        note(at)
        while heap:
            band = heapq.heappop(heap)
            where = np.concatenate(index.pop(band))
            where = where[alive[where] & (pair[where] >> BAND == band)]
            if not len(where):
                continue
            # of each word its lowest rank, from the left and without overlap; the merge may open other ranks of the band
            where = where[np.lexsort((where, pair[where], word[where]))]
            where = where[np.concatenate([[True], where[1:] != where[:-1]])]
            first = np.ones(len(where), bool)
            first[1:] = word[where[1:]] != word[where[:-1]]
            lowest = pair[where][np.maximum.accumulate(np.where(first, np.arange(len(where)), 0))]
            taken = pair[where] == lowest
            own = np.flatnonzero(taken)
            taken[own] = apart(np.concatenate([[False], after[where[own[:-1]]] == where[own[1:]]]))
            maybe = np.flatnonzero(taken & self.table.alone[lowest])
            if len(maybe):  # no further than to the first merge of a word that opens a pair of a lower rank
                here, made = where[maybe], lowest[maybe]
                behind, ahead = before[here], after[after[here]]
                next_ = np.concatenate([[False], behind[1:] == after[here[:-1]]])
                opened = (behind >= 0) & (self.table.ranks(np.where(next_, made, symbol[behind]), made) < made)
                opened |= (ahead >= 0) & (self.table.ranks(made, symbol[ahead]) < made)
                upto = np.cumsum(opened) - opened
                start = np.concatenate([[True], word[here[1:]] != word[here[:-1]]])
                taken[maybe] = upto == np.maximum.accumulate(np.where(start, upto, 0))
            if not taken.all():
                index[band] = [where[~taken]]
                heapq.heappush(heap, band)
                where = where[taken]
            gone = after[where]
            symbol[where] = pair[where]
            alive[gone] = False
            further = after[gone]
            after[where] = further
            inner = further >= 0
            before[further[inner]] = where[inner]
            pair[where] = NONE
            left = before[where]
            left = left[left >= 0]
            right = where[inner]
            pair[right] = self.table.ranks(symbol[right], symbol[after[right]])
            pair[left] = self.table.ranks(symbol[left], symbol[after[left]])
            note(np.concatenate([left, right]))
        counts = np.bincount(word[alive], minlength=len(words)) if n else np.zeros(len(words), np.int64)
        return symbol[alive], counts

    def _chunks(self, text: str) -> list[str]:
        """The pre-tokens of a text of which single spaces don't tell where pre-tokens begin."""
        return self.pattern.findall(text)

    def _learn(self, chunks: list[str]) -> None:
        """Replays the merges over the distinct words of new chunks and remembers the chunks' ids."""
        find = self.pattern.findall
        if self.usual:  # A-Z letters, maybe with one mark behind: most pieces, and no work for the pattern
            parts = [find(c) if not c.isascii() else (c,) if c[1:].isalpha() and (c[0] == " " or c[0].isalpha()) else (c[:-1], c[-1]) if c[-1:] in MARKS and c[1:-1].isalpha() and (c[0] == " " or c[0].isalpha()) else find(c) for c in chunks]
        else:
            parts = [find(c) for c in chunks]
        words = list(set(chain.from_iterable(parts)))
        place = dict(zip(words, range(len(words)), strict=True))
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        whole = np.fromiter((self.rank_of.get(b, -1) for b in coded), np.int32, len(coded))
        other = np.flatnonzero(whole < 0)
        ids, counts = self.replay([coded[i] for i in other.tolist()])
        start, length = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        start[other], length[other] = np.cumsum(counts) - counts, counts
        direct = np.flatnonzero(whole >= 0)
        start[direct] = len(ids) + np.arange(len(direct))
        ids = np.concatenate([ids, whole[direct]])
        n_parts = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(parts)), np.int64, int(n_parts.sum()))
        flat = _gather(ids, start[at], length[at])
        ends = np.concatenate([[0], np.cumsum(length[at])])
        last = np.cumsum(n_parts)
        first = last - n_parts
        n = len(self.memory)
        self.memory.update(zip(chunks, range(n, n + len(chunks)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + ends[first]])
        self.length = np.concatenate([self.length, ends[last] - ends[first]])
        self.flat = np.concatenate([self.flat, flat])

    def _forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.start, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _keep(self, chunks: set[str]) -> None:
        """Forgets all but these."""
        kept = list(chunks)
        at = np.fromiter(map(self.memory.__getitem__, kept), np.int64, len(kept))
        length = self.length[at]
        self.flat, self.start, self.length = _gather(self.flat, self.start[at], length), np.cumsum(length) - length, length
        self.memory = dict(zip(kept, range(len(kept)), strict=True))

    def learn(self, chunks: set[str]) -> None:
        """Makes sure that all these chunks are in the memory, which keeps only them when it would grow too large."""
        fresh = chunks.difference(self.memory)
        if len(self.memory) + len(fresh) > MEMORY_WORDS and self.memory and fresh:
            self._keep(chunks - fresh)
        fresh = list(fresh)
        for at in range(0, len(fresh), BLOCK_WORDS):
            self._learn(fresh[at : at + BLOCK_WORDS])
            release_memory()  # a block's arrays are freed by now, and take more than all that is remembered

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Encodes a column of texts: (first row, rows, ids end to end, borders of the rows) for runs of rows.

        Arrow splits the texts at spaces and finds the distinct pieces; Python only sees those.
        """
        texts = pc.fill_null(column, "")
        odd = pc.match_substring_regex(texts, ODD) if self.usual else pa.array([True] * len(texts), pa.bool_())
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        borders = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.values.dictionary_encode()
        place = pieces.indices.to_numpy()
        spaced = [" " + x for x in pieces.dictionary.to_pylist()]
        first = lists.values.take(pa.array(borders[:-1])).to_pylist()  # of each row; it has no space before it
        other = {i: self._chunks(texts[i].as_py()) for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()}
        self.learn(set(chain(spaced, first, *other.values())))
        known = self.memory.__getitem__
        slot = np.fromiter(map(known, spaced), np.int64, len(spaced))[place]
        slot[borders[:-1]] = np.fromiter(map(known, first), np.int64, len(first))
        if other:
            rows = np.split(slot, borders[1:-1])
            for i, own in other.items():
                rows[i] = np.fromiter(map(known, own), np.int64, len(own))
            slot = np.concatenate(rows)
            borders = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        n, at = len(first), 0
        while at < n:  # runs of about a million pieces
            to = max(at + 1, int(np.searchsorted(borders, borders[at] + 1_000_000, side="right")) - 1)
            own = slot[borders[at] : borders[to]]
            length = self.length[own]
            ends = np.concatenate([[0], np.cumsum(length)])[borders[at : to + 1] - borders[at]]
            yield at, to - at, _gather(self.flat, self.start[own], length), ends
            at = to

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        for _, _, ids, ends in self.encode_column(pa.array(texts, pa.string())):
            out += np.split(ids, ends[1:-1])
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start:start + length] of each, end to end."""
    before = np.cumsum(length) - length
    return flat[np.repeat(start - before, length) + np.arange(int(length.sum()))]


_ENCODERS: dict[tuple[int, str], ReplayEncoder] = {}


def encoder_for(vocabulary: bytes, pattern: str) -> ReplayEncoder:
    """One encoder a worker and vocabulary."""
    key = hash(vocabulary), pattern
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ReplayEncoder(vocabulary, pattern)
    return _ENCODERS[key]


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:  # a public vocabulary of about 1 MB, read once by the driver
        return df.sparkSession.sparkContext.broadcast(f.read())


def _schema(df: DataFrame, *fields: T.StructField) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in names}] + list(fields))


def _encoded(batches: Iterator[pa.RecordBatch], encoder: ReplayEncoder, text: str, ids: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text, BLOCK_BYTES):
        for at, n, coded, ends in encoder.encode_column(batch.column(text)):
            yield with_columns(batch.slice(at, n), [ids], [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(coded, pa.int32()))])


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a column, empty for null."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    for a, b, there in zip(ends[:-1].tolist(), ends[1:].tolist(), column.is_valid().to_pylist(), strict=True):
        yield values[a:b].tolist() if there else []


def _digested(batches: Iterator[pa.RecordBatch], encoder: ReplayEncoder, ids: str) -> Iterator[pa.RecordBatch]:
    names = {i: str(i) for i in encoder.token_of}
    for batch in slices(batches, ids, BLOCK_BYTES):
        counts, coded, decoded = [], [], []
        for own in _lists(batch.column(ids)):
            counts.append(len(own))
            coded.append(hashlib.sha256(",".join(map(names.__getitem__, own)).encode()).hexdigest())
            decoded.append(hashlib.sha256(encoder.decode(own)).hexdigest())
        yield with_columns(batch, ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())])


_IDS = T.ArrayType(T.IntegerType(), False)
_DIGESTS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]


def encode(df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the column ids (array of int) with the tokens of the whole text."""
    vocabulary = _vocabulary(df, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, encoder_for(vocabulary.value, pattern), text, ids)

    return df.mapInArrow(thrifty(run), _schema(df, T.StructField(ids, _IDS)))


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Adds the column data (binary) with the bytes that the ids stand for; null ids give no bytes."""
    vocabulary = _vocabulary(df, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary.value, ".")
        for batch in slices(batches, ids, BLOCK_BYTES):
            yield with_columns(batch, [data], [pa.array(map(encoder.decode, _lists(batch.column(ids))), pa.binary())])

    return df.mapInArrow(thrifty(run), _schema(df, T.StructField(data, T.BinaryType())))


def round_trip(df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", ids: str | None = None) -> DataFrame:
    """Encodes the text and decodes the ids in one pass, and drops the text.

    Adds n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded bytes) and, if
    named, the ids.
    """
    vocabulary = _vocabulary(df, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary.value, pattern)
        for batch in _digested(_encoded(batches, encoder, text, ids or "_ids"), encoder, ids or "_ids"):
            gone = (text,) if ids else (text, "_ids")
            yield batch.select([n for n in batch.schema.names if n not in gone])

    kept = T.StructType([f for f in df.schema.fields if f.name != text])
    more = [T.StructField(ids, _IDS)] if ids else []
    names = {f.name for f in more + _DIGESTS}
    return df.mapInArrow(thrifty(run), T.StructType([f for f in kept.fields if f.name.lower() not in {n.lower() for n in names}] + more + _DIGESTS))
