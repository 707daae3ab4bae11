"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie in one ragged numpy array of symbols. In each step every sequence applies its
own lowest-ranked pair, wherever it stands in it without overlap, all sequences at once; a sequence without a pair is
done and leaves the arrays. So a sequence takes a step for each pair that it merges, however often it does, and a long
pre-token halves with them. What survives is counted, so ids are never built. Words met before come from a bounded
memory.

The vocabulary file's own rules hold: its normaliser (NFC, white space, lower case), its pre-tokeniser, the byte
alphabet, the end-of-word suffix, and its added tokens, whose strings in a text count as one token each.

Nulls count as empty texts, which have 0 tokens. Texts of any length are counted whole; repeated rows give repeated
results. A column named like an added one is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, with_columns
from .pairs import NONE, PairTable, apart

BLOCK_WORDS = 250_000
MEMORY_WORDS = 500_000
BLOCK_BYTES = 6 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes stand for themselves, the rest follow from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(kept))
    return [chr(c) for _, c in sorted([(b, b) for b in kept] + [(b, 256 + i) for i, b in enumerate(rest)])]


class SynchronousCounter:
    """Counts with a tokenizers file of the kind described above."""

    def __init__(self, definition: bytes) -> None:
        spec = json.loads(definition)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]) for x in spec["added_tokens"])
        plain &= not any(c.isspace() for x in spec["added_tokens"] for c in x["content"])
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or level["use_regex"] or not plain:
            raise ValueError("this kind of tokenizers file isn't supported")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.space = regex.compile(r"\p{White_Space}+")
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.split_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int32)
        self.last = np.array([vocab.get(c + suffix, -1) for c in letters], np.int32)
        if (self.inner < 0).any() or (self.last < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, merged = (np.array(x, np.int32) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], strict=True))
        self.table = PairTable(left, right, np.arange(len(pairs), dtype=np.int32), merged)
        self.memory: dict[str, int] = {}

    def survivors(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each non-empty word keeps."""
        table = self.table
        length = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[data]
        ends = np.cumsum(length) - 1
        symbol[ends] = self.last[data[ends]]
        out = length.copy()
        at = np.arange(len(words))
        slot = np.full(len(symbol), -1, np.int64)
        open_ = np.ones(len(symbol), bool)
        open_[ends] = False
        where = np.flatnonzero(open_)
        slot[where] = table.find(symbol[where], symbol[where + 1])
        while len(at):
            rank = np.where(slot >= 0, table.rank[slot], NONE)
            start = np.cumsum(length) - length
            lowest = np.minimum.reduceat(rank, start)
            active = lowest != NONE
            if not active.all():
                keep = np.repeat(active, length)
                out[at[~active]] = length[~active]
                at, length, lowest = at[active], length[active], lowest[active]
                symbol, slot, rank = symbol[keep], slot[keep], rank[keep]
                if not len(at):
                    break
                start = np.cumsum(length) - length
            # each sequence's lowest pair wherever it stands, from the left and without overlap
            hits = np.flatnonzero(rank == np.repeat(lowest, length))
            owner = np.searchsorted(start, hits, side="right") - 1
            taken = apart(np.concatenate([[False], hits[1:] == hits[:-1] + 1]))
            taken[1:] &= (owner[1:] != owner[:-1]) | ~table.alone[table.merged[slot[hits[1:]]]]
            hits, owner = hits[taken], owner[taken]
            symbol[hits] = table.merged[slot[hits]]
            stays = np.ones(len(symbol), bool)
            stays[hits + 1] = False
            symbol, slot = symbol[stays], slot[stays]
            hits -= np.arange(len(hits))
            length -= np.bincount(owner, minlength=len(length))
            start = np.cumsum(length) - length
            stop = start + length - 1
            touched = np.concatenate([hits, hits[hits > start[owner]] - 1])
            final = np.concatenate([hits == stop[owner], np.zeros(len(touched) - len(hits), bool)])
            slot[touched[final]] = -1
            touched = touched[~final]
            slot[touched] = table.find(symbol[touched], symbol[touched + 1])
        return out

    def _pieces(self, word: str) -> tuple[int, list[str]]:
        """The added tokens in a word, and its pre-tokens."""
        count, parts = 0, [word]
        if self.split_added and self.split_added.search(word):
            parts = self.split_added.split(word)
            count = len(parts) - 1
        found = []
        for part in parts:
            found += self.pattern.findall(unicodedata.normalize("NFC", part).lower())
        return count, found

    def words(self, text: str) -> list[str]:
        if re.search("[\x1c-\x1f]", text):
            return [w for w in self.space.split(text) if w]
        return text.split()

    def counts(self, texts: list[str]) -> np.ndarray:
        own = [self.words(t) for t in texts]
        fresh = set(chain.from_iterable(own)).difference(self.memory)
        if len(self.memory) + len(fresh) > MEMORY_WORDS and self.memory:
            self.memory = {}
            fresh = set(chain.from_iterable(own))
        fresh = list(fresh)
        for a in range(0, len(fresh), BLOCK_WORDS):
            block = fresh[a : a + BLOCK_WORDS]
            added, parts = zip(*map(self._pieces, block), strict=True)
            tokens = list(set(chain.from_iterable(parts)))
            place = dict(zip(tokens, range(len(tokens)), strict=True))
            kept = self.survivors([t.encode("utf-8", "surrogatepass") for t in tokens]) if tokens else np.zeros(0, np.int64)
            n_parts = np.fromiter(map(len, parts), np.int64, len(parts))
            at = np.fromiter(map(place.__getitem__, chain.from_iterable(parts)), np.int64, int(n_parts.sum()))
            ends = np.concatenate([[0], np.cumsum(kept[at])])
            last = np.cumsum(n_parts)
            total = ends[last] - ends[last - n_parts] + np.array(added, np.int64)
            self.memory.update(zip(block, total.tolist(), strict=True))
        known = self.memory.__getitem__
        return np.fromiter((sum(map(known, w)) for w in own), np.int64, len(own))


_COUNTERS: dict[int, SynchronousCounter] = {}


def counter_for(definition: bytes) -> SynchronousCounter:
    key = hash(definition)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = SynchronousCounter(definition)
    return _COUNTERS[key]


def count_tokens(df: DataFrame, definition_path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)."""
    with open(definition_path, "rb") as f:  # a public vocabulary of about 2 MB, read once by the driver
        definition = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(definition.value)
        for batch in slices(batches, text, BLOCK_BYTES):
            counts = counter.counts([x or "" for x in batch.column(text).to_pylist()])
            yield with_columns(batch, ["n_tokens"], [pa.array(counts, pa.int64())])

    schema = T.StructType([f for f in df.schema.fields if f.name.lower() != "n_tokens"] + [T.StructField("n_tokens", T.LongType())])
    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    return df.mapInArrow(run, schema).withColumns({"n_bytes": n_bytes, "over_limit": F.col("n_tokens") > limit})
