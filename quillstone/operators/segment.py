"""Chunks and structural units of long texts, with exact offsets in code points.

Both work on one text at a time in a pandas-free Arrow map, in time linear in the text, and return every character of
it in some unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stride_chunks(df: DataFrame, key: str, text: str = "text", size: int = 1200, overlap: int = 200, least: int = 80) -> DataFrame:
    """(key, ord, start, chunk): windows of `size` characters that overlap; those under `least` are dropped."""
    step = size - overlap
    n = F.length(text)
    starts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil((n - overlap) / step), F.lit(1)).cast("int") - 1), lambda i: i * step)
    out = df.filter(F.col(text).isNotNull()).select(key, text, F.posexplode(starts).alias("ord", "start"))
    out = out.select(key, "ord", "start", F.substring(F.col(text), F.col("start") + 1, F.lit(size)).alias("chunk"))
    return out.filter(F.length("chunk") >= least)


def paragraph_chunks(df: DataFrame, key: str, text: str = "text", size: int = 1200, overlap: int = 200, least: int = 80) -> DataFrame:
    """(key, ord, start, chunk): paragraphs put together up to `size` characters, each chunk led in by the last one's end.

    Paragraphs stand between blank lines. One longer than `size` is cut for itself, in windows that overlap. start is where
    a chunk's own text begins in the text, its lead included. A fold over the paragraphs, so a text is read once.
    """
    step = size - overlap
    part = "struct<start:int,chunk:string>"
    own_text = F.coalesce(F.col(text), F.lit(""))
    parts, gaps = F.split(own_text, r"\n\s*\n", -1), F.regexp_extract_all(own_text, F.lit(r"\n\s*\n"), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("held"), F.lit(0).alias("from"), F.array().cast(f"array<{part}>").alias("out"))

    def one(at: Column, chunk: Column) -> Column:
        return F.array(F.struct(at.cast("int").alias("start"), chunk.alias("chunk")))

    def fold(s: Column, p: Column) -> Column:
        own, at = p["p"], s["at"]
        low = at + F.length(own) - F.length(F.regexp_replace(own, r"^\s+", ""))
        bare = F.regexp_replace(own, r"^\s+|\s+$", "")
        n, held = F.length(bare), F.length(s["held"])
        windows = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda i: F.struct((low + i).cast("int").alias("start"), F.substring(bare, i + 1, F.lit(size)).alias("chunk")))
        flushed = F.when(held > 0, F.concat(s["out"], one(s["from"], s["held"]))).otherwise(s["out"])
        lead = F.substring(s["held"], F.greatest(held - overlap + 1, F.lit(1)), F.lit(overlap))
        long_, full = n > size, (held > 0) & (held + n + 1 > size)
        next_at = (at + F.length(own) + F.coalesce(F.length(p["g"]), F.lit(0))).cast("int")
        held_next = F.when(n == 0, s["held"]).when(long_, "").when(full, F.concat(lead, F.lit("\n"), bare)).when(held > 0, F.concat(s["held"], F.lit("\n"), bare)).otherwise(bare)
        from_next = F.when((n == 0) | (~long_ & ~full & (held > 0)), s["from"]).when(full & ~long_, low - F.length(lead) - 1).otherwise(low)
        out_next = F.when(n == 0, s["out"]).when(long_, F.concat(flushed, windows)).when(full, flushed).otherwise(s["out"])
        return F.struct(next_at.alias("at"), held_next.alias("held"), F.greatest(from_next, F.lit(0)).cast("int").alias("from"), out_next.alias("out"))

    chunks = F.aggregate(F.arrays_zip(parts.alias("p"), gaps.alias("g")), start, fold, lambda s: F.when(F.length(s["held"]) > 0, F.concat(s["out"], one(s["from"], s["held"]))).otherwise(s["out"]))
    kept = df.filter(F.col(text).isNotNull()).select(key, F.filter(chunks, lambda c: F.length(F.trim(c["chunk"])) >= least).alias("c"))
    return kept.select(key, F.posexplode("c").alias("ord", "c")).select(key, "ord", "c.*")


#: Fixed patterns of the lines that begin a unit, by level: chapter, article, annex, heading, point.
MARKERS = (
    ("chapter", re.compile(r"^(?:chapter|section|розділ|глава)\s+([IVXLC]+|\d+)\b", re.IGNORECASE)),
    ("article", re.compile(r"^(?:article|стаття)\s+(\d+(?:[-.]\d+)*)", re.IGNORECASE)),
    ("annex", re.compile(r"^(?:annex|appendix|додаток)\s*(\d*)", re.IGNORECASE)),
    ("heading", re.compile(r"^(#{1,4})\s+\S")),
    ("point", re.compile(r"^(\d{1,3}(?:\.\d{1,3})*)[.)]\s+\S")),
)
LEVELS = {"chapter": 0, "annex": 0, "heading": 1, "article": 1, "point": 2}
#: A line of a table of contents: dots that lead to a page number.
CONTENTS = re.compile(r"\.{3,}\s*\d+\s*$")


#: How a numbered line is told from an item of a list: not at all; by a blank line before it; by going on with its
#: siblings' numbers; by both; or it stays, as a part of the point that it begins anew under.
RULES = ("union", "blank", "seq", "blank+seq", "nest")


def marks_of(text: str, rule: str = "union") -> list[tuple[int, str, int]]:
    """(start, label, level) of the lines that begin a unit, under a rule for numbered points."""
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule}")
    marks: list[tuple[int, str, int]] = []
    next_: dict[int, int] = {}  # by depth, the number that goes on with the points before
    at, blank, above = 0, True, ""
    for line in text.splitlines(keepends=True):
        bare = line.strip()
        found = None
        if bare and not CONTENTS.search(bare):
            found = next(((kind, m[1]) for kind, pattern in MARKERS if (m := pattern.match(bare))), None)
        if found and found[0] != "point":
            marks.append((at, f"{found[0]} {found[1]}".strip(), LEVELS[found[0]]))
            next_, above = {}, ""  # a container begins its numbers anew
        elif found:
            numbers = [int(n) for n in found[1].split(".")]
            depth, again = len(numbers), numbers[-1] == 1 and next_.get(len(numbers), 1) > 1
            keep = (blank or "blank" not in rule) and not (again and "seq" in rule)
            if keep:
                if again and rule == "nest":
                    above, next_ = marks[-1][1], {}
                label = f"point {found[1]}"
                marks.append((at, f"{above} / {label}" if above else label, LEVELS["point"]))
                next_ = {d: n for d, n in next_.items() if d < depth} | {depth: numbers[-1] + 1}
        blank = not bare
        at += len(line)
    return marks


def units_of(text: str, least: int = 80, most: int = 2000, overlap: int = 100, rule: str = "union") -> list[dict]:
    """The structural units of a text in order: label, base_label, parent_label, start, end, split.

    A unit begins at a marker line; what comes before the first is a preamble. A unit under `least` characters joins
    the one before it under the same parent; one over `most` is split at the best border, and the parts overlap.
    """
    marks = marks_of(text, rule)
    starts = ([(0, "preamble", 0)] if not marks or marks[0][0] > 0 else []) + marks
    units: list[dict] = []
    path: list[tuple[int, str]] = []
    for i, (start, label, level) in enumerate(starts):
        end = starts[i + 1][0] if i + 1 < len(starts) else len(text)
        path = [p for p in path if p[0] < level]
        parent = " / ".join(x for _, x in path) or None
        path.append((level, label))
        last = units[-1] if units else None
        if last and end - start < least and last["parent"] == parent and last["label"] != "preamble":
            last["end"] = end
            continue
        units.append({"label": label, "parent": parent, "start": start, "end": end})
    out = []
    for u in units:
        parts = _split(text, u["start"], u["end"], most, overlap)
        for k, (a, b) in enumerate(parts):
            name = f"{u['label']} ({k + 1})" if len(parts) > 1 else u["label"]
            out.append({"ord": len(out), "label": name, "base_label": u["label"], "parent_label": u["parent"], "char_start": a, "char_end": b, "from_length_split": len(parts) > 1, "unit": text[a:b]})
    return out


def _split(text: str, start: int, end: int, most: int, overlap: int) -> list[tuple[int, int]]:
    parts, at = [], start
    while end - at > most:
        window = text[at + most // 2 : at + most]
        cut = max(window.rfind("\n") + 1, window.rfind(". ") + 2 if ". " in window else 0) or window.rfind(" ") + 1
        stop = at + most // 2 + cut if cut else at + most
        parts.append((at, stop))
        at = max(stop - overlap, at + 1)
    parts.append((at, end))
    return parts


_UNIT = "ord int, label string, base_label string, parent_label string, char_start int, char_end int, from_length_split boolean, unit string"


def units(df: DataFrame, key: str, text: str = "text", rule: str = "union") -> DataFrame:
    """(key, unit columns): the structural units of each text under a rule; a null or empty text has none."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {_UNIT}"
    names = [p.split()[0] for p in _UNIT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            for at in range(0, batch.num_rows, 500):
                rows, source = [], []
                for i, x in enumerate(batch.column(text).slice(at, 500).to_pylist()):
                    found = units_of(x, rule=rule) if x else []
                    rows += found
                    source += [at + i] * len(found)
                types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
                columns = [pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(source, pa.int64())), *columns], names=[key, *names])

    return df.select(key, text).mapInArrow(run, schema)
