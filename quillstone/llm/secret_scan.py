"""Secret scans: sliding-window Shannon entropy for each character class, with allow-list suppression.

Base secrets are matches of three patterns. Beside them, candidate strings are runs of 20 or more characters of the
base64 alphabet. There are two character classes, and for each a window of WINDOW characters slides over the class's own
runs in a candidate: hexadecimal digits, and letters and digits in general, whose run is the whole candidate. A window
keeps the count of each character, in five bits each of a few long numbers: a step takes one from the count of the
character that leaves and adds one to that of the one that enters, and the window's sum of c * log2(c) follows by those
two differences. The entropy is log2(WINDOW) less that sum over WINDOW. Fixed-point values keep it exact. A candidate is
a secret if its greatest window entropy of a class reaches the class's threshold, it mixes digits with letters, and the
allow-list doesn't know it: placeholders, universally unique ids, and paths, slugs and names made of words and short
numbers. Runs such as 123456 are taken out before the windows slide; they excuse nothing else. A candidate that base
spans cover whole is theirs; one that they cover in part is scanned like any other.

Everything on the path is a DataFrame function on one row: nothing is shuffled, so no key can be hot. Offsets are code
points, end exclusive. A null text counts as empty and has no spans. Texts of any length are scanned whole; repeated
rows give repeated results, and no rows none. Extra columns pass through; one named like an added column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

# Fixed patterns of the base kinds, in their order.
KEYWORD = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN_HEAD = KEYWORD + r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + r"([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
HEX_RUN = r"[0-9a-fA-F]{20,}"
WINDOW = 20
UNIT = 1 << 20
#: c * log2(c) in units of 1 / UNIT for c from 0 to WINDOW.
C_LOG_C = [round(c * math.log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1)]
#: The least bits a character in some window, for each class.
HEX_BITS, MIXED_BITS = 3.0, 3.6
#: Candidates that hold one of these (lower case) or have one of these forms are no secrets.
ALLOWED_WORDS = ("example", "placeholder", "changeme", "your_", "your-", "xxxxxx")
ALLOWED_FORMS = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # a universally unique id
    r"^[0-9+/=_-]*$",  # no letters
    r"^[A-Za-z+/=_-]*$",  # no digits
)
#: A path, slug or name: all that stands between its separators are words and short numbers, each of bounded length.
SEPARATORS, WORD_FORM, WORD_MOST = "[+/=_-]+", "^([a-z]*([A-Z][a-z]+)*[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]{1,8})$", 40
#: Taken out of a candidate before its windows slide.
KEYBOARD_RUNS = "(?i)abcdef|012345|123456|qwerty"
#: The characters of candidates; a window's counts lie in COUNTERS numbers of 12 counts of 5 bits.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
PER_COUNTER = 12
COUNTERS = -(-len(ALPHABET) // PER_COUNTER)

_SPANS = "array<struct<start:int,kind:int,end:int>>"
#: Lists grow by blocks of so many items, so that a text with many matches takes linear work.
BLOCK = 256


def _gathered(items: Column, kind: str, start: dict[str, Column], step, end=None) -> Column:
    """A fold over items that gathers a list of values of a type: step(state, item) gives (state fields, value, whether to keep it).

    end(state), if given, is one more value for the list.
    """

    def fold(state: Column, item: Column) -> Column:
        fields, value, keep = step(state, item)
        full = F.size(state["block"]) >= BLOCK
        done = F.when(keep & full, F.concat(state["done"], F.array(state["block"]))).otherwise(state["done"])
        block = F.when(keep & full, F.array(value)).when(keep, F.concat(state["block"], F.array(value))).otherwise(state["block"])
        return F.struct(*[c.alias(n) for n, c in fields.items()], done.alias("done"), block.alias("block"))

    none = F.array().cast(f"array<{kind}>")
    first = F.struct(*[c.alias(n) for n, c in start.items()], F.array().cast(f"array<array<{kind}>>").alias("done"), none.alias("block"))
    last = (lambda s: F.array(s["block"])) if end is None else (lambda s: F.array(s["block"], F.array(end(s))))
    return F.aggregate(items, first, fold, lambda s: F.flatten(F.concat(s["done"], last(s))))


def _hits(text: Column, pattern: str, kind: int, group_head: str | None = None, least: int = 0) -> Column:
    """The matches of a pattern, left to right and non-overlapping, as structs (start, kind, end, hit).

    What lies between the matches comes from split, the matches from regexp_extract_all; both step through the text
    alike, so their lengths add up to the offsets. With group_head, what follows it must have at least `least`
    characters.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.transform(gaps, F.length).alias("g"), hits.alias("h"))
    span = "struct<start:int,kind:int,end:int,hit:string>"

    def step(state: Column, x: Column):
        at = state["at"] + x["g"]
        end = at + F.length(x["h"])
        good = x["h"].isNotNull()
        if group_head:
            good &= F.length(F.regexp_replace(x["h"], "^" + group_head, "")) >= least
        value = F.struct(at.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"), x["h"].alias("hit"))
        return {"at": F.coalesce(end, at).cast("int")}, value, good

    return F.when(text.rlike(pattern), _gathered(both, span, {"at": F.lit(0)}, step)).otherwise(F.array().cast(f"array<{span}>"))


def _bare(hits: Column) -> Column:
    return F.transform(hits, lambda h: F.struct(h["start"], h["kind"], h["end"]))


def best_window(run: Column) -> Column:
    """The least sum of c * log2(c), in units of 1 / UNIT, of any window of a run of characters of ALPHABET."""
    rises = F.array(*[F.lit(y - x) for x, y in zip(C_LOG_C, C_LOG_C[1:], strict=False)], F.lit(0))
    units = F.array(*[F.lit(1 << 5 * i).cast("long") for i in range(PER_COUNTER)])
    enters = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    leaves = F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), enters), 1, F.greatest(F.size(enters), F.lit(0)))
    both = F.zip_with(enters, leaves, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def unit(i: Column) -> Column:
        return F.get(units, i % PER_COUNTER)

    def counter(i: Column) -> Column:
        return F.floor(i / PER_COUNTER).cast("int")

    def count(numbers: Column, i: Column) -> Column:
        return F.call_function("div", F.get(numbers, counter(i)), unit(i)).cast("long").bitwiseAND(F.lit(31)).cast("int")

    def added(numbers: Column, i: Column, n: int) -> Column:
        return F.transform(numbers, lambda x, k: F.when(k == counter(i), x + n * unit(i)).otherwise(x))

    def step(state: Column, char: Column) -> Column:
        full = char["b"] >= 0
        # one element arrays give the intermediate state a name, so that it is computed once
        left = F.transform(F.array(F.struct(state["counts"].alias("counts"), state["total"].alias("total"))), lambda s: F.when(full, F.struct(added(s["counts"], char["b"], -1).alias("counts"), (s["total"] - F.get(rises, count(s["counts"], char["b"]) - 1)).alias("total"))).otherwise(s))
        here = F.transform(left, lambda s: F.struct(added(s["counts"], char["a"], 1).alias("counts"), (s["total"] + F.get(rises, count(s["counts"], char["a"]))).alias("total")))
        seen = state["seen"] + 1
        return F.transform(here, lambda s: F.struct(s["counts"].alias("counts"), s["total"].alias("total"), seen.alias("seen"), F.when(seen >= WINDOW, F.least(state["best"], s["total"])).otherwise(state["best"]).alias("best")))[0]

    start = F.struct(F.array(*[F.lit(0).cast("long")] * COUNTERS).alias("counts"), F.lit(0).alias("total"), F.lit(0).alias("seen"), F.lit(2**31 - 1).alias("best"))
    return F.aggregate(both, start, step, lambda s: s["best"])


def most_sum(bits: float) -> int:
    """The sum of c * log2(c) at which a window still has so many bits a character."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * UNIT)


def is_secret(candidate: Column) -> Column:
    """Whether a candidate string is a secret by entropy, and unknown to the allow-list."""
    lower = F.lower(candidate)
    allowed = F.lit(False)
    for word in ALLOWED_WORDS:
        allowed |= lower.contains(word)
    for form in ALLOWED_FORMS:
        allowed |= candidate.rlike(form)
    allowed |= F.forall(F.split(candidate, SEPARATORS), lambda p: (F.length(p) <= WORD_MOST) & p.rlike(WORD_FORM))
    general = F.filter(F.array(F.regexp_replace(candidate, KEYBOARD_RUNS, "")), lambda r: F.length(r) >= WINDOW)
    hexes = F.flatten(F.transform(general, lambda r: F.filter(F.regexp_extract_all(r, F.lit(HEX_RUN), F.lit(0)), lambda h: h.rlike("[0-9]") & h.rlike("[a-fA-F]"))))
    secret = F.exists(general, lambda r: best_window(r) <= most_sum(MIXED_BITS)) | F.exists(hexes, lambda r: best_window(r) <= most_sum(HEX_BITS))
    return F.when(allowed, F.lit(False)).otherwise(secret)


def merged(spans: Column) -> Column:
    """Spans sorted by start as structs (start, end) that neither overlap nor touch."""

    def step(state: Column, s: Column):
        apart = s["start"] > state["to"]
        fields = {"from": F.when(apart, s["start"]).otherwise(state["from"]), "to": F.greatest(state["to"], s["end"])}
        return fields, F.struct(state["from"].alias("start"), state["to"].alias("end")), apart & (state["to"] >= 0)

    out = _gathered(spans, "struct<start:int,end:int>", {"from": F.lit(-1), "to": F.lit(-1)}, step, lambda s: F.struct(s["from"].alias("start"), s["to"].alias("end")))
    return F.filter(out, lambda s: s["end"] >= 0)


def not_covered(candidates: Column, base: Column) -> Column:
    """The candidates (start, kind, end, hit) that no span of base, sorted by start, covers whole; both in one sweep."""
    walls = F.transform(merged(base), lambda s: F.struct(s["start"], F.lit(-1).alias("kind"), s["end"], F.lit("").alias("hit")))

    def step(state: Column, s: Column):
        wall = s["kind"] < 0
        return {"reach": F.when(wall, s["end"]).otherwise(state["reach"])}, s, ~wall & (s["end"] > state["reach"])

    kept = _gathered(F.array_sort(F.concat(candidates, walls)), "struct<start:int,kind:int,end:int,hit:string>", {"reach": F.lit(-1)}, step)
    return F.when(F.size(base) == 0, candidates).when(F.size(candidates) == 0, candidates).otherwise(kept)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds base_spans and spans, arrays of structs (start, kind, end) sorted by start; kind counts from 0 in KINDS."""
    work = packed(df, text=text)
    t = F.coalesce("text", F.lit(""))
    base = F.array_sort(F.concat(*map(_bare, (_hits(t, ASSIGN, 0, ASSIGN_HEAD, 12), _hits(t, ACCESS, 1), _hits(t, HEX, 2)))))
    out = work.withColumns({"base_spans": base, "_candidates": _hits(t, CANDIDATE, 3)})
    found = F.filter(not_covered(F.col("_candidates"), F.col("base_spans")), lambda c: is_secret(c["hit"]))
    return unpacked(out, df.columns, base_spans=F.col("base_spans"), spans=F.array_sort(F.concat("base_spans", _bare(found))))


def joined(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


#: Characters of a slice of a text; a part of it is put together from slices.
SLICE = 1000


def _part(slices: str, start: Column, end: Column) -> Column:
    """The characters from start up to end of a text given as a column of its slices."""
    first = F.floor(start / SLICE).cast("int")
    n = F.greatest(F.floor((end - 1) / SLICE).cast("int") - first + 1, F.lit(0))

    def piece(s: Column, i: Column) -> Column:
        before = (first + i) * SLICE
        low = F.greatest(start - before, F.lit(0))
        return F.substring(s, low + 1, F.least(end - before, F.lit(SLICE)) - low)

    return F.when(end > start, F.array_join(F.transform(F.slice(slices, first + 1, n), piece), "")).otherwise("")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with all spans replaced by the mark, and n_chars, if there, counted anew; overlapping spans are one.

    A text without spans, null or not, stays as it is.
    """
    scanned = scan(packed(df, text=text))

    def step(state: Column, s: Column):
        fresh = s["start"] >= state["at"]
        return {"at": F.greatest(state["at"], s["end"])}, F.struct(state["at"].alias("start"), s["start"].alias("end")), fresh

    # what stays: before each mark, and behind the last one
    stays = _gathered(F.col("spans"), "struct<start:int,end:int>", {"at": F.lit(0)}, step, lambda s: F.struct(s["at"].alias("start"), F.lit(2**30).alias("end")))
    any_ = F.size("spans") > 0
    # in columns first: a lambda computes what is no column anew for each item
    cut = scanned.select("_row", "text", any_.alias("_any"), F.when(any_, stays).alias("_stays"), F.when(any_, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{SLICE}}}"), F.lit(0))).alias("_slices"), F.length("text").alias("_n"))
    whole = F.array_join(F.transform("_stays", lambda p: _part("_slices", p["start"], F.least(p["end"], F.col("_n")))), mark)
    done = cut.select("_row", "_any", F.when(F.col("_any"), whole).otherwise(F.col("text")).alias("_fresh"))
    fresh = {text: F.col("_fresh")}
    if "n_chars" in df.columns:
        fresh["n_chars"] = F.when(F.col("_any"), F.length("_fresh").cast("long")).otherwise(F.col("_row").getField("n_chars"))
    return unpacked(done, df.columns, **fresh).select(df.columns)
