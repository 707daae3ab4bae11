"""What forms hold: names after ranks, names in display case, dates in parts, numbers in words, templates, field checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import APOSTROPHES, bound

# Months in the genitive, ranks, number words, and words for what isn't there.
MONTHS = "січня лютого березня квітня травня червня липня серпня вересня жовтня листопада грудня".split()
RANKS = ("рекрут", "солдат", "старший солдат", "молодший сержант", "сержант", "старший сержант", "головний сержант", "штаб-сержант", "майстер-сержант", "старший майстер-сержант", "головний майстер-сержант", "молодший лейтенант", "лейтенант", "старший лейтенант", "капітан", "майор", "підполковник", "полковник")
ONES = "нуль один два три чотири п’ять шість сім вісім дев’ять десять одинадцять дванадцять тринадцять чотирнадцять п’ятнадцять шістнадцять сімнадцять вісімнадцять дев’ятнадцять".split()
TENS = "двадцять тридцять сорок п’ятдесят шістдесят сімдесят вісімдесят дев’яносто".split()
NUMBER_WORDS = {w: i for i, w in enumerate(ONES)} | {w: 20 + 10 * i for i, w in enumerate(TENS)}
NOT_ISSUED = ("не видано", "не видавався", "немає", "відсутній")
YEARS = (1990, 2035)


def rank_and_name(text: Column) -> Column:
    """(rank, surname, rest): the longest run of words that is a rank, the first upper-case word after it, and what follows."""
    runs = "|".join(sorted(RANKS, key=len, reverse=True))
    bare = F.trim(F.regexp_replace(text, r"\s+", " "))
    rank = F.regexp_extract(F.lower(bare), rf"(?U)(?:^|\s)({runs})(?=\s|$)", 1)
    after = F.when(rank != "", F.regexp_replace(bare, rf"(?iuU)^.*?(?:^|\s)(?:{runs})(?=\s|$)\s*", "")).otherwise(bare)
    surname = F.regexp_extract(after, r"(?:^|\s)(\p{Lu}[\p{Lu}’'ʼ-]+)(?=\s|$)", 1)
    rest = F.when(surname != "", F.trim(F.regexp_replace(after, r"^.*?(?:^|\s)\p{Lu}[\p{Lu}’'ʼ-]+(?=\s|$)", "")))
    return F.struct(F.nullif(rank, F.lit("")).alias("rank"), F.nullif(surname, F.lit("")).alias("surname"), F.nullif(rest, F.lit("")).alias("rest"))


def display_name(name: Column) -> Column:
    """A name as it is shown: each part of a hyphenated word with a capital; after an apostrophe too, if one letter leads it."""
    even = F.translate(F.trim(F.regexp_replace(name, r"\s+", " ")), APOSTROPHES, "’" * len(APOSTROPHES))
    capital = lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, F.lit(2), F.length(p))))
    led = lambda p: F.when(p.rlike("^.’."), F.concat(F.upper(F.substring(p, 1, 3)), F.lower(F.substring(p, F.lit(4), F.length(p))))).otherwise(capital(p))
    word = lambda w: F.array_join(F.transform(F.split(w, "-"), led), "-")
    return F.array_join(F.transform(F.split(even, " "), word), " ")


def date_of_parts(day: Column, month: Column, year: Column) -> Column:
    """A day from its printed parts: a month by name or number, a year of two digits is of this century.

    One that doesn't exist, or lies outside the years that forms can be of, is null.
    """
    named = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.trim(month)))
    number = F.when(named > 0, named).otherwise(F.trim(month).try_cast("int"))
    full = F.when(F.trim(year).rlike(r"^\d{2}$"), F.concat(F.lit("20"), F.trim(year))).otherwise(F.regexp_extract(year, r"\d{4}", 0))
    made = F.concat_ws("-", full, F.lpad(number.cast("string"), 2, "0"), F.lpad(F.regexp_extract(day, r"\d{1,2}", 0), 2, "0")).try_cast("date")
    return F.when(F.year(made).between(*YEARS), made)


def impossible_worded_date(text: Column) -> Column:
    """Whether a text names a day by its month's name that doesn't exist in that year, or in any year."""
    form = rf"(?iU)\b(\d{{1,2}})\s+({'|'.join(MONTHS)})(?:\s+(\d{{4}}))?"
    part = lambda i: F.regexp_extract(text, form, i)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(part(2)))
    made = F.concat_ws("-", F.when(part(3) != "", part(3)).otherwise("2024"), F.lpad(month.cast("string"), 2, "0"), F.lpad(part(1), 2, "0")).try_cast("date")
    return (part(2) != "") & made.isNull()


def attested_numbers(text: Column) -> Column:
    """The numbers that a text attests, sorted: in digits, in words, and as a ten with a one behind it."""
    words = F.filter(F.split(F.lower(F.translate(text, APOSTROPHES, "’" * len(APOSTROPHES))), r"[^\p{L}\p{N}’]+"), lambda w: w != "")
    table = F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in kv])
    digits = lambda w: F.when(F.ascii(w).between(48, 57), w.try_cast("bigint"))  # noqa: E731, a cast that fails costs an exception
    value = lambda w: F.coalesce(digits(w), F.try_element_at(table, w).cast("bigint"))

    def attested(values: Column) -> Column:
        single = F.filter(values, lambda v: v.isNotNull())
        pairs = F.filter(F.transform(values, lambda v, i: F.when((v >= 20) & (v < 100) & (v % 10 == 0) & F.get(values, i + 1).between(1, 9), v + F.get(values, i + 1))), lambda v: v.isNotNull())
        return F.array_sort(F.array_distinct(F.concat(single, pairs)))

    return bound(F.transform(words, lambda w: bound(w, value)), attested)


#: Points of a template's title and of each of its anchors, and the least that a template needs.
TITLE_POINTS, ANCHOR_POINTS, LEAST_POINTS = 5, 2, 6


def identified_template(text: Column, templates: dict[str, tuple[str, tuple[str, ...]]]) -> Column:
    """(template, score): of templates (title, anchors), the one with most points if no other has as many; else null.

    A template needs an anchor beside its points, so a title alone, which other papers may cite, is not enough.
    """
    low = F.lower(F.regexp_replace(text, r"\s+", " "))
    rows = []
    for name, (title, anchors) in templates.items():
        hits = sum((low.contains(a.lower()).cast("int") for a in anchors), F.lit(0))
        rows.append(F.struct(F.when(hits > 0, TITLE_POINTS * low.contains(title.lower()).cast("int") + ANCHOR_POINTS * hits).otherwise(0).alias("score"), F.lit(name).alias("template")))
    ordered = F.reverse(F.array_sort(F.array(*rows)))
    best, next_ = ordered[0], ordered[1]
    clear = (best["score"] >= LEAST_POINTS) & (best["score"] > next_["score"])
    return F.struct(F.when(clear, best["template"]).alias("template"), best["score"].alias("score"))


def form_coverage(lines: DataFrame, key: str, share: float = 0.1) -> DataFrame:
    """(key, printed, found, coverage, recognised) of papers as lines (key, line): how much of the printed form they hold.

    A line is printed if that share of all papers has it. A paper is recognised if half of the printed lines are found.
    """
    distinct = lines.select(key, "line").distinct()
    n = distinct.agg(F.count_distinct(key).alias("n"))
    counts = distinct.groupBy("line").agg(F.count("*").alias("c"))
    printed = counts.crossJoin(F.broadcast(n)).filter(F.col("c") >= F.lit(share) * F.col("n")).select("line")  # one row
    total = printed.agg(F.count("*").alias("printed"))
    found = distinct.join(printed, "line", "left_semi").groupBy(key).agg(F.count("*").alias("found"))
    out = lines.select(key).distinct().join(found, key, "left").crossJoin(F.broadcast(total))  # one row
    held = F.coalesce("found", F.lit(0))
    coverage = F.when(F.col("printed") > 0, F.round(held / F.col("printed"), 6)).otherwise(0.0)
    return out.select(key, "printed", held.alias("found"), coverage.alias("coverage"), (coverage >= 0.5).alias("recognised"))


def field_check(printed: Column, wanted: Column) -> Column:
    """How a printed field compares with what its paper should say: fine, blank, not issued, diverges or surplus."""
    even = lambda c: F.lower(F.trim(F.regexp_replace(F.translate(c, APOSTROPHES, "’" * len(APOSTROPHES)), r"\s+", " ")))
    empty = printed.isNull() | printed.rlike(r"^[\s_.\-–—]*$")
    return (
        F.when(empty, F.when(wanted.isNull(), "fine").otherwise("blank"))
        .when(even(printed).isin(*NOT_ISSUED), F.when(wanted.isNull(), "fine").otherwise("not issued"))
        .when(wanted.isNull(), "surplus")
        .when(even(printed) == even(wanted), "fine")
        .otherwise("diverges")
    )


# Fixed pattern: an act's own statement that it no longer holds, in its head.
REPEALED = r"(?iU)втрати(?:в|ла|ло)\s+чинність(?:\s+на\s+підставі\s+([^.\n]{3,80}))?"
VALIDITY_HEAD = 600


def validity_of(text: Column) -> Column:
    """(validity, source, note): superseded if the head declares it, with the act that did it; else current, unless told."""
    head = F.substring(text, 1, VALIDITY_HEAD)
    said = head.rlike(REPEALED)
    return F.struct(F.when(said, "superseded").otherwise("current").alias("validity"), F.when(said, "declared").otherwise("default").alias("source"), F.nullif(F.trim(F.regexp_extract(head, REPEALED, 1)), F.lit("")).alias("note"))


def references_in(text: Column) -> Column:
    """The numbers of the points that a text refers to."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?iU)\b(?:пункт\w*|п\.)\s*(\d{1,3})"), F.lit(1)), lambda n: n.cast("bigint"))


def without_prefix(text: Column, literal: str) -> Column:
    """A text without a printed phrase at its start, in any inflection: each word by its stem and up to three letters more."""
    words = [rf"{_escaped(w[: max(3, len(w) - 3)])}\p{{L}}{{0,{3 + len(w) - max(3, len(w) - 3)}}}" if len(w) > 3 else _escaped(w) for w in literal.split()]
    return F.regexp_replace(text, r"(?iuU)^\s*" + r"\s+".join(words) + r"(?!\p{L})[\s:.,–-]*", "")


def _escaped(literal: str) -> str:
    import re

    return re.escape(literal)


def looked_up(df: DataFrame, text: str, aliases: DataFrame, key: str, least: int = 5) -> DataFrame:
    """(key, code) of df by a dictionary (alias, code): the whole text, else the longest stem of a text that is an alias's.

    Up to three letters are cut from the end, none below `least`; an alias that two codes share gives none. The dictionary
    is counted and broadcast only if small.
    """
    known = aliases.select(F.lower(F.trim("alias")).alias("alias"), "code").groupBy("alias").agg(F.min("code").alias("code"), F.count_distinct("code").alias("n")).filter("n = 1").drop("n")
    known = F.broadcast(known) if known.count() <= 100_000 else known
    low = F.lower(F.trim(F.col(text)))
    stems = F.filter(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.when((k == 0) | (F.length(low) - k >= least), F.substring(low, F.lit(1), F.length(low) - k))), lambda s: s.isNotNull())
    asked = df.select(key, F.explode_outer(stems).alias("alias"))
    found = asked.join(known, "alias").groupBy(key).agg(F.max_by("code", F.length("alias")).alias("code"))
    return df.select(key).join(found, key, "left")


def translated(df: DataFrame, text: str, cache: DataFrame, lang: str, model: Column | None = None) -> DataFrame:
    """Adds shown and source: from a cache (lang, text, shown), else from a model if there is one, else the text itself."""
    own = cache.filter(F.col("lang") == lang).groupBy(F.col("text").alias("_text")).agg(F.min("shown").alias("_shown"))
    out = df.join(own, F.col(text) == F.col("_text"), "left")
    other = F.lit(None).cast("string") if model is None else model
    source = F.when(F.col("_shown").isNotNull(), "cache").when(other.isNotNull(), "model").otherwise("as it is")
    return out.withColumns({"shown": F.coalesce("_shown", other, F.col(text)), "source": source}).drop("_text", "_shown")


#: The slots of a form in the order in which it asks for them, and what an answer to each must look like.
FORM_SLOTS = (("person", r"^\p{L}[\p{L}’' -]{2,}$"), ("start", r"^\d{1,2}\.\d{1,2}\.\d{4}$"), ("days", r"^\d{1,3}$"), ("place", r"^\p{L}.*$"))


def form_dialogue(turns: DataFrame, keys: list[str], order: list[str], said: str) -> DataFrame:
    """(keys, step, asks, rejected, filled) after the last turn of each dialogue: an answer fills the slot asked for if it fits.

    An answer that doesn't fit is asked for again. "скасувати" begins anew. A fold over a dialogue's turns, in order.
    """
    each = turns.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(said).alias("_said")))), lambda x: x["_said"]).alias("_turns"))  # a dialogue
    forms = F.array(*[F.lit(p) for _, p in FORM_SLOTS])
    start = F.struct(F.lit(0).alias("step"), F.lit(0).alias("rejected"), F.array().cast("array<string>").alias("filled"))

    def fold(s: Column, answer: Column) -> Column:
        open_, again = s["step"] < len(FORM_SLOTS), F.lower(F.trim(answer)) == "скасувати"
        fits = F.call_function("rlike", F.trim(answer), F.get(forms, s["step"]))
        return F.when(again, start).when(~open_, s).when(fits, F.struct((s["step"] + 1).alias("step"), s["rejected"].alias("rejected"), F.concat(s["filled"], F.array(F.trim(answer))).alias("filled"))).otherwise(F.struct(s["step"].alias("step"), (s["rejected"] + 1).alias("rejected"), s["filled"].alias("filled")))

    state = each.select(*keys, F.aggregate("_turns", start, fold).alias("s"))
    return state.select(*keys, F.col("s.step").alias("step"), F.get(F.array(*[F.lit(n) for n, _ in FORM_SLOTS]), F.col("s.step")).alias("asks"), F.col("s.rejected").alias("rejected"), F.array_join("s.filled", "|").alias("filled"))
