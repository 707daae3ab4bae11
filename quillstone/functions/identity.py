"""What an act is called and numbered: its identity from its text, canonical identifiers, and identifiers in questions.

Everything is a column expression. The patterns are in the language of the acts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bound, fold_homoglyphs

# How acts name and number themselves.
MONTHS = "січня лютого березня квітня травня червня липня серпня вересня жовтня листопада грудня".split()
ROMAN_LOOK, ROMAN = "іихсмдлв", "iixcmdlv"
STANDARD_MARK = r"(?iU)НОРМАТИВНИЙ\s+ДОКУМЕНТ"
STANDARD_NUMBER = r"\d\.\d\s*-\s*\d{3}\s*-\s*\d{2,4}"
PUBLISHER = r"ДСТСЗІ|Департамент\s+спеціальних\s+телекомунікаційних|Адміністрація\s+Держав\w*\s+служб"
CITED = r"(?:вимог\w{0,8}|згідно\s{1,3}з|відповідно\s{1,3}до|див\.|порівн\w{0,8}|урахуванням|підставі|визначен\w{0,8})\s{1,3}"
ORDER_HEAD = r"(?iU)НАКАЗ\s*(?:від\s*)?(\d{2}\.\d{2}\.\d{4})?\s*(?:м\.\s*КИ[ЇI]В)?\s*(\d{2}\.\d{2}\.\d{4})?\s*№\s*(\d+)"
GAZETTE = r"(?isU)Відомост\w*\s+Верховн\w*\s+Рад\w*.{0,40}?(\d{4})\s*,\s*№\s*([\d-]+)\s*,\s*ст\.?\s*(\d+)"
SIGNED_IN_CITY = r"(?iU)м\.\s*Ки[їi]в\s*(\d{1,2})\s+([а-яіїєґ]+)\s+(\d{4})\s*року\s*№\s*(\d{2,5}\s*[-–]\s*[IVXLC]{1,6}|\d+/\d+\s*[-–]\s*ВР)"
SIGNED_BY_HEAD = r"(?isU)(?:Президент\s+України|Голова\s+Верховної\s+Ради)[^№]{0,160}?№\s*(\d{2,5}\s*[-–]\s*[IVXLC]{1,6}|\d+/\d{4})"
DECREE = r"(?iU)Указ\s+Президента"
APPROVED = r"(?isU)ЗАТВЕРДЖЕНО\s+Наказ\w*\s+.{0,80}?\s*(\d{1,2})\s+([а-яіїєґ]+)\s+(\d{4})\s*№\s*(\d+)"
ABOUT = r"(?isU)(Про\s+.{10,400})"
RULES_TITLE = r"(?isU)((?:ІНСТРУКЦІЯ|ПОЛОЖЕННЯ|ПОРЯДОК|ПРАВИЛА)\s+.{10,250})"
BARE_TITLE = r"(?isU)^\s*((?:Про|Деякі|Щодо)\s+.{10,400})"
TITLE_STOP = r"(?isU)(?:Відповідно\s+до|З\s+метою|НАКАЗУЮ|ПОСТАНОВЛЯ|Кабінет\s+Міністрів|Цей\s+Закон|\(Відомост|Зареєстровано|\d\.\s+[А-ЯІЇЄҐ]).*$"
#: Characters from which notes are dropped, and characters of the head.
WIDE, HEAD = 60_000, 2_600


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, or null."""
    return bound(F.regexp_extract(text, pattern, group), lambda found: F.when(found != "", found))


def without_notes(text: Column) -> Column:
    """Notes in braces are about other acts."""
    return F.when(F.contains(text, F.lit("{")), F.regexp_replace(text, r"\{[^{}]*\}", " ")).otherwise(text)


def joined_letters(text: Column) -> Column:
    """Words that are spaced out letter by letter, four letters or more, are put together."""
    runs = F.regexp_extract_all(text, F.lit(r"(?U)(?=\p{L}\s\p{L}\s)(?<!\S)(?:\p{L}\s){3,}\p{L}(?!\S)"), F.lit(0))
    joined = F.aggregate(runs, text, lambda t, r: F.replace(t, r, F.regexp_replace(r, r"\s", "")))
    return F.when(text.rlike(r"(?U)\s\p{L}\s\p{L}\s"), joined).otherwise(text)  # a cheaper look; every run has this inside


def head_of(text: Column) -> Column:
    clean = bound(bound(F.substring(text, 1, WIDE), without_notes), joined_letters)
    return F.substring(F.regexp_replace(clean, r"[ \t ]{2,}|[\t ]", " "), 1, HEAD)  # single spaces stay untouched


def _squeezed(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def _day(day: Column, month: Column, year: Column) -> Column:
    """Day, month's name and year as yyyy-mm-dd, or null."""
    of = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(month))
    return bound(of, lambda at: F.when(at > 0, F.concat_ws("-", year, F.lpad(at.cast("string"), 2, "0"), F.lpad(day, 2, "0"))))


def _title(segment: Column, most: int = 300) -> Column:
    """A title ends where an act's own words begin."""
    ended = lambda one: bound(F.regexp_replace(one, TITLE_STOP, ""), lambda cut: F.when(F.length(cut) > 10, cut).otherwise(one))
    whole = bound(F.trim(F.regexp_replace(segment, r"\s+", " ")), ended)
    return bound(F.substring(F.regexp_replace(whole, r"^[ .;:,()]+|[ .;:,()]+$", ""), 1, most), lambda title: F.when(title != "", title))


def signature(text: Column) -> Column:
    """(number, day) of the block where an act is signed, wherever it stands in the text."""

    def read(clean: Column) -> Column:
        # looked for only where its first letters are (one more sign than these counts as an o), found once, and read from the block
        city = F.when(F.contains(clean, F.lit("м.")) | F.contains(clean, F.lit("М.")), F.regexp_extract(clean, SIGNED_IN_CITY, 0)).otherwise("")
        may = bound(F.lower(clean), lambda low: F.contains(low, F.lit("през")) | F.contains(low, F.lit("гол")) | F.contains(low, F.lit("г\u1c82л")))
        return bound(city, lambda block: F.when(block != "", parts(block)).otherwise(F.struct(_squeezed(F.when(may, _first(clean, SIGNED_BY_HEAD))).alias("number"), F.lit(None).cast("string").alias("day"))))

    def parts(block: Column) -> Column:
        day = _day(*(F.regexp_extract(block, SIGNED_IN_CITY, i) for i in (1, 2, 3)))
        return F.struct(_squeezed(F.regexp_extract(block, SIGNED_IN_CITY, 4)).alias("number"), day.alias("day"))

    return bound(without_notes(text), read)


def identified(df: DataFrame, text: str, out: str = "identity") -> DataFrame:
    """Adds (kind, identifier, title, issued, confidence) that an act states about itself; all but confidence null if it doesn't."""
    # bound, since many rules look at each
    return df.withColumn(out, bound(F.coalesce(F.col(text), F.lit("")), lambda own: bound(head_of(own), lambda head: bound(signature(own), lambda signed: identity_of(head, signed)))))


def identity_of(head: Column, signed: Column) -> Column:
    """The identity by an act's head and its signature."""
    said = F.when(signed["number"].isNotNull(), F.concat(F.lit("№ "), signed["number"]))

    def found(kind: str, identifier: Column, title: Column, issued: Column, confidence: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), identifier.alias("identifier"), title.alias("title"), issued.cast("string").alias("issued"), confidence.cast("double").alias("confidence"))

    # the own number of a standard stands right before its publisher; one behind words of reference is another's
    beside = _first(head, rf"(?isU)(?=\d\.\d)(?<!{CITED}НД\s{{0,3}}ТЗІ\s{{0,3}})({STANDARD_NUMBER})(?=(?:(?!{STANDARD_NUMBER}).){{0,80}}?(?:{PUBLISHER}))")
    any_ = _first(head, rf"(?iU)(?=НД)(?<!{CITED})НД\s*ТЗІ\s*({STANDARD_NUMBER})")
    year = _first(head, r"(?i)Київ\s*(\d{4})")

    def standard_of(number: Column, sure: Column) -> Column:
        before = F.regexp_replace(F.call_function("substring_index", head, number, F.lit(1)), r"(?isU)^.*?НОРМАТИВНИЙ\s+ДОКУМЕНТ(?:\s+СИСТЕМИ\s+ТЕХНІЧНОГО\s+ЗАХИСТУ\s+ІНФОРМАЦІЇ)?", "")
        standard_title = F.regexp_replace(before, r"(?iU)\s*НД\s*ТЗІ\s*$", "")
        return found("standard", F.concat(F.lit("НД ТЗІ "), _squeezed(number)), _title(standard_title), F.when(number.isNotNull(), F.concat(year, F.lit("-01-01"))), sure)

    standard = bound(beside, lambda own: F.when(own.isNotNull(), standard_of(own, F.lit(0.95))).otherwise(bound(any_, lambda other: standard_of(other, F.when(other.isNotNull(), 0.5).otherwise(0.0)))))
    order_day = F.coalesce(_first(head, ORDER_HEAD, 1), _first(head, ORDER_HEAD, 2))
    tail = F.regexp_replace(F.regexp_replace(head, "(?s)^.*?" + ORDER_HEAD, ""), r"(?s)^.*?за\s*№\s*\d+/\d+", "")
    order = bound(order_day, lambda day: found("order", F.concat(F.lit("наказ № "), _first(head, ORDER_HEAD, 3), F.coalesce(F.concat(F.lit(" від "), day), F.lit(""))), _title(tail), F.concat_ws("-", F.substring(day, 7, 4), F.substring(day, 4, 2), F.substring(day, 1, 2)), F.lit(0.9)))
    gazette = F.concat(F.lit("ВВР "), _first(head, GAZETTE, 1), F.lit(" № "), _first(head, GAZETTE, 2), F.lit(" ст."), _first(head, GAZETTE, 3))
    law_title = _title(F.regexp_replace(F.regexp_replace(head, GAZETTE + "(?s).*$", ""), r"(?i)^\s*(?:ЗАКОН|КОДЕКС)\s*У\s*К\s*Р\s*А\s*[ЇI]\s*Н\s*И\s*", ""))
    law = bound(law_title, lambda title: found("law", F.coalesce(said, gazette), title, signed["day"], F.when(title.isNull(), F.when(said.isNotNull(), 0.75).otherwise(0.3)).when(said.isNotNull(), 0.9).otherwise(0.85)))
    decree = found("decree", said, _title(_first(head, ABOUT)), signed["day"], F.when(said.isNotNull(), 0.8).otherwise(0.4))
    approved_day = _day(*(F.regexp_extract(head, APPROVED, i) for i in (1, 2, 3)))
    approved = bound(approved_day, lambda day: found("approved", F.concat(F.lit("наказ № "), _first(head, APPROVED, 4), F.coalesce(F.concat(F.lit(" від "), day), F.lit(""))), _title(_first(F.regexp_replace(head, "(?s)^.*?" + APPROVED, ""), RULES_TITLE)), day, F.lit(0.8)))
    bare = found("untitled", said, _title(_first(head, BARE_TITLE)), signed["day"], F.when(said.isNotNull(), 0.75).otherwise(0.45))
    none = F.lit(None).cast("string")
    nothing = F.struct(none.alias("kind"), none.alias("identifier"), none.alias("title"), none.alias("issued"), F.lit(0.0).alias("confidence"))
    return (
        F.when(head.rlike(STANDARD_MARK), standard)
        .when(F.regexp_instr(head, F.lit(ORDER_HEAD)).between(1, 400), order)
        .when(head.rlike(GAZETTE), law)
        .when(F.substring(head, 1, 200).rlike(DECREE), decree)
        .when(head.rlike(APPROVED), approved)
        .when(head.rlike(BARE_TITLE), bare)
        .otherwise(nothing)
    )


def canonical(identifier: Column) -> Column:
    """An identifier as kind:parts, the same however it is written; null if it is none.

    A standard, a gazette reference, an old law, a law with a session in Roman numerals, a decree or an order, tried in
    this order. An order's date isn't a part of it.
    """
    t = F.lower(fold_homoglyphs(identifier))
    return bound(F.trim(F.regexp_replace(F.regexp_replace(t, r"[‐-―−]", "-"), r"[\s ]+", " ")), _canonical)


def _canonical(t: Column) -> Column:
    gazette = r"(\d{4})\s*,?\s*№\s*([\d-]+)\s*,?\s*ст\.?\s*(\d+)"
    law = bound(
        F.translate(F.regexp_extract(t, r"(?U)(\d{2,5})\s*-\s*(\p{L}{1,7})(?![\w-])", 2), ROMAN_LOOK, ROMAN),
        lambda session: F.when(session.rlike("^[ivxlcdm]+$"), F.concat_ws(":", F.lit("law"), F.regexp_extract(t, r"(?U)(\d{2,5})\s*-\s*(\p{L}{1,7})(?![\w-])", 1), session)),
    )
    return F.coalesce(
        F.concat(F.lit("standard:"), _squeezed(_first(t, rf"({STANDARD_NUMBER})"))),
        F.when(t.rlike(gazette), F.concat_ws(":", F.lit("gazette"), *[F.regexp_extract(t, gazette, i) for i in (1, 2, 3)])),
        F.when(t.rlike(r"\d+\s*/\s*\d+\s*-\s*вр"), F.concat_ws(":", F.lit("old law"), *[F.regexp_extract(t, r"(\d+)\s*/\s*(\d+)\s*-\s*вр", i) for i in (1, 2)])),
        law,
        F.when(t.rlike(r"\d{1,5}\s*/\s*\d{4}"), F.concat_ws(":", F.lit("decree"), *[F.regexp_extract(t, r"(\d{1,5})\s*/\s*(\d{4})", i) for i in (1, 2)])),
        F.concat(F.lit("order:"), F.coalesce(_first(t, r"№\s*(\d+)"), _first(t, r"(?U)наказ\w*\s*(\d+)"))),
    )


# What in a question looks like an act's number, and the words beside it.
ASKED = (
    r"(?iU)(?:НД\s*ТЗ[ІIi]\s*)?\d\.\d\s*[-–—]\s*\d{3}\s*[-–—]\s*\d{2,4}",
    r"(?iU)\d{1,4}\s*/\s*\d{2,4}\s*[-–—]\s*[ВB][РP]",
    r"(?U)№?\s*\d{2,5}\s*[-–—]\s*[IVXLCivxlcІХіх]{1,6}(?![\w-])",
    r"(?U)№?\s*\d{1,5}\s*/\s*\d{4}(?![\d-])",
    r"(?iU)наказ\w*\s*№?\s*\d{1,4}(?!\d)",
)
BESIDE_NUMBERS = r"(?iU)\bнд\s*тз[іi]\b|№|\bнаказ\w*\b|\bзакон\w*\b|\bуказ\w*\b"


def identifiers_in(question: Column) -> Column:
    """The canonical identifiers that a question names, each once."""
    hits = F.flatten(F.array(*[F.regexp_extract_all(question, F.lit(p), F.lit(0)) for p in ASKED]))
    return F.array_distinct(F.filter(F.transform(hits, canonical), lambda k: k.isNotNull()))


def without_identifiers(question: Column) -> Column:
    """What a question asks besides the acts that it names."""
    rest = question
    for p in ASKED:
        rest = F.regexp_replace(rest, p, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(rest, BESIDE_NUMBERS, " "), r"\s+", " "))


# Fixed pattern: a file named by its act: an order's number and day, or a law's number.
ORDER_FILE = r"(?iU)наказ\w*[\s_№-]*(\d{1,5})(?:[\s_]*(?:від)?[\s_]*(\d{2}\.\d{2}\.\d{4}))?"
LAW_FILE = r"(?iU)(?:закон\w*|кодекс\w*)[\s_№]*(\d{2,5}-[IVXLC]{1,6})"
#: Marks by which a text is known as an act: its title, or two formal words of an act.
ACT_TITLE = r"(?iuU)^\s*(?:закон\w*|наказ|указ|постанова|кодекс|положення|інструкція|нормативний\s+документ|затверджено)(?!\p{L})"
ACT_WORDS = ("наказую", "набирає чинності", "цей закон", "відповідно до", "зареєстровано", "відомості верховної ради", "президент україни", "загальні положення")


def named_by_file(name: Column, text: Column, found: Column) -> Column:
    """(identifier, source, confidence): from the file's name if it names an act, else what the text states (identity_of)."""
    order = F.concat(F.lit("наказ № "), _first(name, ORDER_FILE), F.coalesce(F.concat(F.lit(" від "), _first(name, ORDER_FILE, 2)), F.lit("")))
    law = F.concat(F.lit("№ "), _first(name, LAW_FILE))
    stated = lambda f: F.struct(f["identifier"].alias("identifier"), F.when(f["identifier"].isNotNull(), "text").alias("source"), f["confidence"].alias("confidence"))
    # what the text states is looked at only if the name says nothing
    return bound(F.coalesce(order, law), lambda own: F.when(own.isNotNull(), F.struct(own.alias("identifier"), F.lit("file name").alias("source"), F.lit(0.95).alias("confidence"))).otherwise(bound(found, stated)))


def is_act(text: Column) -> Column:
    """Whether a text is an act, which is settled before any domain is scored: by its title, or by two formal words."""
    words = lambda head: sum((head.contains(w).cast("int") for w in ACT_WORDS), F.lit(0))
    return bound(F.lower(head_of(text)), lambda head: head.rlike(ACT_TITLE) | (words(head) >= 2))
