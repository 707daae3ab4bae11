"""Text functions as column expressions: folding, cleaning, dates, numbers, patterns and classification."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters that look alike, Latin against Cyrillic, and letters that stand for digits.
LATIN, CYRILLIC = "ABCEHIKMOPTXaceiopxy", "АВСЕНІКМОРТХасеіорху"
DIGIT_LIKE, DIGITS = "ОоOoЗбІIl", "000036111"
APOSTROPHES, DASHES, QUOTES = "'ʼ‘`´", "‐‑‒–—−", "«»“”„\""


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) where value is computed once a row, however often `use` needs it: inside lambdas and branches, too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalize_space(text: Column) -> Column:
    """Control characters go, and any white space becomes one space."""
    clean = F.regexp_replace(text, r"[\p{Cntrl}&&[^\n\t\r]]", "")
    return F.trim(F.regexp_replace(clean, r"[\s  ​]+", " "))


def fold_homoglyphs(text: Column) -> Column:
    return F.translate(text, LATIN, CYRILLIC)


def fix_digits(text: Column) -> Column:
    """Letters that look like digits become digits, in tokens that hold a digit."""
    return F.array_join(F.transform(F.split(text, " "), lambda t: F.when(t.rlike("[0-9]"), F.translate(t, DIGIT_LIKE, DIGITS)).otherwise(t)), " ")


def fold_quote(text: Column) -> Column:
    """A text as quotes are compared: apostrophes, dashes, quotation marks, case and white space folded."""
    t = F.translate(text, APOSTROPHES, "’" * len(APOSTROPHES))
    t = F.translate(t, DASHES, "-" * len(DASHES))
    t = F.translate(t, QUOTES, "~" * len(QUOTES))
    return F.trim(F.regexp_replace(F.lower(t), r"\s+", " "))


def quoted_verbatim(quote: Column, body: Column) -> Column:
    return F.contains(fold_quote(body), fold_quote(quote))


def date_of(text: Column) -> Column:
    """The first date in a text, as yyyy-mm-dd or dd.mm.yyyy (two-digit years are 20yy); an impossible date is null."""
    iso = F.regexp_extract(text, r"\b(\d{4})-(\d{2})-(\d{2})\b", 0)
    day, month, year = (F.regexp_extract(text, r"\b(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})\b", i) for i in (1, 2, 3))
    dotted = F.concat_ws("-", F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.coalesce(F.when(iso != "", iso), F.when(day != "", dotted)).try_cast("date")


def impossible_date(text: Column) -> Column:
    """Whether a text names a date that doesn't exist."""
    return text.rlike(r"\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}\.\d{1,2}\.\d{4}\b") & date_of(text).isNull()


def is_blank(value: Column) -> Column:
    """Null, empty, a word for nothing, or only lines and dots."""
    return value.isNull() | F.lower(F.trim(value)).isin("", "-", "none", "n/a", "null") | value.rlike(r"^[\s_.\-–—]*$")


def name_pattern(word: str) -> str:
    """A pattern for a name in any inflection: its stem, then up to four more letters; a short word matches nothing."""
    import re

    if len(word) < 3:
        return r"(?!)"
    return rf"(?iu)(?<!\p{{L}}){re.escape(word[: max(5, len(word) - 3)])}\p{{L}}{{0,4}}(?!\p{{L}})"


def phrase_pattern(phrase: str, stem: bool = False) -> str:
    """A pattern for a phrase with a word border at its start, and at its end unless it is a stem."""
    import re

    body = r"\s+".join(map(re.escape, phrase.split()))
    return rf"(?iuU)(?<!\w){body}" + ("" if stem else r"(?!\w)")


def one_match(text: Column, pattern: str, group: int = 1) -> Column:
    """(value, reason): the only distinct match; none is 'missing' and more than one 'ambiguous'."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
    return F.struct(F.when(F.size(found) == 1, found[0]).alias("value"), F.when(F.size(found) == 0, "missing").when(F.size(found) > 1, "ambiguous").alias("reason"))


def html_to_lines(page: Column) -> Column:
    """Markup to text: scripts and styles go, tags are line ends, a few references are decoded, empty lines go."""
    t = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "\n")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def lexemes(text: Column) -> Column:
    """The lower-case words of two letters or more."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 1)


def sampled(key: Column, rate: int) -> Column:
    """Whether a row is in a deterministic sample of one in `rate`, by the hash of its key."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % rate == 0


#: The kinds of fields that an evaluator compares.
FIELD_KINDS = ("date", "number", "name", "category", "contains", "text")


def fields_agree(kind: Column, got: Column, want: Column, aliases: dict[str, str]) -> Column:
    """Whether a field that was read agrees with what was wanted; one that is missing or no value of its kind doesn't."""
    number = lambda c: F.regexp_extract(c, r"-?\d+", 0).try_cast("bigint")
    bag = lambda c: F.array_sort(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != ""))
    table = F.create_map(*[F.lit(s) for kv in aliases.items() for s in kv])
    plain = lambda c: F.lower(F.trim(c))
    code = lambda c: F.coalesce(F.try_element_at(table, plain(c)), plain(c))
    same = (
        F.when(kind == "date", date_of(got) == date_of(want))
        .when(kind == "number", number(got) == number(want))
        .when(kind == "name", bag(got) == bag(want))
        .when(kind == "category", code(got) == code(want))
        .when(kind == "contains", F.contains(fold_quote(got), fold_quote(want)))
        .when(kind == "text", fold_quote(got) == fold_quote(want))
    )
    return F.coalesce(same, F.lit(False))


# The forms in which texts declare an abbreviation: its full form, then the abbreviation.
DECLARATIONS = {
    "declared": r"(?i)([^.;:\n()]{6,90}?)\(\s*далі\s*[-–—]?\s*([^)]{2,30})\)",
    "listed": r"(?m)^\s*\d+\.\d+(?:\.\d+)?\s+(\p{L}[^;\n]{3,70});\s*([А-ЯІЇЄҐA-Z]{2,10})(?!\p{L})",
    "bracketed": r"(\p{L}[\p{L}'’\s-]{6,70}?)\s*\(\s*([А-ЯІЇЄҐ]{2,10})\s*\)",
}
ABBREVIATION = r"^[А-ЯІЇЄҐA-Z][А-ЯІЇЄҐA-Z0-9\s.-]{1,14}$"


def declared_abbreviations(df: DataFrame, text: str = "text") -> DataFrame:
    """(abbr, full_form, source, seen): abbreviations that texts declare, and how often.

    The full form is the fewest last words, about as many as the abbreviation has letters, in which its letters follow one
    another; without such words it isn't one.
    """
    pairs = F.concat(*[F.transform(F.arrays_zip(F.regexp_extract_all(text, F.lit(p), F.lit(1)).alias("f"), F.regexp_extract_all(text, F.lit(p), F.lit(2)).alias("a")), _sourced(s)) for s, p in DECLARATIONS.items()])
    found = df.select(F.explode(pairs).alias("p")).select("p.*").groupBy("said", "abbr", "source").agg(F.count("*").alias("seen"))
    tidy = lambda c: F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), r"^[ ,;:–—-]+|[ ,;:–—-]+$", "")
    found = found.withColumns({"said": F.regexp_replace(tidy(F.col("said")), r"\s+[-–—]\s.*$", ""), "abbr": tidy(F.col("abbr"))})
    found = found.filter(F.col("abbr").rlike(ABBREVIATION) & F.length("said").between(6, 90))
    letters = F.regexp_replace(F.lower("abbr"), r"[^\p{L}]", "")
    found = found.withColumns({"_order": F.array_join(F.split(letters, ""), ".*"), "_n": F.length(letters), "_w": F.split("said", " ")}).filter("_n >= 2")
    tails = F.transform(F.sequence(F.greatest(F.lit(1), F.col("_n") - 1), F.col("_n") + 2), lambda k: F.when(k <= F.size("_w"), F.array_join(F.slice("_w", F.size("_w") - k + 1, k), " ")))
    full = F.get(F.filter(tails, lambda t: t.isNotNull() & F.call_function("rlike", F.lower(t), F.col("_order"))), F.lit(0))
    return found.withColumn("full_form", full).filter(F.length("full_form") >= 6).groupBy("abbr", "full_form", "source").agg(F.sum("seen").alias("seen"))


def _sourced(source: str):
    return lambda p: F.struct(p["f"].alias("said"), p["a"].alias("abbr"), F.lit(source).alias("source"))
