"""Quality rules with thresholds that adapt to each language and source, from mergeable quantile sketches.

A sketch is a histogram over log-linear bins of an integer measure: the bin keeps the eight leading bits, so a
quantile is off by less than 1 part in 128. Sketches merge by adding counts. They are aggregated for each (language,
source) with map-side sums, and merged once more for each language and for the whole corpus; a group with fewer than
MIN_GROUP measured documents takes the thresholds of its language, a small language those of the corpus.

A threshold is the group's median plus (or minus) SPREAD times the distance from its 5 % quantile to its median, plus
a margin. The lower half measures the spread because junk only ever lies above, so junk doesn't widen the fence until
it is half of a group. One scan feeds the sketches, a second one gives the verdicts. Documents join their group's
thresholds: broadcast, if their counted rows are few, so that no text is shuffled; beyond BROADCAST_ROWS groups by salted
keys, which shuffles the documents once and gives the same rows.

Everything on the path is a DataFrame function. A null text has no words, fails the base rule and isn't kept; so does
any text under 50 words. Null languages and sources are groups of their own. Repeated rows count as often as they
occur and come out as often. No rows give no thresholds and no rows. Extra columns pass through; one named like an
added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked, words_of, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: A document fails the base rule if more than this share of its words lies in repeated windows, in hundredths.
MOST_REPEATED = 50
#: Measured documents that a group needs for thresholds of its own.
MIN_GROUP = 200
SPREAD = 6
#: Of each measure: added to the fence, in the measure's unit.
MARGINS = {"symbol_rate": 200, "word_length": 150, "dup_line_rate": 450}
#: Rows of thresholds up to which they are broadcast (about 100 bytes each), and salts beyond.
BROADCAST_ROWS = 50_000
SALTS = 16
#: Files of a written sketch or table of thresholds, whatever the number of shuffle partitions.
FILES = 4


def base_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the cheap measures: n_words, word_chars, n_symbols, n_lines, n_dup_lines and the words (_words)."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = df.withColumns({"_words": words_of(F.col(text)), "_lines": lines})
    return out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    ).drop("_lines")


#: Up to so many different repeated windows, membership is a search through their list; beyond, windows are sorted.
FEW_REPEATS = 64


def repeated_words(df: DataFrame, words: str = "_words") -> DataFrame:
    """Adds n_repeat_words: words that lie in 3-word windows which occur twice or more in the text.

    Windows are told apart by 64-bit hashes within one text, where two of 10,000 windows collide once in 10**11 texts.
    """
    w = F.col(words)
    hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    df = df.withColumn("_hashes", F.when(F.size(w) > 2, F.slice(hashed, 1, F.size(w) - 2)))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array("_hashes")))
    again = F.filter("_sorted", lambda x, k: x == F.get("_sorted", k + 1))
    df = df.withColumn("_again", F.when(F.col("_sorted").isNotNull(), F.array_distinct(again)))
    few = F.filter(F.transform("_hashes", lambda x, i: F.when(F.array_contains("_again", x), i)), lambda i: i.isNotNull())
    pairs = F.when(F.size("_again") > FEW_REPEATS, F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    df = df.withColumn("_pairs", pairs)
    p = F.col("_pairs")
    many = F.transform(F.filter(p, lambda x, k: (x["h"] == F.get(p, k + 1)["h"]) | (x["h"] == F.get(p, k - 1)["h"])), lambda x: x["i"])
    df = df.withColumn("_at", F.when(F.size("_again") > FEW_REPEATS, many).when(F.col("_again").isNotNull(), few))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_at", lambda i: F.array(i, i + 1, i + 2)))))
    out = df.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_at").isNotNull(), covered), F.lit(0)).cast("long"))
    return out.drop("_hashes", "_sorted", "_again", "_pairs", "_at")


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds all measures of the base rule, n_repeat_words and base_failed included."""
    out = repeated_words(base_measures(df, text)).drop("_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _rates() -> dict[str, Column]:
    """The adaptive measures as integers: symbols in 1/10,000 of word characters, mean word length in 1/100
    characters, repeated lines in 1/1000 of lines."""
    return {
        "symbol_rate": F.expr("n_symbols * 10000 div greatest(word_chars, 1)"),
        "word_length": F.expr("word_chars * 100 div greatest(n_words, 1)"),
        "dup_line_rate": F.expr("n_dup_lines * 1000 div greatest(n_lines, 1)"),
    }


def bin_of(value: Column) -> Column:
    """The lower border of a value's bin: its eight leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    width = F.pow(F.lit(2), drop).cast("long")
    return value - value % width


def sketches(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, measure, bin, n): a sketch for each group and measure, of documents with enough words."""
    measured = base_measures(df.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))).filter(F.col("n_words") >= MIN_WORDS)
    rates = _rates()
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), bin_of(v).alias("bin")) for k, v in rates.items()])
    one = measured.select("lang", "source", F.explode(pairs).alias("p")).select("lang", "source", "p.*")
    return one.groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """A row for each of keys with total and a map from measure to a struct of the quantiles."""
    from pyspark.sql import Window

    merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumns({"upto": F.sum("n").over(group.orderBy("bin")), "total": F.sum("n").over(group)})
    found = ranked.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"), *[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * F.lit(q)), F.col("bin"))).alias(name) for name, q in shares.items()]
    )
    return found.groupBy(*keys).agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("measure", F.struct(*shares).alias("q")))).alias("of"))


def thresholds(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, most_symbol_rate, least_word_length, most_word_length, most_dup_line_rate), written.

    All shuffle partitions merge the sketches, then FILES writers get the merged rows; FILES tasks join the quantiles, a
    row for each group. Files cost more than their rows: without Hadoop's native library an executor starts processes for
    each, to set permissions.
    """
    sketch = written(sketches(df, lang, source, text).repartition(FILES), "sketches")
    shares = {"low": 0.05, "mid": 0.5}
    group = quantiles(sketch, ["lang", "source"], shares)
    by_lang = quantiles(sketch, ["lang"], shares).toDF("l_lang", "l_total", "l_of")
    whole = quantiles(sketch.withColumn("all", F.lit(1)), ["all"], shares).select(F.col("of").alias("w_of"))
    out = group.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(whole), how="cross")  # whole is one row
    of = F.when(F.col("total") >= min_group, F.col("of")).when(F.col("l_total") >= min_group, F.col("l_of")).otherwise(F.col("w_of"))
    out = out.withColumn("q", of)

    def fence(measure: str, sign: int) -> Column:
        q = F.col("q")[measure]
        wide = SPREAD * (q["mid"] - q["low"])
        return q["mid"] + F.lit(sign) * (F.greatest(wide, F.lit(MARGINS[measure])) if measure == "word_length" else wide + MARGINS[measure])

    return written(
        out.select("lang", "source", fence("symbol_rate", 1).alias("most_symbol_rate"), fence("word_length", -1).alias("least_word_length"), fence("word_length", 1).alias("most_word_length"), fence("dup_line_rate", 1).alias("most_dup_line_rate")).coalesce(FILES),
        "thresholds",
    )


def judge(df: DataFrame, limits: DataFrame | None = None, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Adds the measures, base_failed and kept."""
    limits = thresholds(df, lang, source, text) if limits is None else limits
    # a filter on the verdict must not be pushed below the measures, where it would repeat all their expressions; it
    # can't pass a column that isn't deterministic
    work = packed(df, lang=lang, source=source, text=text)
    out = measures(work).withColumn("_fence", F.monotonically_increasing_id())
    keys = [F.col("lang").eqNullSafe(F.col("t_lang")), F.col("source").eqNullSafe(F.col("t_source"))]
    limits = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    if limits.count() <= BROADCAST_ROWS:
        joined = out.join(F.broadcast(limits), keys[0] & keys[1], "left")
    else:
        salted = limits.withColumn("t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")
        joined = out.join(salted, keys[0] & keys[1] & (salt == F.col("t_salt")), "left").drop("t_salt")
    rate = _rates()
    fine = (
        (rate["symbol_rate"] <= F.col("most_symbol_rate"))
        & (rate["word_length"] >= F.col("least_word_length"))
        & (rate["word_length"] <= F.col("most_word_length"))
        & (rate["dup_line_rate"] <= F.col("most_dup_line_rate"))
        & (F.col("_fence") >= 0)
    )
    added = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")}
    return unpacked(joined, df.columns, **added, kept=~F.col("base_failed") & F.coalesce(fine, F.lit(False)))


def keep_good(df: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns that they came with."""
    judged = judge(df.select(F.struct("*").alias("document"), "lang", "source", "text"))
    return judged.filter("kept").select("document.*")
