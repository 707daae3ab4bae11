"""Fields and forms: what is printed, how it is read, and whether it is what it should be.

The tables hold no forms, so keys write them; the twins give what follows from the key without reading a text.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import forms as f
from ..functions import text as x
from ..operators import retrieval as r
from ..sources import views as v
from .registry import register
from .scans import HTML
from .texts import LEX


def listed(*values: str | None) -> str:
    """A list for a twin."""
    return "[" + ", ".join("NULL" if s is None else "'" + s.replace("'", "''") + "'" for s in values) + "]"


def chosen(values, by):
    """The value of a list that a key tells."""
    return F.get(F.array(*[F.lit(s) for s in values]), by.cast("int"))


SURNAMES = ("ІВАНЕНКО", "О’ХАРА", "НЕЧУЙ-ЛЕВИЦЬКИЙ", "Д'АРТАНЬЯН", "КОВАЛЬ")


@register("f10_rank_and_name", f"SELECT o_orderkey, CASE WHEN o_orderkey % 19 < 18 THEN {listed(*f.RANKS)}[o_orderkey % 19 + 1] END AS rank, {listed(*SURNAMES)}[o_orderkey % 5 + 1] AS surname, 'Іван Петрович' AS rest FROM orders")
def f10(spark, sf_dir):
    """Rank, surname and the other names from a line of a form, whatever the case of the rank."""
    k = F.col("o_orderkey")
    rank = F.coalesce(chosen(f.RANKS, k % 19), F.lit("водій"))
    said = F.concat(F.when(k % 3 == 0, F.initcap(rank)).when(k % 3 == 1, F.lit("Військовослужбовцю ")).otherwise(""), F.when(k % 3 > 0, rank).otherwise(""), F.lit("  "), chosen(SURNAMES, k % 5), F.lit(" Іван  Петрович"))
    return v.table(spark, sf_dir, "orders").select("o_orderkey", f.rank_and_name(said).alias("p")).select("o_orderkey", "p.*")


WRITTEN = ("ІВАНЕНКО Петро", "нечуй-ЛЕВИЦЬКИЙ іван", "О'ХАРА  мей", "п’ятницька ОЛЕНА-МАРІЯ", "Д’АРТАНЬЯН", "Коваль")
SHOWN = ("Іваненко Петро", "Нечуй-Левицький Іван", "О’Хара Мей", "П’Ятницька Олена-Марія", "Д’Артаньян", "Коваль")


@register("f09_name_case", f"SELECT c_custkey, {listed(*SHOWN)}[c_custkey % 6 + 1] AS shown FROM customer")
def f09(spark, sf_dir):
    return v.table(spark, sf_dir, "customer").select("c_custkey", f.display_name(chosen(WRITTEN, F.col("c_custkey") % 6)).alias("shown"))


@register("f03_date_parts", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 AND 1970 + o_orderkey % 90 BETWEEN 1990 AND 2035 AND (o_orderkey % 4 <> 1 OR 1970 + o_orderkey % 90 >= 2000) THEN try_cast((1970 + o_orderkey % 90) || '-' || lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(o_orderkey % 33 AS VARCHAR), 2, '0') AS DATE) WHEN o_orderkey % 4 = 1 AND 2070 + o_orderkey % 90 BETWEEN 1990 AND 2035 THEN NULL END AS day FROM orders")
def f03(spark, sf_dir):
    """A day from what stands in the three gaps of a form: month by name or number, year of two or four digits."""
    k = F.col("o_orderkey")
    year = (1970 + k % 90).cast("string")
    printed_year = F.when(k % 4 == 1, F.substring(year, 3, 2)).when(k % 4 == 3, "").otherwise(F.concat(year, F.lit(" р.")))
    month = F.when(k % 4 == 0, (k % 12 + 1).cast("string")).otherwise(F.concat(F.lit(" "), chosen(f.MONTHS, k % 12)))
    return v.table(spark, sf_dir, "orders").select("o_orderkey", f.date_of_parts(F.concat(F.lit("« "), (k % 33).cast("string"), F.lit(" »")), month, printed_year).alias("day"))


@register("f41_worded_dates", f"SELECT o_orderkey FROM (SELECT o_orderkey, o_orderkey % 12 + 1 AS m, o_orderkey % 34 AS d, 2000 + o_orderkey % 25 AS y FROM orders) WHERE try_cast(y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) IS NULL")
def f41(spark, sf_dir):
    """Questions with a day that its month doesn't have."""
    k = F.col("o_orderkey")
    question = F.concat(F.lit("хто був відсутній "), (k % 34).cast("string"), F.lit(" "), chosen(f.MONTHS, k % 12), F.lit(" "), (2000 + k % 25).cast("string"), F.lit(" року"))
    return v.table(spark, sf_dir, "orders").filter(f.impossible_worded_date(question)).select("o_orderkey")


@register("f07_attested_numbers", "SELECT o_orderkey, array_to_string(list_sort(list_distinct(CASE WHEN k BETWEEN 1 AND 20 OR k % 10 = 0 THEN [k, o_orderkey % 7 + 300] ELSE [k, k - k % 10, k % 10, o_orderkey % 7 + 300] END)), ',') AS numbers FROM (SELECT o_orderkey, o_orderkey % 100 AS k FROM orders)")
def f07(spark, sf_dir):
    """The numbers that a text attests in digits, words and pairs of words."""
    k = F.col("o_orderkey") % 100
    said = F.when((k < 20), chosen(f.ONES, k)).when(k % 10 == 0, chosen(f.TENS, F.floor(k / 10) - 2)).otherwise(F.concat_ws(" ", chosen(f.TENS, F.floor(k / 10) - 2), chosen(f.ONES, k % 10)))
    text = F.concat(F.lit("Видано "), F.regexp_replace(said, "’", "'"), F.lit(" діб, квиток № "), (F.col("o_orderkey") % 7 + 300).cast("string"), F.lit("."))
    return v.table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(f.attested_numbers(text), lambda n: n.cast("string")), ",").alias("numbers"))


@register("f13_form_coverage", f"""WITH l AS (SELECT DISTINCT page_id, line FROM (SELECT page_id, unnest(list_filter(list_transform(string_split({HTML}, chr(10)), lambda s: trim(regexp_replace(s, '[ \t\r]+', ' ', 'g'))), lambda s: s <> '')) AS line FROM pages)),
printed AS (SELECT line FROM l GROUP BY line HAVING count(*) >= 0.1 * (SELECT count(DISTINCT page_id) FROM l)), n AS (SELECT count(*) AS printed FROM printed)
SELECT page_id, printed, count(p.line) AS found, CASE WHEN printed > 0 THEN round(count(p.line) / printed::DOUBLE, 6) ELSE 0.0 END AS coverage, CASE WHEN printed > 0 THEN count(p.line) / printed::DOUBLE ELSE 0.0 END >= 0.5 AS recognised FROM l LEFT JOIN printed p USING (line) CROSS JOIN n GROUP BY page_id, printed""")
def f13(spark, sf_dir):
    """Which share of the lines that many pages print each page holds."""
    lines = v.table(spark, sf_dir, "pages").select("page_id", F.explode(F.split(x.html_to_lines(F.col("html")), "\n")).alias("line")).filter("line <> ''")
    return f.form_coverage(lines, "page_id")


# Forms with their titles and the phrases printed on them.
TEMPLATES = {
    "leave": ("Відпускний квиток", ("терміном на", "повернутися до частини", "звільнений у відпустку")),
    "deployment": ("Посвідчення про відрядження", ("термін відрядження", "вибув", "прибув")),
    "reference": ("Довідка", ("видана", "для подання")),
}


@register("f15_template_identification", """
WITH k AS (SELECT o_orderkey, o_orderkey % 8 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k IN (0, 1) THEN 'leave' WHEN k = 2 THEN 'deployment' WHEN k = 3 THEN 'reference' WHEN k = 7 THEN 'deployment' END AS template, [11, 6, 9, 7, 0, 7, 4, 11][k + 1] AS score FROM k""")
def f15(spark, sf_dir):
    """The template of a paper by title and anchors: too little, a title alone, or a tie names none."""
    texts = (
        "ВІДПУСКНИЙ КВИТОК\nзвільнений у відпустку терміном на 10 діб, повернутися до частини",
        "звільнений у відпустку терміном на 10 діб, повернутися до  частини",
        "Посвідчення про відрядження, термін відрядження 5 діб, вибув",
        "ДОВІДКА видана солдату",
        "Відпускний квиток згадано тут, без решти",
        "Довідка видана; Посвідчення про відрядження, вибув",
        "вибув і прибув",
        "Посвідчення про відрядження: вибув, прибув, термін відрядження; довідка видана",
    )
    return v.table(spark, sf_dir, "orders").select("o_orderkey", f.identified_template(chosen(texts, F.col("o_orderkey") % 8), TEMPLATES).alias("t")).select("o_orderkey", "t.*")


PRINTED = (None, "____", "не видано", "Пʼєр’s  Place", "інше", "Місто", " – ", "НЕМАЄ")
WANTED = ("Місто", "Місто", "Місто", "п'єр's place", "Місто", None, None, None)


@register("f48_record_check", "SELECT o_orderkey % 16 AS record, check_, count(*) AS n FROM (SELECT o_orderkey, ['blank', 'blank', 'not issued', 'fine', 'diverges', 'surplus', 'fine', 'fine'][o_orderkey % 8 + 1] AS check_ FROM orders) GROUP BY ALL")
def f48(spark, sf_dir):
    """What is wrong with the fields of records: blank, not issued, diverging from the scenario, or surplus."""
    k = F.col("o_orderkey")
    check = f.field_check(chosen(PRINTED, k % 8), chosen(WANTED, k % 8))
    return v.table(spark, sf_dir, "orders").groupBy((k % 16).alias("record"), check.alias("check_")).agg(F.count("*").alias("n"))


@register("t05_document_validity", "SELECT o_orderkey, CASE WHEN said THEN 'superseded' ELSE 'current' END AS validity, CASE WHEN said THEN 'declared' ELSE 'default' END AS source, CASE WHEN said AND o_orderkey % 2 = 0 THEN 'наказу № ' || o_orderkey % 500 END AS note FROM (SELECT o_orderkey, o_orderkey % 3 > 0 AND o_orderkey % 5 < 3 AS said FROM orders)")
def t05(spark, sf_dir):
    """Whether acts say in their head that they no longer hold, and by which act; what stands further down doesn't count."""
    k = F.col("o_orderkey")
    phrase = F.concat(chosen(("Наказ ВТРАТИВ  ЧИННІСТЬ", "Інструкція втратила чинність"), k % 2), F.when(k % 2 == 0, F.concat(F.lit(" на підставі наказу № "), (k % 500).cast("string"))).otherwise(""), F.lit("."))
    text = F.concat(F.repeat(F.lit("Рядок. "), F.when(k % 5 < 3, k % 40).otherwise(k % 40 + 90).cast("int")), F.when(k % 3 > 0, phrase).otherwise("Наказ чинний."), F.lit(" Далі текст."))
    return v.table(spark, sf_dir, "orders").select("o_orderkey", f.validity_of(text).alias("a")).select("o_orderkey", "a.*")


@register("f43_cross_references", "WITH u AS (SELECT conv_id, turn, CAST(length(text) % 4 AS BIGINT) AS refers, length(text) % 3 > 0 AS says FROM conversations) SELECT a.conv_id, a.turn, min(b.turn) AS target FROM u a LEFT JOIN u b ON b.conv_id = a.conv_id AND a.says AND b.turn = a.refers AND b.turn <> a.turn GROUP BY a.conv_id, a.turn")
def f43(spark, sf_dir):
    """The unit of the same document that a unit's words refer to; itself is none."""
    n = F.length("text")
    said = F.when(n % 3 > 0, F.concat(F.lit("діяти згідно з "), F.when(n % 2 == 0, "пунктом ").otherwise("п. "), (n % 4).cast("string"), F.lit(" цього наказу"))).otherwise("без посилань, 3 рази")
    u = v.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode_outer(f.references_in(said)).alias("refers"))
    target = v.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("own"), F.col("turn").alias("target"))
    met = (F.col("conv_id") == F.col("own")) & (F.col("refers") == F.col("target")) & (F.col("turn") != F.col("target"))
    return u.join(target, met, "left").groupBy("conv_id", "turn").agg(F.min("target").alias("target"))


@register("f44_outline", "SELECT c.conv_id, c.turn, c.role, c.turn = q.current AS is_current, CAST(row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn, c.role) AS INTEGER) AS place FROM conversations c JOIN (SELECT conv_id, max(turn) AS current, count(*) FILTER (WHERE role <> 'system') AS n FROM conversations GROUP BY conv_id) q ON q.conv_id = c.conv_id WHERE n >= 2 AND c.role <> 'system'")
def f44(spark, sf_dir):
    """Siblings of the quoted unit, the last here, in order; headings (system turns) are hidden, a single unit has no outline."""
    c = v.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    quoted = c.groupBy("conv_id").agg(F.max("turn").alias("current"), F.count_if(F.col("role") != "system").alias("n")).filter("n >= 2")
    order = Window.partitionBy("conv_id").orderBy("turn", "role")
    return c.filter("role <> 'system'").join(quoted, "conv_id").select("conv_id", "turn", "role", (F.col("turn") == F.col("current")).alias("is_current"), F.row_number().over(order).alias("place"))


KNOWN = f"known AS (SELECT DISTINCT unnest({LEX.format('text')}) AS term FROM documents)"
TALK = f"c AS (SELECT conv_id, min(text) FILTER (WHERE turn = 0) AS q, min(text) FILTER (WHERE turn = 1) AS a FROM conversations GROUP BY conv_id), l AS (SELECT conv_id, {LEX.format('q')} AS q, {LEX.format('a')} AS a FROM c WHERE q IS NOT NULL AND a IS NOT NULL)"


@register("f32_known_question_overlap", f"WITH {KNOWN}, {TALK}, t AS (SELECT conv_id, unnest(q) AS term, a FROM l), k AS (SELECT conv_id, term, list_contains(a, term) AS hit FROM t WHERE term IN (SELECT term FROM known)) SELECT conv_id, round(CASE WHEN count(k.term) = 0 THEN 1.0 ELSE count(*) FILTER (WHERE hit) / count(k.term)::DOUBLE END, 6) AS share FROM l LEFT JOIN k USING (conv_id) GROUP BY conv_id")
def f32(spark, sf_dir):
    """The share of a question's words that the quoted answer holds, words that the corpus doesn't know left aside."""
    turn = lambda n: F.min(F.when(F.col("turn") == n, F.col("text")))
    c = v.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turn(0).alias("q"), turn(1).alias("a")).filter("q is not null and a is not null")
    own = c.select("conv_id", F.explode_outer(F.array_distinct(x.lexemes(F.col("q")))).alias("term"), x.lexemes(F.col("a")).alias("a"))
    asked = own.select("term").filter("term is not null").distinct()
    known = r.inverted_index(v.table(spark, sf_dir, "documents"), "doc_id").select("term").join(asked, "term", "left_semi").distinct().withColumn("known", F.lit(True))
    each = own.join(known, "term", "left").groupBy("conv_id").agg(F.count("known").alias("n"), F.count_if(F.col("known") & F.array_contains("a", F.col("term"))).alias("hits"))
    return each.select("conv_id", F.round(F.when(F.col("n") == 0, 1.0).otherwise(F.col("hits") / F.col("n")), 6).alias("share"))


@register("f34_attested_terms", f"WITH asked AS (SELECT DISTINCT unnest({LEX.format('text')}) AS term FROM conversations WHERE role = 'user'), hits AS (SELECT term, count(*) AS hits FROM (SELECT unnest({LEX.format('text')}) AS term FROM documents) GROUP BY term) SELECT term, hits FROM asked JOIN hits USING (term) WHERE hits <= 5")
def f34(spark, sf_dir):
    """Words of questions that a few documents attest, five at most: those that tell documents apart."""
    asked = v.table(spark, sf_dir, "conversations").filter("role = 'user'").select(F.explode(x.lexemes(F.col("text"))).alias("term")).distinct()
    # counted where the texts are, before they meet: a task holds its distinct terms, not one row for each that a text has
    own = v.table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(x.lexemes(F.col("text")))).alias("term"))
    hits = own.groupBy("term").agg(F.count("*").alias("hits")).filter("hits <= 5")
    return hits.join(asked, "term", "left_semi")


PHRASES = ("Дійсний до", "Терміном на", "Звільнений у відпустку")
INFLECTED = ("дійсні до: 5 травня", "ТЕРМІНОМ НА 10 діб", "Звільнена  у відпустці – Київ", "дійсний документ", "на термін 5 діб")
BARE = ("5 травня", "10 діб", "Київ", "дійсний документ", "на термін 5 діб")


@register("f42_anchor_prefix", f"SELECT o_orderkey, {listed(*BARE)}[o_orderkey % 5 + 1] AS value FROM orders")
def f42(spark, sf_dir):
    """The value behind a printed phrase, whatever its inflection; what isn't the phrase stays."""
    value = chosen(INFLECTED, F.col("o_orderkey") % 5)
    for phrase in PHRASES:
        value = f.without_prefix(value, phrase)
    return v.table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))


@register("f08_dictionary_lookup", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE r_name END AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def f08(spark, sf_dir):
    """The code of a word by a dictionary: as it is, or inflected by up to three letters."""
    aliases = v.table(spark, sf_dir, "nation").join(v.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat("n_name", F.lit("land")).alias("alias"), F.col("r_name").alias("code"))
    tail = chosen(("", "ом", "ами", "ними"), F.col("s_suppkey") % 4)
    said = v.table(spark, sf_dir, "supplier").join(v.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.lit(" "), F.upper("n_name"), F.lit("LAND"), tail).alias("word"))
    return f.looked_up(said, "word", aliases, "s_suppkey")


@register("f49_translation_cache", "SELECT event_type, CASE event_type WHEN 'view' THEN 'Ansicht' WHEN 'click' THEN 'Klick' ELSE upper(event_type) END AS shown, CASE WHEN event_type IN ('view', 'click') THEN 'cache' WHEN length(event_type) > 5 THEN 'model' ELSE 'as it is' END AS source, count(*) AS n FROM (SELECT CASE WHEN length(event_type) > 5 OR event_type IN ('view', 'click') THEN event_type ELSE upper(event_type) END AS shown_, event_type FROM events) GROUP BY event_type")
def f49(spark, sf_dir):
    """Labels in another language: from the cache, from a model (upper case stands in), or as they are."""
    cache = spark.createDataFrame([("de", "view", "Ansicht"), ("de", "click", "Klick"), ("fr", "view", "Vue")], "lang string, text string, shown string")
    labels = v.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    out = f.translated(labels, "event_type", cache, "de", F.when(F.length("event_type") > 5, F.upper("event_type")))
    return out.select("event_type", F.when(F.col("source") == "as it is", F.upper("shown")).otherwise(F.col("shown")).alias("shown"), "source", "n")


ANSWERS = ("Іван Коваль", "1.5.2024", "10", "Київ", "12 xx", "скасувати")


@register("f45_form_dialogue", f"""
WITH RECURSIVE t AS (SELECT o_custkey AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, CAST(CASE o_orderkey % 16 WHEN 15 THEN 5 WHEN 14 THEN 4 ELSE o_orderkey % 4 END AS INTEGER) AS a FROM orders),
s AS (SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, 0 AS step, 0 AS rejected, '' AS filled FROM t
  UNION ALL SELECT s.c, t.i, CASE WHEN a = 5 THEN 0 WHEN step < 4 AND (a = step OR (step IN (0, 3) AND a IN (0, 3))) THEN step + 1 ELSE step END, CASE WHEN a = 5 THEN 0 WHEN step < 4 AND NOT (a = step OR (step IN (0, 3) AND a IN (0, 3))) THEN rejected + 1 ELSE rejected END,
    CASE WHEN a = 5 THEN '' WHEN step < 4 AND (a = step OR (step IN (0, 3) AND a IN (0, 3))) THEN filled || CASE WHEN step > 0 THEN '|' ELSE '' END || {listed(*ANSWERS)}[a + 1] ELSE filled END FROM s JOIN t ON t.c = s.c AND t.i = s.i + 1)
SELECT c AS o_custkey, step, ['person', 'start', 'days', 'place'][step + 1] AS asks, rejected, filled FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY i DESC) AS r FROM s) WHERE r = 1""")
def f45(spark, sf_dir):
    """Where each customer's form dialogue stands after all their answers, of which some don't fit and some begin anew."""
    k = F.col("o_orderkey")
    at = F.when(k % 16 == 15, 5).when(k % 16 == 14, 4).otherwise(k % 4)
    turns = v.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.concat(F.lit(" "), chosen(ANSWERS, at)).alias("said"))
    return f.form_dialogue(turns, ["o_custkey"], ["o_orderkey"], "said")
