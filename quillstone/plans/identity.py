"""Identity of acts: what a text says it is, canonical identifiers, and identifiers that questions name.

The tables hold no acts, so orders write them: the key tells the form, the numbers and the spelling, and the twins give
what follows from the key without reading a text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identity as i
from ..sources import views as v
from .registry import register

FORMS = 7
NUMBER, YEAR = "(o_orderkey % 897 + 100)", "(o_orderkey % 30 + 1990)"
ROMANS = ("XII", "XIV", "IV", "V")


def _key():
    k, n, y = F.col("o_orderkey"), F.expr(NUMBER).cast("string"), F.expr(YEAR).cast("string")
    session = F.get(F.array(*[F.lit(r) for r in ROMANS]), (k % 4).cast("int"))
    return k, n, y, session


def written_identifier():
    """An identifier of a form and a spelling that depend on the key: Latin for Cyrillic letters, long dashes, spaces."""
    k, n, y, session = _key()
    odd = F.expr("o_orderkey div 7 % 3")
    dash = F.when(odd == 1, " – ").when(odd == 2, "—").otherwise("-")
    form = k % FORMS
    return (
        F.when(form == 0, F.concat(F.when(odd == 1, "НД ТЗI ").when(odd == 2, "").otherwise("НД ТЗІ "), F.lit("2.5"), dash, n, dash, F.substring(y, 3, 2)))
        .when(form == 1, F.concat(F.lit("ВВР "), y, F.lit(", № "), (k % 40 + 1).cast("string"), F.when(odd == 1, ",  ст ").otherwise(", ст. "), n))
        .when(form == 2, F.concat(F.lit("№ "), n, F.lit("/"), F.substring(y, 3, 2), dash, F.when(odd == 1, "BP").otherwise("ВР")))
        .when(form == 3, F.concat(F.when(odd == 2, "закон ").otherwise("№ "), n, dash, F.when(odd == 1, F.translate(session, "XI", "ХІ")).otherwise(session)))
        .when(form == 4, F.concat(n, F.when(odd == 1, " / ").otherwise("/"), y))
        .when(form == 5, F.concat(F.when(odd == 1, "Наказ № ").when(odd == 2, "наказу ").otherwise("наказ №"), n, F.when(odd == 1, F.concat(F.lit(" від 14.08."), y)).otherwise("")))
        .otherwise("без номера")
    )


CANONICAL = f"""CASE o_orderkey % 7
  WHEN 0 THEN 'standard:2.5-' || {NUMBER} || '-' || right(CAST({YEAR} AS VARCHAR), 2)
  WHEN 1 THEN 'gazette:' || {YEAR} || ':' || (o_orderkey % 40 + 1) || ':' || {NUMBER}
  WHEN 2 THEN 'old law:' || {NUMBER} || ':' || right(CAST({YEAR} AS VARCHAR), 2)
  WHEN 3 THEN 'law:' || {NUMBER} || ':' || ['xii', 'xiv', 'iv', 'v'][o_orderkey % 4 + 1]
  WHEN 4 THEN 'decree:' || {NUMBER} || ':' || {YEAR} WHEN 5 THEN 'order:' || {NUMBER} END"""


@register("e04_identifier_forms", f"SELECT o_orderkey, {CANONICAL} AS identifier FROM orders")
def e04_forms(spark, sf_dir):
    return v.table(spark, sf_dir, "orders").select("o_orderkey", i.canonical(written_identifier()).alias("identifier"))


@register("e05_identifier_resolver", f"""
WITH asked AS (SELECT o_orderkey, {CANONICAL} AS identifier FROM orders),
known AS (SELECT identifier, min(o_orderkey) AS document FROM asked JOIN (SELECT DISTINCT source_doc FROM (SELECT o_orderkey AS source_doc FROM orders WHERE o_orderpriority = '1-URGENT')) ON source_doc = o_orderkey WHERE identifier IS NOT NULL GROUP BY identifier)
SELECT o_orderkey, CASE WHEN a.identifier IS NULL OR o_orderkey % 7 = 1 THEN 'none' WHEN document IS NULL THEN 'absent' ELSE 'resolved' END AS status, CASE WHEN o_orderkey % 7 <> 1 THEN document END AS document,
  CASE WHEN o_orderkey % 7 = 5 AND o_orderkey // 7 % 3 = 1 THEN 'що каже від 14.08.' || {YEAR} || ' про відпустки' WHEN o_orderkey % 7 = 6 THEN 'що каже без номера про відпустки' WHEN o_orderkey % 7 = 1 THEN NULL ELSE 'що каже про відпустки' END AS rest FROM asked a LEFT JOIN known k ON k.identifier = a.identifier""")
def e05_resolver(spark, sf_dir):
    """What each question about an act comes to: none, resolved or absent; the act; and what else it asks.

    Urgent orders are the acts at hand. A gazette reference is no number that questions are recognised by.
    """
    o = v.spread(v.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey").select("o_orderkey", "o_orderpriority", written_identifier().alias("said"))
    acts = o.filter("o_orderpriority = '1-URGENT'").select(i.canonical(F.col("said")).alias("identifier"), "o_orderkey")
    known = acts.filter("identifier is not null").groupBy("identifier").agg(F.min("o_orderkey").alias("document"))
    q = o.withColumn("question", F.concat(F.lit("що каже "), "said", F.lit(" про відпустки")))
    gazette = F.col("o_orderkey") % FORMS == 1
    asked = q.select("o_orderkey", F.when(~gazette, F.get(i.identifiers_in(F.col("question")), F.lit(0))).alias("identifier"), F.when(~gazette, i.without_identifiers(F.col("question"))).alias("rest"))
    out = asked.join(known, "identifier", "left")
    status = F.when(F.col("identifier").isNull(), "none").when(F.col("document").isNull(), "absent").otherwise("resolved")
    return out.select("o_orderkey", status.alias("status"), "document", "rest")


def written_act():
    """The text of an act whose form, numbers and day depend on the key."""
    k, n, y, session = _key()
    form, month = k % FORMS, F.get(F.array(*[F.lit(m) for m in i.MONTHS]), (k % 12).cast("int"))
    day, filler = (k % 28 + 1).cast("string"), F.repeat(F.lit("рядок тексту за № 77 "), (k % 300).cast("int"))
    signed = F.concat(filler, F.lit("\nм. Київ "), day, F.lit(" "), month, F.lit(" "), y, F.lit(" року № "), n, F.lit("-"), session)
    dotted = F.concat(F.lpad(day, 2, "0"), F.lit("."), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("."), y)
    note = F.when(k % 2 == 0, F.lit("{Із змінами згідно з НАКАЗ № 5} ")).otherwise("")
    return (
        F.when(form == 0, F.concat(F.lit("НОРМАТИВНИЙ ДОКУМЕНТ\nСИСТЕМИ ТЕХНІЧНОГО ЗАХИСТУ ІНФОРМАЦІЇ\nПорядок робіт з вимог НД ТЗІ 1.1-001-99\nНД ТЗІ 2.5-"), n, F.lit("-"), F.substring(y, 3, 2), F.lit("\nДСТСЗІ\nКиїв "), y, F.lit("\n"), filler))
        .when(form == 1, F.concat(note, F.lit("З А К О Н У К Р А Ї Н И\nПро відпустки працівників\n(Відомості Верховної Ради України (ВВР), "), y, F.lit(", № 2, ст. "), n, F.lit(")\n"), F.when(k % 3 > 0, signed).otherwise(filler)))
        .when(form == 2, F.concat(note, F.lit("НАКАЗ\n"), dotted, F.lit(" м. КИЇВ № "), n, F.lit("\nЗареєстровано 13 грудня за № 1502/31370\nПро облік особового складу\nВідповідно до закону наказую "), filler))
        .when(form == 3, F.concat(F.lit("УКАЗ Президента України\nПро відзначення державними нагородами\nЗ метою "), filler, F.lit("\nПрезидент України І. Особа\n№ "), n, F.lit("/"), y))
        .when(form == 4, F.concat(F.lit("ЗАТВЕРДЖЕНО Наказ Головнокомандувача\nЗбройних Сил "), day, F.lit(" "), month, F.lit(" "), y, F.lit(" № "), n, F.lit("\nІНСТРУКЦІЯ з діловодства у частинах\n1. Загальні положення "), filler))
        .when(form == 5, F.concat(F.lit("Деякі питання обліку майна. Цей Закон "), F.when(k % 3 > 0, signed).otherwise(filler)))
        .otherwise(F.concat(F.lit("Звичайний лист без назви "), filler))
    )


@register("e07_document_identity", f"""
WITH o AS (SELECT o_orderkey, o_orderkey % 7 AS form, CAST({NUMBER} AS VARCHAR) AS n, CAST({YEAR} AS VARCHAR) AS y, ['XII', 'XIV', 'IV', 'V'][o_orderkey % 4 + 1] AS session, o_orderkey % 3 > 0 AS signed,
  CAST(o_orderkey % 28 + 1 AS VARCHAR) AS day, lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') AS month FROM orders)
SELECT o_orderkey, ['standard', 'law', 'order', 'decree', 'approved', 'untitled', NULL][form + 1] AS kind,
  CASE form WHEN 0 THEN 'НД ТЗІ 2.5-' || n || '-' || right(y, 2) WHEN 1 THEN CASE WHEN signed THEN '№ ' || n || '-' || session ELSE 'ВВР ' || y || ' № 2 ст.' || n END
    WHEN 2 THEN 'наказ № ' || n || ' від ' || lpad(day, 2, '0') || '.' || month || '.' || y WHEN 3 THEN '№ ' || n || '/' || y
    WHEN 4 THEN 'наказ № ' || n || ' від ' || y || '-' || month || '-' || lpad(day, 2, '0') WHEN 5 THEN CASE WHEN signed THEN '№ ' || n || '-' || session END END AS identifier,
  ['Порядок робіт з вимог НД ТЗІ 1.1-001-99', 'Про відпустки працівників', 'Про облік особового складу', 'Про відзначення державними нагородами', 'ІНСТРУКЦІЯ з діловодства у частинах', 'Деякі питання обліку майна', NULL][form + 1] AS title,
  CASE WHEN form = 0 THEN y || '-01-01' WHEN form IN (2, 4) OR (form IN (1, 5) AND signed) THEN y || '-' || month || '-' || lpad(day, 2, '0') END AS issued,
  CASE form WHEN 0 THEN 0.95 WHEN 1 THEN CASE WHEN signed THEN 0.9 ELSE 0.85 END WHEN 2 THEN 0.9 WHEN 3 THEN 0.8 WHEN 4 THEN 0.8 WHEN 5 THEN CASE WHEN signed THEN 0.75 ELSE 0.45 END ELSE 0.0 END::DOUBLE AS confidence FROM o""")
def e07(spark, sf_dir):
    return v.spread(v.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", written_act().alias("text")).transform(i.identified, "text").select("o_orderkey", "identity.*")


@register("e06_identity_source", f"""
WITH o AS (SELECT o_orderkey AS k, CAST({NUMBER} AS VARCHAR) AS n, CAST({YEAR} AS VARCHAR) AS y, o_orderkey % 7 AS form, o_orderkey // 7 % 4 AS file, ['XII', 'XIV', 'IV', 'V'][o_orderkey % 4 + 1] AS session FROM orders)
SELECT k AS o_orderkey, CASE file WHEN 0 THEN 'наказ № ' || n || ' від 01.02.' || y WHEN 1 THEN '№ ' || n || '-' || session WHEN 2 THEN 'наказ № ' || n ELSE CASE WHEN form = 2 THEN 'наказ № ' || n || ' від ' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || '.' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || '.' || y END END AS identifier,
  CASE WHEN file < 3 THEN 'file name' WHEN form = 2 THEN 'text' END AS source, CASE WHEN file < 3 THEN 0.95 WHEN form = 2 THEN 0.9 ELSE 0.0 END::DOUBLE AS confidence FROM o""")
def e06(spark, sf_dir):
    """An act's identity by its file's name, else by its text."""
    k, n, y, session = _key()
    file = F.expr("o_orderkey div 7 % 4")
    name = F.when(file == 0, F.concat(F.lit("Наказ_№_"), n, F.lit("_від_01.02."), y, F.lit(".docx"))).when(file == 1, F.concat(F.lit("закон "), n, F.lit("-"), session, F.lit(".pdf"))).when(file == 2, F.concat(F.lit("наказ-"), n, F.lit(".PDF"))).otherwise("scan_0001.pdf")
    o = v.spread(v.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", name.alias("file"), F.when(k % FORMS == 2, written_act()).otherwise("лист без номера").alias("text"))
    out = o.transform(i.identified, "text").select("o_orderkey", i.named_by_file(F.col("file"), F.col("text"), F.col("identity")).alias("a"))
    return out.select("o_orderkey", "a.*")


@register("f14_acts_first", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1, 2, 3, 4) THEN 'procedural' WHEN o_orderkey % 7 = 5 AND o_orderkey % 2 = 0 THEN 'procedural' WHEN o_orderkey % 7 = 5 THEN 'leave' WHEN o_orderkey % 2 = 0 THEN 'deployment' END AS domain FROM orders")
def f14(spark, sf_dir):
    """The domain of a paper: an act before all else; then the words of leave and deployment papers, where one kind leads."""
    k = F.col("o_orderkey")
    form = k % FORMS
    text = F.when(form < 5, written_act()).when((form == 5) & (k % 2 == 0), "Про відпустки. Цей закон набирає чинності з дня підписання.").when(form == 5, "Квиток: солдат іде у відпустку, повернутися з відпустки; відрядження немає").when(k % 2 == 0, "Посвідчення про відрядження: термін відрядження, відрядити").otherwise("Лист: відпустка, відрядження")
    low = F.lower(F.col("text"))
    count = lambda w: (F.length(low) - F.length(F.replace(low, F.lit(w), F.lit("")))) / len(w)
    leave, away = count("відпуст"), count("відряд")
    domain = F.when(i.is_act(F.col("text")), "procedural").when(leave > away, "leave").when(away > leave, "deployment")
    return v.spread(v.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", text.alias("text")).select("o_orderkey", domain.alias("domain"))
