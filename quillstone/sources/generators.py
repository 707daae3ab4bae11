"""Made-up rosters and papers for tests: everything follows from a row's number and a seed, so reruns agree.

Names, places and units are invented; rows are made by the executors, so any number of them can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.forms import MONTHS, RANKS

# What made-up people are called and where they are.
LAST = "Яремків Килимник Данильчук Гайдабура Стецюк Мороз Левадний Чубко Рибалка Тихий".split()
FIRST = "Іван Петро Остап Назар Марко Лесь Тарас Гнат Юрко Олекса".split()
FATHER = "Іванович Петрович Остапович Назарович Маркович Тарасович Гнатович Юрійович".split()
UNITS, UNIT_SHARES = ("управління", "1 рота", "2 рота", "3 рота", "взвод забезпечення"), (15, 90, 90, 90, 15)
TOWNS = "Смерекове Вербівка Криниця Дубова Гай Озеряни Заставне".split()
POSTS = "стрілець водій кулеметник санітар зв’язківець сапер кухар".split()
ROSTER = """service_id rank last_name first_name patronymic full_name gender position_index position_title subdivision position_assigned_date
arrived_from enrollment_date enrollment_order_date enrollment_order_number appointment_order_date appointment_order_issuer appointment_order_number
rank_order_date rank_order_issuer rank_order_number service_type contract_start_date contract_end_date conscription_period rnokpp id_document_type
id_document_series id_document_number birth_date birth_place service_entry_date service_entry_authority education relatives_info additional_info phone""".split()


def _drawn(n: int, what: str, seed: int) -> Column:
    """A number below n for a row and a purpose."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "id"), F.lit(n)).cast("int")


def _of(values, what: str, seed: int) -> Column:
    return F.get(F.array(*[F.lit(x) for x in values]), _drawn(len(values), what, seed))


def roster(spark: SparkSession, people: int = 300, seed: int = 42) -> DataFrame:
    """People with all 37 columns of a unit's roster, as strings: dates are ISO and in the order of a career."""
    total = sum(UNIT_SHARES)
    place = F.expr(f"id % {total}")
    unit = None
    for name, upto in reversed([(u, sum(UNIT_SHARES[: i + 1])) for i, u in enumerate(UNITS)]):
        unit = F.lit(name) if unit is None else F.when(place < upto, name).otherwise(unit)
    day = lambda start, span, what: F.date_add(F.to_date(F.lit(start)), _drawn(span, what, seed))
    r = spark.range(people).withColumns({"birth": day("1975-01-01", 9000, "birth"), "kin": _of(FIRST, "kin", seed)})
    r = r.withColumn("entry", F.date_add("birth", 6600 + _drawn(1500, "entry", seed)))
    r = r.withColumn("enrolled", F.date_add("entry", 10 + _drawn(900, "enrolled", seed)))
    r = r.withColumn("assigned", F.date_add("enrolled", _drawn(300, "assigned", seed)))
    contract = _drawn(3, "service", seed) > 0
    number = lambda n, what: (_drawn(n, what, seed) + 1).cast("string")
    digits = lambda k, what: F.lpad(_drawn(10**k, what, seed).cast("string"), k, "0")
    r = r.withColumns({"last_name": _of(LAST, "last", seed), "first_name": _of(FIRST, "first", seed), "patronymic": _of(FATHER, "father", seed)})
    columns = {
        "service_id": F.format_string("UNIT-%04d", F.col("id") + 1), "rank": _of(RANKS, "rank", seed), "full_name": F.concat_ws(" ", "last_name", "first_name", "patronymic"), "gender": F.lit("ч"),
        "position_index": (place + 1).cast("string"), "position_title": _of(POSTS, "post", seed), "subdivision": unit, "position_assigned_date": F.col("assigned"), "arrived_from": _of(TOWNS, "from", seed),
        "enrollment_date": F.col("enrolled"), "enrollment_order_date": F.date_sub("enrolled", 1), "enrollment_order_number": number(400, "order"), "appointment_order_date": F.date_sub("assigned", 1),
        "appointment_order_issuer": F.lit("командир частини"), "appointment_order_number": number(400, "appointment"), "rank_order_date": F.date_add("enrolled", _drawn(200, "ranked", seed)), "rank_order_issuer": F.lit("командир частини"),
        "rank_order_number": number(400, "rank order"), "service_type": F.when(contract, "за контрактом").otherwise("за призовом"), "contract_start_date": F.when(contract, F.col("enrolled")), "contract_end_date": F.when(contract, F.add_months("enrolled", 36)),
        "conscription_period": F.when(~contract, F.concat(F.year("enrolled").cast("string"), F.lit(" р."))), "rnokpp": digits(9, "tax"), "id_document_type": F.lit("паспорт"), "id_document_series": _of(("АА", "ВК", "СН"), "series", seed),
        "id_document_number": digits(6, "passport"), "birth_date": F.col("birth"), "birth_place": _of(TOWNS, "born", seed), "service_entry_date": F.col("entry"), "service_entry_authority": F.concat(_of(TOWNS, "board", seed), F.lit(" районний центр")),
        "education": _of(("середня", "професійна", "вища"), "education", seed), "relatives_info": F.concat(F.lit("брат "), "kin"), "additional_info": F.lit(None), "phone": F.concat(F.lit("+000"), digits(9, "phone")),
    }
    out = r.select("id", *[columns.get(n, F.col(n) if n in r.columns else None).cast("string").alias(n) for n in ROSTER])
    return out.drop("id")


def papers(people: DataFrame, seed: int = 42) -> DataFrame:
    """A leave paper or a travel paper for each of a roster, with its truth: kind, number, rank, full_name, start, days, place, text."""
    p = people.withColumn("id", F.xxhash64("service_id"))
    start = F.date_add(F.to_date(F.lit("2024-01-01")), _drawn(300, "start", seed))
    p = p.select("*", F.when(_drawn(2, "kind", seed) == 0, "leave").otherwise("deployment").alias("kind"), (_drawn(900, "number", seed) + 100).alias("number"), start.alias("start"), (_drawn(30, "days", seed) + 1).alias("days"), _of(TOWNS, "place", seed).alias("place"))
    named = F.concat_ws(" ", "rank", F.upper("last_name"), "first_name", "patronymic")
    day = F.concat(F.dayofmonth("start").cast("string"), F.lit(" "), F.get(F.array(*[F.lit(m) for m in MONTHS]), F.month("start") - 1), F.lit(" "), F.year("start").cast("string"), F.lit(" року"))
    leave = F.concat(F.lit("ВІДПУСКНИЙ КВИТОК № "), F.col("number").cast("string"), F.lit("\n"), named, F.lit("\nзвільнений у відпустку терміном на "), F.col("days").cast("string"), F.lit(" діб з "), day, F.lit("\nдо населеного пункту "), "place", F.lit("\nповернутися до частини"))
    travel = F.concat(F.lit("ПОСВІДЧЕННЯ ПРО ВІДРЯДЖЕННЯ № "), F.col("number").cast("string"), F.lit("\n"), named, F.lit("\nдо пункту "), "place", F.lit("\nтермін відрядження "), F.col("days").cast("string"), F.lit(" діб з "), day, F.lit("\nвибув ____ прибув ____"))
    return p.select("service_id", "kind", "number", "rank", "full_name", "last_name", "start", "days", "place", F.when(F.col("kind") == "leave", leave).otherwise(travel).alias("text"))
