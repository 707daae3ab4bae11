"""What a question asks: its slots as columns, and the first rule that knows it. The patterns are in the questions' language."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import impossible_date

# Words by which questions are known.
LEAVE, DEPLOYED, AWAY = "відпуст", "відрядж", "відсутн|поза частин"
NEGATED = r"(?U)\bн[еі]\b[^.?!]{0,20}?(?:відпуст|відрядж|відсутн)|(?:відпуст|відрядж|відсутн)\w*[^.?!]{0,10}?\bнема\b"
SUBDIVISION = r"(?U)\bрот[а-яіїєґ]*|взвод|батальйон|підрозділ|відділенн|батаре|дивізіон|бригад|\bполк|застав|екіпаж"
NUMBERED = r"(?U)\b(\d)\s*-?\s*(?:[агйїея]{1,2})?\s*(?:мех\w*\s*)?(?:рот[аиуіє]|взвод\w*)"
ORDINALS = {"перш": "1", "друг": "2", "трет": "3", "четверт": "4", "п’ят": "5"}
COUNT_OR_LIST = r"(?U)скільк|кількіст|\bхто\b|список|перелічи|перелік|покажи|відсутн|наявн|склад"
COUNT, LIST = "скільк|кількіст", r"(?U)\bхто\s|список|покажи|перелік"
COMPARED = r"(?U)найбільш|найменш|більше|менше|порівня|котр|яка з|у якій\s+(?:рот|взвод|підрозділ)|разом"
AGGREGATE = "середн|найдовш|найкоротш|сумарн|медіан|максимальн|мінімальн"
NORMATIVE = r"(?U)наказ|норматив|інструкц|положенн|статут|процедур|рапорт|заяв[уи]\b|підстав|за\s+скільки\s+днів|як\s+оформ|що\s+каже|регламент|закон"
CORPUS = r"(?U)\bє\b|[ву]\s+баз|у\s+нас|зберіга|завантаж|корпус"
ENTITLED = r"(?U)надає(?:ться|ть)|поклада(?:ється|ють)|положено|передбачен|має\s+право|скільк\w*\s+(?:дн\w+|годин\w*|діб)[^?.]{0,40}(?:відпустк|відрядж|звільнен)"
ACT = r"(?iU)№\s*\d+\s*(?:-\s*[IVXLC]+\b|/\s*\d{2,4}\b)|НД\s+ТЗІ\s*[\d.\-]+|наказ\w*\s*№\s*\d+\s*від\s*\d"
RECORD, NUMBER = r"(?iU)запис\w*\s*№?\s*(\d{1,6})", (r"(?U)№\s*(\w+)", r"(?iU)документ\w*\s+(\d+)")
GREETING = r"(?iU)^\s*(?:добрий\s+(?:день|ранок|вечір)|доброго\s+дня|привіт|вітаю|дякую)\b.{0,30}$"
CHANGE = r"(?iU)\b(?:видали|зітри|знищ|стерти|очисти|перепиши|drop|delete|truncate|update)\w*"
COMPARE = r"(?iU)порівня\w*|на\s+скільки\s+(?:більше|менше)|різниц\w*\s+між"
DATES = r"\b(\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4})\b"


def dates_in(question: Column) -> Column:
    """The dates that a question names, in its order; those that don't exist are null."""

    def day(s: Column) -> Column:
        p = F.split(s, r"\.")
        dotted = F.concat_ws("-", F.get(p, F.lit(2)), F.lpad(F.get(p, F.lit(1)), 2, "0"), F.lpad(F.get(p, F.lit(0)), 2, "0"))
        return F.when(s.contains("."), dotted).otherwise(s).try_cast("date")

    return F.transform(F.regexp_extract_all(question, F.lit(DATES), F.lit(1)), day)


def state_of(low: Column) -> Column:
    """leave, deployment or absent (either); null if no state is asked about."""
    return F.when(low.rlike(LEAVE) & low.rlike(DEPLOYED), "absent").when(low.rlike(LEAVE), "leave").when(low.rlike(DEPLOYED), "deployment").when(low.rlike(AWAY), "absent")


def number_of(question: Column) -> Column:
    """The number of one of our documents; an act's number is none."""
    found = [F.nullif(F.regexp_extract(question, p, 1), F.lit("")) for p in NUMBER]
    return F.when(~question.rlike(ACT), F.coalesce(*found))


def subdivision_of(low: Column, known: Column) -> Column:
    """(named, pattern): whether a subdivision is named, and the known one (an array of names) that it is; null if unknown."""
    ordinal = F.coalesce(*[F.when(low.rlike(rf"(?U){stem}\w*\s+(?:мех\w*\s+)?рот"), F.lit(n)) for stem, n in ORDINALS.items()])
    digit = F.coalesce(F.nullif(F.regexp_extract(low, NUMBERED, 1), F.lit("")), ordinal)
    by_digit = F.get(F.filter(known, lambda k: F.trim(k).startswith(digit)), F.lit(0))
    by_name = F.get(F.filter(known, lambda k: (F.length(k) >= 4) & low.contains(F.substring(F.lower(k), 1, 6))), F.lit(0))
    every = low.rlike(r"по\s+(?:підрозділ|рот|взвод)")
    named = low.rlike(SUBDIVISION) & (digit.isNotNull() | by_name.isNotNull() | ~every)
    return F.struct(named.alias("named"), F.when(digit.isNotNull(), by_digit).otherwise(by_name).alias("known"))


def routed(question: Column, known: Column) -> Column:
    """(template, state, number, subdivision, date_from, date_to): the first rule that fits, and what the question names.

    Gates come first: a date that doesn't exist, a wish to change data, a greeting. A rule about acts comes before the
    counts of people, and one about a subdivision before those of all. No rule gives no template.
    """
    low = F.lower(question)
    state, number, unit, days = state_of(low), number_of(question), subdivision_of(low, known), dates_in(question)
    record = F.nullif(F.regexp_extract(question, RECORD, 1), F.lit(""))
    has = lambda p: low.rlike(p)
    counted, about_unit = has(COUNT_OR_LIST), has(SUBDIVISION)
    listed = has(LIST) | has(r"(?U)^хто\b")
    rules = [
        ("date_invalid", impossible_date(question)),
        ("change_refused", has(CHANGE)),
        ("smalltalk", question.rlike(GREETING)),
        ("doc_by_record", record.isNotNull()),
        ("doc_by_number", number.isNotNull() & has("документ|наказ|квит|посвідч|№")),
        ("review_queue_count", has("черг|перевірк") & has("скільки|що|яких")),
        ("unconfirmed_count", has(r"не\s?підтвердж")),
        ("normative_list", has("перелічи|перелік|список") & has(NORMATIVE) | has(r"(?U)\bякі\b") & has("документ|акт|наказ|закон") & has(CORPUS)),
        ("documents_count", has(r"скільки\s+документів")),
        (None, has(AGGREGATE)),
        ("comparison", has(COMPARE) & ~about_unit & (F.size(days) >= 2)),
        ("count_not_in_state", state.isNotNull() & has(NEGATED) & counted),
        ("subdivision_breakdown", about_unit & counted & (has(COMPARED) | ~unit["named"])),
        ("subdivision_unknown", about_unit & counted & unit["known"].isNull()),
        ("list_by_state_in_subdivision", about_unit & counted & listed),
        ("count_by_state_in_subdivision", about_unit & counted),
        ("normative_search", has(NORMATIVE) | has(ENTITLED)),
        ("absent_without_docs_impossible", has(r"(?U)\bбез\b\s+(?:документ|наказ|підстав|квитк|посвідч)")),
        ("roster_total", has(r"(?U)особов\w*\s+склад|за\s+штат")),
        ("with_co_travelers", has(r"(?U)супутник|разом\s+з\s+(?:ким|членами)|з\s+родин")),
        ("list_by_state", state.isNotNull() & listed),
        ("count_by_state_period", state.isNotNull() & has(COUNT) & (F.size(days) >= 2)),
        ("count_by_state_on_date", state.isNotNull() & has(COUNT)),
    ]
    template = reduce(lambda rest, rule: F.when(rule[1], F.lit(rule[0])).otherwise(rest), reversed(rules), F.lit(None).cast("string"))
    return F.struct(template.alias("template"), state.alias("state"), F.coalesce(record, number).alias("number"), F.when(unit["named"], unit["known"]).alias("subdivision"), F.get(days, F.lit(0)).alias("date_from"), F.get(days, F.lit(1)).alias("date_to"))


# Words that begin with a capital in questions without being names, and words before a place.
NO_NAMES = ("хто", "що", "де", "скільки", "скільком", "коли", "чи", "покажи", "який", "яка", "які", "розкажи")
BEFORE_PLACE = r"(?U)(?<!\p{L})(?:у|в|до|з|із|під|біля)\s+(\p{Lu}[\p{L}’'-]{2,}(?:\s\p{Lu}[\p{L}’'-]{2,})?)"


def matched_names(questions: DataFrame, key: str, question: str, names: DataFrame) -> DataFrame:
    """(key, name) of questions that name somebody of names (name): a word with a capital that inflects the name.

    An inflected name has the name's stem, all but three letters and five at least, and is at most two letters longer. Words
    meet names by their first four letters. A question that fits several names has none; one that fits none, null.
    """
    words = F.filter(F.regexp_extract_all(question, F.lit(r"(?U)\p{Lu}[\p{L}’'-]{2,}"), F.lit(0)), lambda w: ~F.lower(w).isin(*NO_NAMES))
    asked = questions.select(key, F.explode(F.transform(words, F.lower)).alias("_word")).withColumn("_head", F.substring("_word", 1, 4))
    known = names.select("name").distinct().select("name", F.lower("name").alias("_low"))
    known = known.select("name", F.length("_low").alias("_n"), F.substring("_low", 1, 4).alias("_head"), F.substring(F.col("_low"), F.lit(1), F.greatest(F.lit(5), F.length("_low") - 3)).alias("_stem"))
    met = asked.join(known, "_head").filter(F.startswith("_word", F.col("_stem")) & (F.length("_word") <= F.col("_n") + 2))
    one = met.groupBy(key).agg(F.min("name").alias("name"), F.max("name").alias("_last")).filter("name = _last").drop("_last")
    return questions.select(key).join(one, key, "left")


def matched_places(questions: DataFrame, key: str, question: str, places: DataFrame) -> DataFrame:
    """(key, said, place): what stands where a place would, and the place of places (place) that it inflects; null if unknown.

    Up to three letters of each word differ at the end; words of three letters keep two. The longest place wins.
    """
    said = F.nullif(F.regexp_extract(question, BEFORE_PLACE, 1), F.lit(""))
    asked = questions.select(key, said.alias("said"))
    forms = F.transform(F.split(F.lower("place"), r"\s+"), lambda w: F.concat(F.substring(w, F.lit(1), F.greatest(F.lit(2), F.length(w) - 3)), F.lit(r"\p{L}{0,5}")))
    known = places.select("place").distinct().withColumns({"_form": F.concat(F.lit("^"), F.array_join(forms, r"\s"), F.lit("$")), "_head": F.substring(F.lower("place"), 1, 2)})
    met = asked.withColumn("_head", F.substring(F.lower("said"), 1, 2)).join(known, "_head").filter(F.call_function("rlike", F.lower("said"), F.col("_form")))
    return asked.join(met.groupBy(key).agg(F.max_by("place", F.length("place")).alias("place")), key, "left")
