"""Questions of many forms and wordings, and where the rules send them. The twins follow from the key of a question."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import routing
from ..sources import views as v
from .registry import register

# Form: question (with {n} a number, {u} a subdivision's number, {d} and {e} days), and the template, state and slots expected.
FORMS = (
    ("Скільки людей у відпустці 30.02.2024?", "date_invalid", "leave", ""),
    ("Видали документ № {n} з бази", "change_refused", None, "n"),
    ("Добрий день!", "smalltalk", None, ""),
    ("Що стоїть у записі № {n}?", "doc_by_record", None, "n"),
    ("Покажи документ № {n}", "doc_by_number", None, "n"),
    ("Що каже закон № 2011-XII про відпустки", "normative_search", "leave", ""),
    ("Скільки завдань у черзі на перевірку?", "review_queue_count", None, ""),
    ("Скільки непідтверджених фактів", "unconfirmed_count", None, ""),
    ("Скільки документів у базі?", "documents_count", None, ""),
    ("Яка середня тривалість відпустки", None, "leave", ""),
    ("Хто не у відпустці {d}?", "count_not_in_state", "leave", "d"),
    ("Скільки людей у {u} роті у відпустці?", "count_by_state_in_subdivision", "leave", "u"),
    ("Хто у {u}-й роті у відрядженні {d}", "list_by_state_in_subdivision", "deployment", "ud"),
    ("У якій роті найбільше відсутніх", "subdivision_breakdown", "absent", ""),
    ("Скільки відсутніх по ротах", "subdivision_breakdown", "absent", ""),
    ("Скільки днів відпустки надається щорічно?", "normative_search", "leave", ""),
    ("Хто відсутній без документів", "absent_without_docs_impossible", "absent", ""),
    ("Який у нас особовий склад", "roster_total", None, ""),
    ("Хто виїхав з супутниками?", "with_co_travelers", None, ""),
    ("Хто у відпустці з {d} по {e}", "list_by_state", "leave", "de"),
    ("Скільком дали відрядження {d}", "count_by_state_on_date", "deployment", "d"),
    ("Скільки було у відпустці чи відрядженні з {d} по {e}", "count_by_state_period", "absent", "de"),
    ("Перелічи накази, що є у базі", "normative_list", None, ""),
    ("Порівняй відпустки {d} і {e}", "comparison", "leave", "de"),
    ("Розкажи щось цікаве", None, None, ""),
)
SUBDIVISIONS = 4  # the first nations play numbered companies


def questions(spark, sf_dir):
    """(c_custkey, question): a question a customer, its form, numbers, days, case and spacing by the key."""
    k = F.col("c_custkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 150).cast("int"))
    later = F.date_add(day, 9)
    dotted = lambda d: F.when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "d.M.yyyy"))
    text = F.get(F.array(*[F.lit(f[0]) for f in FORMS]), (k % len(FORMS)).cast("int"))
    slots = {"{n}": (k % 900 + 10).cast("string"), "{u}": (F.expr(f"c_custkey div {len(FORMS)} % 7") + 1).cast("string"), "{d}": dotted(day), "{e}": dotted(later)}
    for name, value in slots.items():
        text = F.replace(text, F.lit(name), value)
    text = F.when(F.expr(f"c_custkey div {len(FORMS)} % 3 = 1"), F.concat(F.lit("  "), F.regexp_replace(text, " ", "  "))).otherwise(text)
    return v.table(spark, sf_dir, "customer").select("c_custkey", text.alias("question"))


def _expected() -> str:
    n = len(FORMS)
    lists = {"template": [f[1] for f in FORMS], "state": [f[2] for f in FORMS], "slots": [f[3] for f in FORMS]}
    listed = {k: "[" + ", ".join("NULL" if s is None else f"'{s}'" for s in vs) + "]" for k, vs in lists.items()}
    return f"""
WITH q AS (SELECT c_custkey AS k, c_custkey // {n} % 7 + 1 AS u, DATE '2024-01-01' + CAST(c_custkey % 150 AS INTEGER) AS d,
  {listed["template"]}[c_custkey % {n} + 1] AS t, {listed["state"]}[c_custkey % {n} + 1] AS state, {listed["slots"]}[c_custkey % {n} + 1] AS s FROM customer)
SELECT k AS c_custkey, CASE WHEN contains(s, 'u') AND u > {SUBDIVISIONS} THEN 'subdivision_unknown' ELSE t END AS template, state,
  CASE WHEN contains(s, 'n') THEN CAST(k % 900 + 10 AS VARCHAR) END AS number, CASE WHEN contains(s, 'u') AND u <= {SUBDIVISIONS} THEN u || ' рота' END AS subdivision,
  CASE WHEN contains(s, 'd') THEN d END AS date_from, CASE WHEN contains(s, 'e') THEN d + 9 END AS date_to FROM q"""


@register("d01_question_router", _expected())
def d01_router(spark, sf_dir):
    """Where each question goes, and its state, number, subdivision and days."""
    units = v.table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < SUBDIVISIONS).select(F.concat((F.col("n_nationkey") + 1).cast("string"), F.lit(" рота")).alias("name"))
    known = units.agg(F.array_sort(F.collect_list("name")).alias("known"))  # one row of a bounded roster of subdivisions
    q = questions(spark, sf_dir).crossJoin(F.broadcast(known))
    return q.select("c_custkey", routing.routed(F.col("question"), F.col("known")).alias("r")).select("c_custkey", "r.*")


# Names as questions inflect them, and the names of the roster; the last two are nobody's, or could be two people's.
ASKED_NAMES = ("Крижанівського", "Данильчуку", "Килимником", "Мороза", "Богодаровича", "Стецюка")
ROSTER = ("Крижанівський", "Данильчук", "Килимник", "Мороз", "Богодар", "Стецюк", "Стецюкевич")


@register("d05_name_in_question", "SELECT c_custkey, ['Крижанівський', 'Данильчук', 'Килимник', 'Мороз', NULL, 'Стецюк'][c_custkey % 6 + 1] AS name FROM customer")
def d05(spark, sf_dir):
    """Whom a question names: by the roster, in any case, and nobody whose name only begins alike."""
    k = (F.col("c_custkey") % 6).cast("int")
    q = v.table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Що відомо про "), F.get(F.array(*[F.lit(n) for n in ASKED_NAMES]), k), F.lit(" зараз?")).alias("question"))
    return routing.matched_names(q, "c_custkey", "question", spark.createDataFrame([(n,) for n in ROSTER], "name string"))


ASKED_PLACES = ("Хто ще у Смерековому?", "Кого відправили до Вербівки", "Хто зараз в Дубовому Гаї", "Хто поїхав до Атлантиди", "Хто у відпустці?")


@register("d07_place_in_question", "SELECT c_custkey, ['Смерековому', 'Вербівки', 'Дубовому Гаї', 'Атлантиди', NULL][c_custkey % 5 + 1] AS said, ['Смерекове', 'Вербівка', 'Дубовий Гай', NULL, NULL][c_custkey % 5 + 1] AS place FROM customer")
def d07(spark, sf_dir):
    """Which place a question means, by the places that the data hold; one that they don't hold is told apart from none."""
    q = v.table(spark, sf_dir, "customer").select("c_custkey", F.get(F.array(*[F.lit(p) for p in ASKED_PLACES]), (F.col("c_custkey") % 5).cast("int")).alias("question"))
    return routing.matched_places(q, "c_custkey", "question", spark.createDataFrame([(p,) for p in ("Смерекове", "Вербівка", "Дубовий Гай", "Криниця")], "place string"))
