"""A guard for queries that others write: only reading plans over allowed tables, and a fact status always named."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
#: Rows that an answer to a free query has at most.
MOST_ROWS = 200

#: Fixed set of plan nodes that only read.
READING = {"Project", "Filter", "Aggregate", "Join", "Sort", "GlobalLimit", "LocalLimit", "SubqueryAlias", "View", "Distinct", "Union", "WithCTE", "CTERelationDef", "CTERelationRef", "LogicalRelation", "LocalRelation", "LogicalRDD", "Range", "Relation", "RelationV2", "Window", "Intersect", "Except", "Expand", "OneRowRelation", "Offset"}


def check(spark: SparkSession, query: str, tables: set[str]) -> str | None:
    """Why a query may not run, or None. Looks at parsed and analysed plans, never at the text alone."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        parsed = parser.parsePlan(query)
    except Exception:
        return "it can't be parsed"
    named = {t.lower() for t in re.findall(r"UnresolvedRelation \[([\w, ]+)\]", parsed.toString())}
    ctes = {c.lower() for c in re.findall(r"^\s*(?::|\+|-)*\s*CTE \[([^\]]*)\]", parsed.toString(), re.MULTILINE) for c in c.split(", ")}
    if strange := {t.replace(", ", ".") for t in named} - {t.lower() for t in tables} - ctes:
        return f"it reads {', '.join(sorted(strange))}"
    try:
        plan = spark.sql(query)._jdf.queryExecution().analyzed() if _reads(parsed.toString()) else None
    except Exception:
        return "it can't be analysed"
    if plan is None:
        return "it does more than read"
    text = plan.toString()
    nodes = {m for m in re.findall(r"^[\s:+|-]*'?([A-Z]\w+)", text, re.MULTILINE)}
    if odd := nodes - READING:
        return f"it uses {', '.join(sorted(odd))}"
    if "facts" in named and not re.search(r"status#\d+ = (?:un)?confirmed", text):
        return "it counts facts without naming their status"
    return None


def _reads(parsed: str) -> bool:
    first = re.match(r"[\s'+:|-]*([A-Z]\w+)", parsed)
    return bool(first) and not re.search(r"Insert|Delete|Update|Merge|Create|Drop|Alter|Truncate|Set\w*Command|Command|Cache|Refresh|Write", first[1])


def limited(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """df with a limit of `most` rows as its outermost step, unless it has one that is as small."""
    plan = df._jdf.queryExecution().analyzed().toString()
    own = re.match(r"GlobalLimit (\d+)\b", plan)
    return df if own and int(own[1]) <= most else df.limit(most)


def ask(spark: SparkSession, query: str, tables: set[str], most: int = MOST_ROWS) -> DataFrame:
    """The answer to a query that others write, which must only read these tables, at most `most` rows of it."""
    if why := check(spark, query, tables):
        raise PermissionError(why)
    return limited(spark.sql(query), most)


def within(spark: SparkSession, seconds: float, action: Callable[[], T]) -> T:
    """The result of an action, whose jobs are cancelled after so many seconds; then TimeoutError is raised."""
    context, group, late = spark.sparkContext, f"quillstone-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        context.cancelJobGroup(group)

    timer = threading.Timer(seconds, stop)
    context.setJobGroup(group, f"at most {seconds} seconds", interruptOnCancel=True)
    timer.start()
    try:
        return action()
    except Exception as problem:
        if late.is_set():
            raise TimeoutError(f"stopped after {seconds} seconds") from problem
        raise
    finally:
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", None)
