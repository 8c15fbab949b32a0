"""Read-only SQL: the parsed plan is checked, not the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException, ParseException

REFUSED = "Only read-only queries are allowed."
FETCHED, SHOWN = 50, 20


class NotReadOnly(ValueError):
    pass


def _nodes(plan):
    yield plan
    for group in (plan.children(), plan.innerChildren()):
        for i in range(group.size()):
            node = group.apply(i)
            if hasattr(node, "innerChildren"):
                yield from _nodes(node)


def is_read_only(spark: SparkSession, sql: str) -> bool:
    """Whether ``sql`` is one query or SHOW statement, with no command or insert anywhere in its plan."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    for node in _nodes(plan):
        name = node.getClass().getSimpleName()
        if name.startswith("Show"):
            continue
        if "Insert" in name or name.startswith(("Create", "Replace", "Drop", "Alter", "Merge", "Delete", "Update", "Truncate", "Set", "Cache", "Uncache", "Refresh", "Add", "Use", "Call")):
            return False
        if spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command").isInstance(node):
            return False
    return True


def read_only(spark: SparkSession, sql: str) -> DataFrame:
    if not is_read_only(spark, sql):
        raise NotReadOnly(REFUSED)
    return spark.sql(sql)


def run_sql(spark: SparkSession, sql: str) -> str:
    """Up to 20 rows as text, one a line; errors and refusals as a message."""
    try:
        rows = read_only(spark, sql).limit(FETCHED).collect()
    except NotReadOnly as e:
        return str(e)
    except (AnalysisException, ParseException) as e:
        return f"SQL error: {str(e).splitlines()[0]}"
    return "\n".join(str(r.asDict()) for r in rows[:SHOWN]) if rows else "No results."
