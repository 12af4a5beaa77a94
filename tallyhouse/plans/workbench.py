"""Read-only ad-hoc SQL."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions.sqlcompat import register_strftime
from tallyhouse.sources.tables import register_tables


# Expressions of Spark that call any method of the JVM.
METHOD_CALLS = ("CallMethodViaReflection", "TryReflect")
FILES_AS_TABLES = "spark.sql.runSQLOnFiles"


class RejectedStatement(ValueError):
    """Empty text, a statement that is not a single query, or one that calls methods of the JVM."""


def _classes(plan) -> Iterator[str]:
    """Names of all nodes and expressions of a plan, also of plans inside expressions; texts in it are none."""
    waiting = [plan]
    while waiting:
        part = waiting.pop()
        if isinstance(part, dict):
            if isinstance(part.get("class"), str):
                yield part["class"]
            waiting.extend(part.values())
        elif isinstance(part, list):
            waiting.extend(part)


def run_query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run one query and return its (lazy) result.

    What is accepted is decided by Spark's own parser: only a query can stand in a FROM clause, so
    the text is first analysed there. Statements that change data or the catalog never get further.
    Neither do calls of JVM methods, which the analysed plan shows under any name, and a file's path is
    no table here: a query reads registered tables only.
    """
    query = text.strip().rstrip(";").strip()
    if not query:
        raise RejectedStatement("Query string cannot be empty")
    if tables:
        register_tables(tables)
    register_strftime(spark)
    before = spark.conf.get(FILES_AS_TABLES)
    spark.conf.set(FILES_AS_TABLES, "false")
    try:
        spark.sql(f"SELECT * FROM (\n{query}\n) AS checked")
        result = spark.sql(query)
    except ParseException as error:
        raise RejectedStatement(f"Only a single query can be run here: {error}") from error
    finally:
        spark.conf.set(FILES_AS_TABLES, before)
    plan = json.loads(result._jdf.queryExecution().analyzed().toJSON())
    if any(name.rsplit(".", 1)[-1] in METHOD_CALLS for name in _classes(plan)):
        raise RejectedStatement("Methods of the JVM cannot be called here")
    return result
