"""SQL functions that let month-key queries written for other databases run unchanged."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Directive -> expression over ``moment``; the first six are also plain letters of date_format.
LETTERS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}
DIRECTIVES = {d: f"date_format(moment, '{letters}')" for d, letters in LETTERS.items()} | {
    "%f": "date_format(moment, 'ss.SSS')",
    "%j": "date_format(moment, 'DDD')",
    "%s": "CAST(unix_seconds(moment) AS STRING)",
    "%w": "CAST(dayofweek(moment) - 1 AS STRING)",
    "%W": "lpad(CAST((dayofyear(moment) + 6 - weekday(moment)) DIV 7 AS STRING), 2, '0')",
    "%%": "'%'",
}


def register_strftime(spark: SparkSession) -> None:
    """Define ``strftime(format, moment)`` for the session, with the directives above.

    Formats of the six common directives without letters in between become one ``date_format``. Others are
    put together part by part, so that text between directives stays as it is. A directive that is not
    known raises; a missing format or moment gives NULL.
    """
    plain = "fmt"
    for directive, letters in LETTERS.items():
        plain = f"replace({plain}, '{directive}', '{letters}')"
    cases = " ".join(f"WHEN '{d}' THEN {made}" for d, made in DIRECTIVES.items())
    unknown = "WHEN startswith(part, '%') THEN CAST(raise_error(concat('unknown directive ', part)) AS STRING)"
    parts = "regexp_extract_all(fmt, '(?s)%.|%$|[^%]+', 0)"
    each = f"transform({parts}, part -> CASE WHEN false THEN '' {cases.replace('WHEN ', 'WHEN part = ')} {unknown} ELSE part END)"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION strftime(fmt STRING, moment TIMESTAMP) RETURNS STRING RETURN CASE "
        f"WHEN fmt RLIKE '^(%[YmdHMS]|[ 0-9:./_-])*$' THEN date_format(moment, {plain}) "
        f"WHEN moment IS NOT NULL THEN array_join({each}, '') END"
    )
