"""Rule-based quality flags on retail lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.rules import PARSED, tests_on_parsed, with_parsed
from tallyhouse.operators.dedup import later_copies, repeated_keys


def with_reasons(lines: DataFrame) -> DataFrame:
    """Array column ``dq_reasons`` of the per-row rules.

    NULL slots are dropped with ``array_except``, which unlike a lambda stays in generated code.
    """
    labels = F.array(*[F.when(test, F.lit(label)) for label, test in tests_on_parsed().items()])
    reasons = F.array_except(labels, F.array(F.lit(None).cast("string")))
    return with_parsed(lines).withColumn("dq_reasons", reasons).drop(*PARSED)


def repeated_lines(lines: DataFrame, seq: str = "row_seq") -> DataFrame:
    """(invoice, stock code, date) keys that occur more than once, with their first position."""
    return repeated_keys(lines, S.DUPLICATE_KEYS, seq)


def flag_duplicates(lines: DataFrame, seq: str = "row_seq", repeats: DataFrame | None = None) -> DataFrame:
    """Boolean ``is_duplicate``: a later copy of (invoice, stock code, date).

    ``repeats`` passes a staged ``repeated_lines`` in; its known size then lets the lines stay unshuffled.
    """
    return later_copies(lines, S.DUPLICATE_KEYS, seq, "is_duplicate", repeats)


def dq_flag(lines: DataFrame, seq: str = "row_seq", repeats: DataFrame | None = None) -> DataFrame:
    """``dq_issue_flag`` and ``dq_issue_reason`` (NULL when clean) over all seven rules."""
    tests = {**tests_on_parsed(), S.DUPLICATE_ROW: F.col("is_duplicate")}
    why = F.concat_ws(", ", *[F.when(test, F.lit(label)) for label, test in tests.items()])
    flagged = with_parsed(flag_duplicates(lines, seq, repeats)).withColumn("_why", why)
    flag = F.col("_why") != ""
    return flagged.withColumns(
        {"dq_issue_flag": flag, "dq_issue_reason": F.when(flag, F.col("_why"))}
    ).drop(*PARSED, "_why", "is_duplicate")


def dq_issue_list(lines: DataFrame, seq: str = "row_seq") -> DataFrame:
    """Rows that break a per-row rule, with their reasons. Duplicates alone are not listed."""
    return (
        with_reasons(lines)
        .filter(F.size("dq_reasons") > 0)
        .select(
            F.col(seq).alias("row_index"),
            F.coalesce("InvoiceNo", F.lit("nan")).alias("invoice_no"),
            F.coalesce("StockCode", F.lit("nan")).alias("stock_code"),
            F.col("dq_reasons").alias("reasons"),
        )
    )


def dq_rule_breakdown(lines: DataFrame, include_duplicates: bool = False, seq: str = "row_seq") -> DataFrame:
    """Rows per violated rule. Counted in one aggregate rather than by exploding the reasons.

    ``include_duplicates`` adds the duplicate rule, which the plain breakdown leaves out.
    """
    tests = tests_on_parsed()
    if include_duplicates:
        lines = flag_duplicates(lines, seq)
        tests[S.DUPLICATE_ROW] = F.col("is_duplicate")
    counted = with_parsed(lines).agg(*[F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())])
    entries = [
        F.struct(F.lit(label).alias("rule"), F.col(f"c{i}").alias("row_count")) for i, label in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*entries))).filter(F.col("row_count") > 0)


def flagged_rows(lines: DataFrame, seq: str = "row_seq") -> DataFrame:
    """Number of rows that any of the seven rules flags."""
    return dq_flag(lines, seq).agg(F.count_if("dq_issue_flag").alias("flagged_rows"))
