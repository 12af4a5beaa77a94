"""From raw scores to labels, and the sections of the anomaly report.

Raw scores follow one convention: the lower, the more anomalous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import percent, round_half_up, safe_ratio
from tallyhouse.functions.segments import score_band, system_status
from tallyhouse.functions.text import contains_ignoring_case
from tallyhouse.operators.quantiles import quantiles

BINS = 10


def threshold(scored: DataFrame, contamination: float, score: str = "raw_score", **options: int) -> float | None:
    """Score below which a row counts as anomalous: the contamination quantile of all scores."""
    if not 0.0 < contamination <= 0.5:
        raise ValueError("contamination must lie in (0, 0.5]")
    return quantiles(scored, [score], [contamination], **options)[score][0]


def predict(scored: DataFrame, cut: float | None, score: str = "raw_score") -> DataFrame:
    """``ml_anomaly_pred``: -1 strictly below the cut, else 1 (so ties stay normal)."""
    return scored.withColumn("ml_anomaly_pred", F.when(F.col(score) < F.lit(cut), -1).otherwise(1))


def normalize_scores(scored: DataFrame, score: str = "raw_score") -> DataFrame:
    """``severity`` in [0, 1], 1 the worst, and ``ml_anomaly_score``, the same to four decimals.

    All scores equal gives 0 throughout. The extremes come from one scalar subquery.
    """
    ends = scored.agg(F.struct(F.min(score).alias("low"), F.max(score).alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    severity = F.coalesce(safe_ratio(high - F.col(score), high - low), F.lit(0.0))
    return scored.withColumn("severity", severity).withColumn(
        "ml_anomaly_score", round_half_up(F.col("severity"), 4)
    )


def classify(scored: DataFrame) -> DataFrame:
    """``ml_anomaly_label`` from the prediction alone, ``system_status`` with rules first."""
    prediction = F.col("ml_anomaly_pred")
    return scored.withColumns(
        {
            "ml_anomaly_label": F.when(prediction == -1, S.LABEL_ANOMALY).otherwise(S.LABEL_NORMAL),
            "system_status": system_status(F.col("dq_issue_flag"), prediction),
        }
    )


# --- report sections --------------------------------------------------------------------------
def kpi_summary(classified: DataFrame) -> DataFrame:
    """Headline counts, anomaly share and mean severity, one row from one aggregate."""
    anomalous = F.col("ml_anomaly_pred") == -1
    total = F.count(F.lit(1))
    # Severities are added up as exact decimals, so the mean does not depend on row order.
    mean = safe_ratio(F.sum(F.col("severity").cast("decimal(18,12)")), total)
    return classified.agg(
        total.alias("total_transactions"),
        F.count_if(anomalous).alias("ml_anomalies_count"),
        F.count_if(~anomalous).alias("normal_transactions_count"),
        F.coalesce(percent(F.count_if(anomalous), total), F.lit(0.0)).alias("anomaly_percentage"),
        F.count_if("dq_issue_flag").alias("rule_based_dq_issues_count"),
        round_half_up(mean, 4).alias("average_anomaly_score"),
    )


def score_histogram(classified: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal bins on [0, 1], the last one closed; empty bins are kept."""
    index = F.least(F.floor(F.col("severity") * bins), F.lit(bins - 1)).cast("bigint")
    counts = classified.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = classified.sparkSession.range(bins).withColumnRenamed("id", "bin")
    end = F.round((F.col("bin") + 1) / float(bins), 2)
    return (
        every.join(counts, "bin", "left")
        .select(
            F.round(F.col("bin") / float(bins), 2).alias("bin_start"),
            end.alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("count"),
            (end > S.FLAGGED_BIN_END).alias("flagged"),
        )
        .orderBy("bin_start")
    )


def _top_anomalies(classified: DataFrame, keys: list[str], k: int) -> DataFrame:
    known = [F.col(c).isNotNull() for c in keys]
    rows = classified.filter(F.col("system_status") == S.STATUS_ANOMALY)
    for test in known:
        rows = rows.filter(test)
    counts = rows.groupBy(*keys).agg(F.count("InvoiceNo").alias("anomaly_count"))
    return counts.orderBy(F.desc("anomaly_count"), *keys).limit(k)


def anomalies_by_country(classified: DataFrame, k: int = 10) -> DataFrame:
    """Model anomalies per country as written in the data, the k most frequent."""
    return _top_anomalies(classified, ["Country"], k)


def anomalies_by_product(classified: DataFrame, k: int = 10) -> DataFrame:
    return _top_anomalies(classified, ["StockCode", "Description"], k)


def suspicious_view(classified: DataFrame, seq: str = "row_seq") -> DataFrame:
    """The thirteen reported fields of every scored line."""
    text = lambda c: F.coalesce(c, F.lit("nan"))
    return classified.select(
        F.col(seq).alias("transaction_index"),
        text("InvoiceNo").alias("invoice_no"),
        text("StockCode").alias("stock_code"),
        text("Description").alias("description"),
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
        round_half_up(F.col("TotalAmount")).alias("total_amount"),
        F.coalesce("CustomerID", F.lit(S.GUEST)).alias("customer_id"),
        text("Country").alias("country"),
        "system_status",
        F.col("ml_anomaly_label").alias("anomaly_label"),
        F.col("ml_anomaly_score").alias("anomaly_score"),
        F.col("dq_issue_reason").alias("dq_reason"),
    )


def top_suspicious(classified: DataFrame, k: int = 100, seq: str = "row_seq") -> DataFrame:
    """The k worst lines of any status; equal scores in file order."""
    return suspicious_view(classified, seq).orderBy(F.desc("anomaly_score"), "transaction_index").limit(k)


def filter_suspicious(view: DataFrame, status: str = S.STATUS_ANOMALY, query: str = "") -> DataFrame:
    """Lines of a status ('ALL' for any) whose texts contain the query, over the whole scored table."""
    if status != "ALL":
        view = view.filter(F.col("system_status") == status)
    if query.strip():
        names = ("invoice_no", "customer_id", "country", "description", "stock_code")
        view = view.filter(contains_ignoring_case(query, *[F.col(n) for n in names]))
    return view


def find_transaction(view: DataFrame, index: int) -> DataFrame:
    return view.filter(F.col("transaction_index") == index)


def with_score_band(view: DataFrame, score: str = "anomaly_score") -> DataFrame:
    return view.withColumn("score_band", score_band(F.col(score)))
