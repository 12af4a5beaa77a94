"""The anomaly report: rules, features, forest, classification, sections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.operators import features, forest, quality, scoring
from tallyhouse.sources.staging import stage


@dataclass(frozen=True)
class ModelSettings:
    contamination: float = S.CONTAMINATION
    n_estimators: int = S.N_ESTIMATORS
    seed: int = S.SEED
    max_samples: int = S.MAX_SAMPLES


def score_lines(lines: DataFrame, model_settings: ModelSettings = ModelSettings()) -> DataFrame:
    """Every line with quality flag, features, path sum and raw score; nothing is filtered out.

    The statistics that are joined back to the lines are staged first: fitting and scoring share them,
    and their known sizes decide between broadcast and shuffle before any line moves. Fitting reads a
    sample only, as the sampling filter sits below the joins. Missing features get the median of their
    column before the fit and before scoring; columns without a gap need no median. The staged customers tell
    the number of lines, and whether there is a gap: quantities, prices and counts are never missing, and a
    customer's spend and mean only where no amount of theirs can be added up.
    """
    customers, countries = features.staged_stats(lines)
    repeats = stage(quality.repeated_lines(lines), "repeats")
    featured = features.line_features(lines, customers, countries)
    n_rows = F.sum(F.col("CustomerPurchaseFrequency").cast("bigint"))
    counts = customers.agg(
        F.coalesce(n_rows, F.lit(0)).alias("_lines"), *[F.count_if(F.col(c).isNull()).alias(c) for c in features.CUSTOMER_FEATURES]
    ).first()
    gaps = [c for c in features.CUSTOMER_FEATURES if counts[c]]
    values = features.medians(stage(featured.select(*gaps), "gaps"), gaps) if gaps else {}
    nodes = forest.fit_isolation_forest(
        features.fill_missing(featured, values),
        n_estimators=model_settings.n_estimators,
        seed=model_settings.seed,
        max_samples=model_settings.max_samples,
        n_rows=counts["_lines"],
    )
    model = forest.ForestModel.collect(nodes)
    flagged = quality.dq_flag(lines, repeats=repeats)
    return forest.score_forest(features.fill_missing(features.line_features(flagged, customers, countries), values), model)


def classify_lines(scored: DataFrame, contamination: float = S.CONTAMINATION) -> DataFrame:
    """Prediction, normalised score and status on a scored frame (staged beforehand if costly)."""
    cut = scoring.threshold(scored, contamination)
    return scoring.classify(scoring.normalize_scores(scoring.predict(scored, cut)))


def report_sections(classified: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    return {
        "kpi_summary": scoring.kpi_summary(classified),
        "score_distribution": scoring.score_histogram(classified),
        "anomalies_by_country": scoring.anomalies_by_country(classified),
        "anomalies_by_product": scoring.anomalies_by_product(classified),
        "top_suspicious_transactions": scoring.top_suspicious(classified),
        "dq_rule_breakdown": quality.dq_rule_breakdown(lines),
    }


def anomaly_report(
    lines: DataFrame, dataset_name: str, model_settings: ModelSettings = ModelSettings()
) -> dict[str, object]:
    """Settings plus one bounded frame per section; ``scored`` is the whole classified table.

    The scored table is staged once: threshold, extremes and all sections read its few columns
    instead of running the model again.
    """
    scored = stage(score_lines(lines, model_settings), "scored")
    classified = classify_lines(scored, model_settings.contamination)
    return {
        "status": "SUCCESS",
        "model_settings": {
            "dataset_name": dataset_name,
            "contamination": model_settings.contamination,
            "n_estimators": model_settings.n_estimators,
            "random_state": model_settings.seed,
            "algorithm": S.ALGORITHM,
            "features_used": list(S.FEATURES),
        },
        "scored": classified,
        **report_sections(classified, lines),
    }
