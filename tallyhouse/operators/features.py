"""Features of retail lines, imputation and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import finite, parse_number, safe_ratio
from tallyhouse.functions.text import strip
from tallyhouse.operators.quantiles import quantiles
from tallyhouse.sources.staging import stage

# Per-customer sums are added up in decimals: the total then depends on neither row order nor
# partitioning, which a sum of doubles would.
_EXACT = "decimal(30,6)"

CUSTOMER_FEATURES = ("CustomerPurchaseFrequency", "CustomerTotalSpend", "AverageTransactionValue")


def coerce_numeric(lines: DataFrame) -> DataFrame:
    """Quantity and UnitPrice as doubles; unreadable texts become 1.0 and 0.0."""
    parsed = lines.withColumns({c: parse_number(F.col(c)) for c in ("Quantity", "UnitPrice")})
    return parsed.withColumns(
        {
            "Quantity": F.coalesce(finite(F.col("Quantity")), F.lit(1.0)),
            "UnitPrice": F.coalesce(finite(F.col("UnitPrice")), F.lit(0.0)),
        }
    )


def with_total_amount(lines: DataFrame) -> DataFrame:
    return lines.withColumn("TotalAmount", F.col("Quantity") * F.col("UnitPrice"))


def customer_key() -> Column:
    return F.coalesce(F.col("CustomerID"), F.lit(S.GUEST))


def country_key() -> Column:
    return F.upper(strip(F.coalesce(F.col("Country"), F.lit(S.UNKNOWN_COUNTRY))))


def customer_stats(amounts: DataFrame) -> DataFrame:
    """Line count, spend and mean amount per customer; anonymous lines share one key.

    The aggregate combines before its shuffle, so a key with most of the lines is no heavier.
    """
    return _spending(amounts.groupBy(customer_key().alias("_customer")).agg(*_sums()))


def _sums() -> list[Column]:
    amount = F.col("TotalAmount").try_cast(_EXACT)
    return [F.count("TotalAmount").alias("_lines"), F.sum(amount).alias("_spend")]


def _spending(summed: DataFrame) -> DataFrame:
    return summed.select(
        "_customer",
        F.col("_lines").cast("double").alias("CustomerPurchaseFrequency"),
        F.col("_spend").cast("double").alias("CustomerTotalSpend"),
        safe_ratio(F.col("_spend"), F.col("_lines")).alias("AverageTransactionValue"),
    )


def country_stats(lines: DataFrame) -> DataFrame:
    """Number of lines with an invoice number per normalised country."""
    return lines.groupBy(country_key().alias("_country")).agg(
        F.count("InvoiceNo").cast("double").alias("CountryTransactionCount")
    )


def staged_stats(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``customer_stats`` and ``country_stats``, staged from one pass over the lines.

    Lines are added up once, by customer and country as written, combined before the shuffle; both groupings
    add up those sums. The countries are staged once more from there, so that each table has its own known size
    when the lines are joined.
    """
    keyed = line_amounts(lines).select(customer_key().alias("_customer"), "Country", "InvoiceNo", "TotalAmount")
    pairs = keyed.groupBy("_customer", "Country").agg(*_sums(), F.count("InvoiceNo").alias("_invoices"))
    pairs = pairs.withColumn("_country", country_key())
    keys = F.col("_customer"), F.col("_country")
    sums = [F.sum(c).alias(c) for c in ("_lines", "_spend", "_invoices")]
    grouped = pairs.groupingSets([[k] for k in keys], *keys).agg(*sums)
    both = stage(grouped, "line-stats")  # a key is never missing, so the other grouping's rows are those without it
    countries = both.where("_customer IS NULL").select(
        "_country", F.col("_invoices").cast("double").alias("CountryTransactionCount")
    )
    return _spending(both.where("_country IS NULL")), stage(countries, "countries")


def _join_back(lines: DataFrame, key: Column, stats: DataFrame, stats_key: str, staged: bool) -> DataFrame:
    """Left join per-key statistics to the lines they were computed from.

    Small statistics are broadcast by measured size. Otherwise the adaptive plan splits the lines of a
    hot key, but only where both inputs come straight from an exchange. A staged table does; an
    aggregate would keep its partitioning on the key, so the key is wrapped to have it exchanged.
    """
    other = F.col(stats_key)
    same = key == other if staged else F.struct(key.alias("k")) == F.struct(other.alias("k"))
    return lines.join(stats, same, "left").drop(stats_key)


def customer_features(amounts: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Customer statistics joined back to the lines; ``stats`` passes a staged ``customer_stats`` in."""
    fresh = customer_stats(amounts) if stats is None else stats
    return _join_back(amounts, customer_key(), fresh, "_customer", stats is not None)


def country_feature(lines: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    fresh = country_stats(lines) if stats is None else stats
    return _join_back(lines, country_key(), fresh, "_country", stats is not None)


def line_amounts(lines: DataFrame) -> DataFrame:
    return with_total_amount(coerce_numeric(lines))


def line_features(
    lines: DataFrame, customers: DataFrame | None = None, countries: DataFrame | None = None
) -> DataFrame:
    """All seven feature columns next to the line's own columns.

    Statistics that are not passed in are staged here, so their measured sizes decide between broadcast and
    shuffle before any line moves.
    """
    if customers is None or countries is None:
        fresh = staged_stats(lines)
        customers = fresh[0] if customers is None else customers
        countries = fresh[1] if countries is None else countries
    return country_feature(customer_features(line_amounts(lines), customers), countries)


def medians(df: DataFrame, columns: Sequence[str] = S.FEATURES, **options: int) -> dict[str, float]:
    """Exact median per column; 0.0 where a column has no value at all."""
    points = quantiles(df, columns, [0.5], **options)
    return {c: float(points[c][0] or 0.0) for c in columns}


def fill_missing(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()})


def impute_median(df: DataFrame, columns: Sequence[str] = S.FEATURES, **options: int) -> DataFrame:
    """NULL becomes the column's exact median, or 0.0 where the column has no value at all."""
    return fill_missing(df, medians(df, columns, **options))


def robust_scale(
    df: DataFrame, columns: Sequence[str] = S.FEATURES, suffix: str = "_scaled", **options: int
) -> DataFrame:
    """(x - median) / interquartile range as new columns; a zero range divides by one."""
    points = quantiles(df, columns, [0.25, 0.5, 0.75], **options)
    scaled = {}
    for c in columns:
        low, middle, high = (float(x or 0.0) for x in points[c])
        scaled[c + suffix] = (F.col(c).cast("double") - F.lit(middle)) / F.lit((high - low) or 1.0)
    return df.withColumns(scaled)


def standard_scale(df: DataFrame, columns: Sequence[str] = S.FEATURES, suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population standard deviation as new columns; a zero deviation divides by one."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return df.withColumns(
        {
            c + suffix: (F.col(c).cast("double") - F.lit(row[f"m{i}"] or 0.0)) / F.lit(row[f"s{i}"] or 1.0)
            for i, c in enumerate(columns)
        }
    )
