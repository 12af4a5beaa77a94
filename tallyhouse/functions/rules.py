"""The per-row quality rules for retail lines, each a boolean Column that is never NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import parse_number
from tallyhouse.functions.text import is_blank, strip

# Date layouts that occur in such files, and what a text of each layout has in any case; the engine's
# own parser covers ISO texts.
DATE_LAYOUTS = {
    "M/d/yyyy[ H:mm[:ss]]": "/",
    "yyyy/M/d[ H:mm[:ss]]": "/",
    "d-MMM-yyyy[ H:mm[:ss]]": r"-\D",
    "MMM d, yyyy[ H:mm[:ss]]": ",",
    "yyyyMMdd": r"^[+-]?\d+$",
}


def missing_customer() -> Column:
    return F.col("CustomerID").isNull()


def missing_description() -> Column:
    return is_blank(F.col("Description"))


def negative_quantity(quantity: Column | None = None) -> Column:
    """``quantity`` may pass the parsed number in, so that it is not parsed again."""
    quantity = parse_number(F.col("Quantity")) if quantity is None else quantity
    cancelled = F.coalesce(F.startswith("InvoiceNo", F.lit(S.CANCELLATION_PREFIX)), F.lit(False))
    return quantity.isNull() | ((quantity < 0) & ~cancelled)


def bad_unit_price(price: Column | None = None) -> Column:
    price = parse_number(F.col("UnitPrice")) if price is None else price
    return price.isNull() | (price <= 0) | (price > S.MAX_LINE_PRICE)


def parse_date(text: Column) -> Column:
    """Timestamp from text, NULL if no known layout fits.

    A layout that does not fit costs an exception a row, so only texts that have its marks are tried.
    """
    tries = [F.when(text.rlike(mark), F.try_to_timestamp(text, F.lit(x))) for x, mark in DATE_LAYOUTS.items()]
    return F.coalesce(text.try_cast("timestamp"), *tries)


def bad_date() -> Column:
    """Present but unreadable; a missing date is not an error."""
    text = F.col("InvoiceDate")
    return text.isNotNull() & parse_date(text).isNull()


def bad_country() -> Column:
    country = F.col("Country")
    odd = country.isin(*S.BAD_COUNTRY_NAMES) | (strip(country) != country)
    return F.coalesce(odd, F.lit(False))


# Label -> predicate, in the order reasons are listed.
LINE_RULES = {
    S.MISSING_CUSTOMER: missing_customer,
    S.MISSING_DESCRIPTION: missing_description,
    S.NEGATIVE_QUANTITY: negative_quantity,
    S.BAD_PRICE: bad_unit_price,
    S.BAD_DATE: bad_date,
    S.BAD_COUNTRY: bad_country,
}


PARSED = {"_quantity": "Quantity", "_price": "UnitPrice"}


def with_parsed(lines: DataFrame) -> DataFrame:
    """Parse the numbers once, ahead of the rules that use them several times."""
    return lines.withColumns({name: parse_number(F.col(text)) for name, text in PARSED.items()})


def tests_on_parsed() -> dict[str, Column]:
    """Label -> predicate over a frame that went through ``with_parsed``."""
    parsed = {S.NEGATIVE_QUANTITY: negative_quantity(F.col("_quantity")), S.BAD_PRICE: bad_unit_price(F.col("_price"))}
    return {label: parsed[label] if label in parsed else rule() for label, rule in LINE_RULES.items()}
