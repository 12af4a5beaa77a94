"""One plain type per kind of value, so that results of two engines can be compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(df: DataFrame) -> DataFrame:
    """Decimals to double, integers to bigint, dates and timestamps to text, lists to joined text."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, "|")
        columns.append(c.alias(field.name))
    return df.select(*columns)
