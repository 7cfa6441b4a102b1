"""Missing values, dates, keys, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)
# A bare NaN token read into a text field keeps its quotes; fixed values.
_NAN_TEXT = ('"NaN"', "NaN")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating point column, and the text of a NaN token in text columns.

    Must run before any filter or sum: NaN compares greater than every
    number and turns a sum into NaN.
    """

    def clean(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _FLOATS):
            return F.when(~F.isnan(column), column).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(~column.isin(*_NAN_TEXT), column).alias(field.name)
        return column

    return df.select(*[clean(f) for f in df.schema.fields])


def sale_date(text: Column) -> Column:
    """Month/day/year text -> date; one or two digits, NULL when it is no date."""
    return F.to_date(F.try_to_timestamp(text, F.lit("M/d/yyyy")))


def content_key(columns: list[str]) -> Column:
    """Repeatable surrogate key: a digest of the row, the same on every task retry."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)


def random_key() -> Column:
    """Random surrogate key; changes when a task is retried, so never shuffle on it."""
    return F.expr("uuid()")


def strip_prefix(df: DataFrame, prefix: str = "sales.") -> DataFrame:
    """``sales.total`` -> ``total``; columns without the prefix keep their name."""
    return df.toDF(*[c.removeprefix(prefix) for c in df.columns])
