"""Stream predictions against batch predictions, and predictions against actual totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "Invoice ID"


def compare_layers(stream: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """Inner join on the invoice; the other columns get ``_stream`` / ``_batch``.

    A repeated invoice pairs with each of its counterparts. No hint: the
    strategy follows the measured sizes, and a hot invoice is split by
    adaptive execution.
    """

    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        return df.toDF(*[c if c == key else f"{c}{suffix}" for c in df.columns])

    return suffixed(stream, "_stream").join(suffixed(batch, "_batch"), key, "inner")


def prediction_difference(compared: DataFrame) -> DataFrame:
    difference: Column = F.col("Prediction_stream") - F.col("Prediction_batch")
    return compared.withColumn("Prediction_Difference", difference)


def prediction_error(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("error", F.col("Prediction") - F.col("Total"))
