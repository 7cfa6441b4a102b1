"""Record layouts: raw CSV, sales record, JSON event, Avro message, predictions."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Stored amounts: 18 digits before the point, ten behind it. What is larger is set aside with a reason.
MONEY = T.DecimalType(28, 10)
MONEY_BOUND = 1e18
# Their sums: room for 10**10 amounts of any size.
MONEY_SUM = T.DecimalType(38, 10).simpleString()

# Raw CSV header -> record field, in file order.
RAW_TO_FIELD = {
    "Invoice ID": "invoice_id",
    "Branch": "branch",
    "City": "city",
    "Customer type": "customer_type",
    "Gender": "gender",
    "Product line": "product_line",
    "Unit price": "unit_price",
    "Quantity": "quantity",
    "Tax 5%": "tax_5_percent",
    "Total": "total",
    "Date": "date",
    "Time": "time",
    "Payment": "payment",
    "cogs": "cogs",
    "gross margin percentage": "gross_margin_percentage",
    "gross income": "gross_income",
    "Rating": "rating",
}

# Fields that are numbers on the wire.
NUMERIC_FIELDS = (
    "unit_price",
    "quantity",
    "tax_5_percent",
    "total",
    "cogs",
    "gross_margin_percentage",
    "gross_income",
    "rating",
)

# Amounts that get summed. Decimal sums do not depend on task order.
MONEY_FIELDS = ("tax_5_percent", "total", "cogs", "gross_income")

# Model inputs, in vector order.
FEATURES = ("unit_price", "quantity", "tax_5_percent", "cogs", "gross_income", "rating")
RAW_FEATURES = ("Unit price", "Quantity", "Tax 5%", "cogs", "gross income", "Rating")


def _engine_type(field: str) -> T.DataType:
    if field == "quantity":
        return T.IntegerType()
    if field in MONEY_FIELDS:
        return MONEY
    return T.DoubleType() if field in NUMERIC_FIELDS else T.StringType()


def _wire_type(field: str) -> T.DataType:
    return T.DoubleType() if field in NUMERIC_FIELDS else T.StringType()


FIELDS = ("id", *RAW_TO_FIELD.values())

# The stored sales record.
SALES = T.StructType([T.StructField(f, _engine_type(f)) for f in FIELDS])

# JSON event as published; every number, quantity included, is a double.
EVENT = T.StructType([T.StructField(f, _wire_type(f)) for f in FIELDS])

# Raw CSV, typed (Quantity int, other numbers double) and as plain text.
RAW = T.StructType(
    [
        T.StructField(header, T.IntegerType() if field == "quantity" else _wire_type(field))
        for header, field in RAW_TO_FIELD.items()
    ]
)
RAW_TEXT = T.StructType([T.StructField(header, T.StringType()) for header in RAW_TO_FIELD])

# Headerless prediction files; columns are known by position only.
PREDICTIONS = T.StructType(
    [
        T.StructField("Invoice ID", T.StringType()),
        T.StructField("Total", T.DoubleType()),
        T.StructField("Prediction", T.DoubleType()),
        T.StructField("Prediction Time (s)", T.DoubleType()),
    ]
)


def avro_schema(name: str = "InvoiceRecord", namespace: str | None = None) -> str:
    """Avro schema of a batch message: 18 required fields, 32-bit numbers."""

    def avro_type(field: str) -> str:
        if field == "quantity":
            return "int"
        return "float" if field in NUMERIC_FIELDS else "string"

    record = {"type": "record", "name": name, "fields": [{"name": f, "type": avro_type(f)} for f in FIELDS]}
    if namespace:
        record["namespace"] = namespace
    return json.dumps(record)


def avro_schema_from_file(path: str) -> str:
    """Read an ``.avsc`` file on the driver and check that it is JSON."""
    with open(path, encoding="utf-8") as handle:
        return json.dumps(json.load(handle))
