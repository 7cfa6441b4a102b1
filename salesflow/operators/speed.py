"""Running aggregates and the rating filter; the input may be a stream or a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_RATING = 4.5


def _total(events: DataFrame, keys: tuple[str, ...], field: str, name: str) -> DataFrame:
    return events.groupBy(*keys).agg(F.sum(field).cast("double").alias(name))


def sales_by_city_product(events: DataFrame) -> DataFrame:
    return _total(events, ("city", "product_line"), "total", "total_sales")


def sales_by_customer_type(events: DataFrame) -> DataFrame:
    return _total(events, ("customer_type",), "total", "total_sales_by_customer_type")


def gross_income_by_product(events: DataFrame) -> DataFrame:
    return _total(events, ("product_line",), "gross_income", "total_gross_income")


def quantity_by_product(events: DataFrame) -> DataFrame:
    return _total(events, ("product_line",), "quantity", "total_quantity_sold")


def top_rated(events: DataFrame) -> DataFrame:
    return events.where(F.col("rating") >= TOP_RATING)


# view name -> (operator, projection shown to readers)
SPEED_VIEWS = {
    "total_sales_by_city_product_view": (sales_by_city_product, "city, product_line, total_sales"),
    "total_sales_by_customer_type_view": (sales_by_customer_type, "customer_type, total_sales_by_customer_type"),
    "total_gross_income_by_product_view": (gross_income_by_product, "product_line, total_gross_income"),
    "total_quantity_by_product_view": (quantity_by_product, "product_line, total_quantity_sold"),
    "top_rated_products_view": (top_rated, "id, product_line, rating"),
}
TOP_RATED_VIEW = "top_rated_products_view"

# view name -> event fields it needs decoded; every message is told apart from garbage by its id
VIEW_FIELDS = {
    "total_sales_by_city_product_view": ("id", "city", "product_line", "total"),
    "total_sales_by_customer_type_view": ("id", "customer_type", "total"),
    "total_gross_income_by_product_view": ("id", "product_line", "gross_income"),
    "total_quantity_by_product_view": ("id", "product_line", "quantity"),
    "top_rated_products_view": ("id", "invoice_id", "product_line", "rating"),
}


def named_query(events: DataFrame, view: str, columns: str | None = None) -> DataFrame:
    """Select from one of the views on ``events`` with SQL.

    The session knows the view by its name afterwards; the query uses a name
    of its own, so that queries of one session do not take each other's views.
    """
    operator, projection = SPEED_VIEWS[view]
    own, rows = f"{view}_{uuid.uuid4().hex}", operator(events)
    rows.createOrReplaceTempView(own)
    try:
        selected = events.sparkSession.sql(f"SELECT {columns or projection} FROM {own}")
    finally:
        events.sparkSession.catalog.dropTempView(own)
    rows.createOrReplaceTempView(view)
    return selected
