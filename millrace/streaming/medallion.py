"""Sales orders in three layers: raw stream, cleaned partitioned table, totals by city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import epoch_to_timestamp, year_month
from millrace.operators.quality import DROP, Rule, enforce

VALID_ORDER = Rule("valid_order_number", "order_number IS NOT NULL", DROP)


def cleaned_orders(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with a number, epoch times as dates, and their customer's attributes."""
    ordered_at = epoch_to_timestamp("order_datetime")
    orders = enforce(raw, [VALID_ORDER])
    return orders.join(customers, ["customer_id", "customer_name"], "left").select(
        *[c for c in raw.columns if c != "order_datetime"],
        ordered_at.alias("order_datetime"),
        F.to_date(ordered_at).alias("order_date"),
        year_month(ordered_at).alias("order_month"),
        *[c for c in customers.columns if c not in ("customer_id", "customer_name")],
    )


def sales_by_city(cleaned: DataFrame, city: str | None = None) -> DataFrame:
    """Sales, quantity and products per city, day, customer and currency."""
    if city is not None:
        cleaned = cleaned.where(F.col("city") == city)
    keys = ["city", "order_date", "customer_id", "customer_name"]
    products = cleaned.select(*keys, F.explode("ordered_products").alias("product"))
    return products.groupBy(*keys, F.col("product.curr").alias("curr")).agg(
        F.sum("product.price").alias("sales"),
        F.sum("product.qty").alias("quantity"),
        F.count("product.id").alias("product_count"),
    )


def monthly_sales(cleaned: DataFrame) -> DataFrame:
    """:func:`sales_by_city` with the month that a row is stored under."""
    return sales_by_city(cleaned).withColumn("order_month", year_month("order_date"))
