"""Row-level filters and projections of order events; all of them stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, item_list, seconds


def keep(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate holds; unknown counts as no."""
    return df.where(predicate)


def with_status(orders: DataFrame, status: str = "PLACED") -> DataFrame:
    """Orders in exactly this state; a missing state never passes."""
    return keep(orders, F.col("status") == status)


def stock_actions(orders: DataFrame) -> DataFrame:
    action = (F.when(F.col("status") == "PLACED", "deduct")
              .when(F.col("status") == "CANCELLED", "restore")
              .otherwise("none"))
    return orders.withColumn("stock_action", action)


def event_classes(orders: DataFrame) -> DataFrame:
    known = F.col("status").isin("PLACED", "CONFIRMED", "CANCELLED")
    return orders.withColumn("event_class", F.when(known, F.lower("status")).otherwise("other"))


def order_items(orders: DataFrame) -> DataFrame:
    """One row per ordered item, with its position in the list."""
    return orders.select("order_id", F.posexplode(item_list("items")).alias("position", "item"))


def invoices(orders: DataFrame) -> DataFrame:
    return orders.select(F.concat(F.lit("INV-"), "order_id").alias("invoice_no"),
                         "order_id", "customer_id", "amount")


def notifications(orders: DataFrame, style: str = "status") -> DataFrame:
    """One row per order and channel.

    ``status`` announces every state change, ``checkout`` confirms a new order.
    """
    order_id, amount = F.col("order_id"), F.col("amount").cast("string")
    if style == "status":
        email = F.concat(F.lit("Order "), order_id, F.lit(" "), F.col("status"))
        sms = F.concat(F.lit("Your order "), order_id, F.lit(" has been "), F.col("status"))
    elif style == "checkout":
        email = F.concat(F.lit("Order "), order_id, F.lit(" Confirmed"))
        sms = F.concat(F.lit("Order "), order_id, F.lit(" placed for ₹"), amount,
                       F.lit(". Thank you!"))
    else:
        raise ValueError(f"unknown style {style!r}")
    rows = F.array(F.struct(F.lit("email").alias("channel"), email.alias("body")),
                   F.struct(F.lit("sms").alias("channel"), sms.alias("body")))
    return (orders.select("order_id", "customer_id", F.explode(rows).alias("n"))
            .select("order_id", "customer_id", "n.channel", "n.body"))


def health_colour(count: str | Column) -> Column:
    c = col(count)
    return F.when(c >= 10, "red").when(c >= 1, "yellow").otherwise("green")


def within_retention(df: DataFrame, as_of: Column, keep_seconds: int,
                     ts: str = "created_at") -> DataFrame:
    """Rows young enough to be kept; with a literal ``as_of`` the bound is pushed down."""
    return df.where(F.col(ts) >= as_of - seconds(keep_seconds))


def tap(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Observe metrics of the rows that flow past, leaving them unchanged."""
    return df.observe(name, *(metrics or (F.count(F.lit(1)).alias("rows"),)))
