"""Distributions of orders over a status or payment method."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.constants import UNKNOWN, UNKNOWN_PAYMENT
from basketry.functions.columns import label_or, require_columns
from basketry.functions.money import exact_avg, exact_sum, percent, percent_rounded


def total_of(grouped: DataFrame, count: str) -> Column:
    """Grand total of a group count. The subquery reuses the shuffle of ``grouped``."""
    return grouped.agg(F.sum(count)).scalar()


def row_count(df: DataFrame) -> Column:
    """Number of rows, as a scalar subquery that reads no column."""
    return df.agg(F.count("*")).scalar()


def share(df: DataFrame, by: str) -> DataFrame:
    """Row count and percentage (two decimals) per value of ``by``."""
    require_columns(df, by)
    grouped = df.groupBy(by).agg(F.count("*").alias("nombre_commandes"))
    total = total_of(grouped, "nombre_commandes")
    return grouped.withColumn("pourcentage", percent_rounded("nombre_commandes", total))


def by_count(grouped: DataFrame, count: str, *ties: str) -> DataFrame:
    """A listing with the largest count first; equal counts by the other columns given."""
    require_columns(grouped, count, *ties)
    return grouped.orderBy(F.desc(count), *[F.asc_nulls_last(t) for t in ties])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    require_columns(df, column)
    return df.select(column).distinct()


def status_distribution(orders: DataFrame) -> DataFrame:
    """Count and mean amount per status."""
    require_columns(orders, "status", "total_amount")
    return orders.groupBy("status").agg(
        F.count("*").alias("nombre"), exact_avg("total_amount").alias("moyenne_TND")
    )


def status_counts(orders: DataFrame, unknown: str = UNKNOWN) -> DataFrame:
    """Count and share per status; null and empty statuses are labelled."""
    require_columns(orders, "status")
    grouped = orders.groupBy("status").agg(F.count("*").alias("n"))
    total = total_of(grouped, "n")
    return grouped.select(
        label_or("status", unknown).alias("status"),
        F.col("n").alias("count"),
        percent("n", total).alias("percentage"),
    )


def payment_mix(orders: DataFrame) -> DataFrame:
    """Count, percentage, total and mean per payment method over all orders.

    Orders without a method are counted but carry no amounts.
    """
    require_columns(orders, "payment_method")
    measures = [F.count("*").alias("nombre_commandes")]
    amounts = []
    if "total_amount" in orders.columns:
        amounts = ["montant_total", "panier_moyen"]
        measures += [exact_sum("total_amount").alias(amounts[0]), exact_avg("total_amount").alias(amounts[1])]
    grouped = orders.groupBy("payment_method").agg(*measures)
    total = total_of(grouped, "nombre_commandes")
    known = F.col("payment_method").isNotNull()
    return grouped.select(
        "payment_method",
        "nombre_commandes",
        percent_rounded("nombre_commandes", total).alias("pourcentage"),
        *[F.when(known, F.col(a)).alias(a) for a in amounts],
    )


def payment_distribution(orders: DataFrame) -> DataFrame:
    """Count and total amount per payment method."""
    require_columns(orders, "payment_method", "total_amount")
    return orders.groupBy("payment_method").agg(
        F.count("*").alias("nombre"), exact_sum("total_amount").alias("total_TND")
    )


def payment_totals(orders: DataFrame, unknown: str = UNKNOWN_PAYMENT) -> DataFrame:
    """Count, total, mean and share per method, amounts of unnamed methods included."""
    require_columns(orders, "payment_method", "total_amount")
    grouped = orders.groupBy("payment_method").agg(
        F.count("*").alias("n"),
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_amount"),
        exact_avg("total_amount").alias("avg_amount"),
    )
    total = total_of(grouped, "n")
    return grouped.select(
        label_or("payment_method", unknown).alias("payment_method"),
        F.col("n").alias("count"),
        "total_amount",
        "avg_amount",
        percent("n", total).alias("percentage"),
    )
