"""One-row KPI reports. Each is a single plan over each table it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.columns import has_columns, require_columns
from basketry.functions.money import exact_avg, exact_sum, percent
from basketry.operators.shares import row_count


def _delivered_kpis(orders: DataFrame, delivered: Column) -> DataFrame:
    """One row of order counts and, where orders have amounts, delivered amounts, from a single scan."""
    priced = has_columns(orders, "total_amount")
    marked = orders.select(*(["total_amount"] if priced else []), delivered.alias("delivered"))
    amount = "if(delivered, total_amount, null)"
    amounts = [
        F.coalesce(exact_sum(amount), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(exact_avg(amount), F.lit(0.0)).alias("avg_order_value"),
    ]
    counts = [F.count("*").alias("total_orders"), F.count_if("delivered").alias("delivered_orders")]
    return marked.agg(*counts, *(amounts if priced else []))


def basic_statistics(
    orders: DataFrame, customers: DataFrame, products: DataFrame, delivered: Column
) -> DataFrame:
    """Orders, delivered orders and their share, customers, products, revenue, mean basket.

    Orders without amounts have no revenue and mean basket.
    """
    kpis = _delivered_kpis(orders, delivered)
    return kpis.select(
        "total_orders",
        "delivered_orders",
        percent("delivered_orders", "total_orders").alias("delivered_pct"),
        row_count(customers).alias("total_customers"),
        row_count(products).alias("total_products"),
        *[c for c in ("total_revenue", "avg_order_value") if has_columns(kpis, c)],
    )


def summary_report(
    orders: DataFrame, customers: DataFrame, products: DataFrame, delivered: Column
) -> DataFrame:
    """The final report as (metric, value) rows; rates without a base are left out.

    So are revenue and basket of orders without amounts, and active customers of orders without customers.
    """
    # The active customers need a distinct count; apart from the other KPIs it
    # keeps those in a single pass without an expanded aggregate.
    known = has_columns(orders, "customer_id")
    active = orders.filter(delivered).agg(F.count_distinct("customer_id")).scalar() if known else F.lit(None).cast("bigint")
    kpis = _delivered_kpis(orders, delivered)
    row = kpis.select(
        "*",
        row_count(customers).alias("total_customers"),
        row_count(products).alias("total_products"),
        active.alias("active_customers"),
    )
    some = F.col("delivered_orders") > 0
    metrics = {
        "commandes_totales": F.col("total_orders"),
        "commandes_nettoyees": F.col("delivered_orders"),
        "taux_utilisation": percent("delivered_orders", "total_orders"),
        "clients_inscrits": F.col("total_customers"),
        "produits_disponibles": F.col("total_products"),
        "clients_actifs": F.when(some, F.col("active_customers")),
        "taux_activation": F.when(some, percent("active_customers", "total_customers")),
    }
    if has_columns(kpis, "total_revenue"):
        metrics["chiffre_affaires"] = F.when(some, F.col("total_revenue"))
        metrics["panier_moyen"] = F.when(some, F.col("avg_order_value"))
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()]
    )
    return row.select(F.inline(pairs)).filter(F.col("value").isNotNull())


def quick_kpis(orders: DataFrame, delivered: Column) -> DataFrame:
    """Orders, delivered orders and share, revenue and mean order; revenue null if none delivered."""
    require_columns(orders, "total_amount")
    some = F.col("delivered_orders") > 0
    return _delivered_kpis(orders, delivered).select(
        "total_orders",
        "delivered_orders",
        percent("delivered_orders", "total_orders").alias("delivered_pct"),
        F.when(some, F.col("total_revenue")).alias("total"),
        F.when(some, F.col("avg_order_value")).alias("avg"),
    )


def delivered_revenue(delivered_orders: DataFrame) -> DataFrame:
    """Sum, mean, maximum and minimum amount; no row when there are no orders."""
    require_columns(delivered_orders, "total_amount")
    stats = delivered_orders.agg(
        F.count("*").alias("n"),
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_sales"),
        exact_avg("total_amount").alias("avg_order"),
        F.max("total_amount").alias("max_order"),
        F.min("total_amount").alias("min_order"),
    )
    return stats.filter(F.col("n") > 0).drop("n")


def order_statistics(orders: DataFrame) -> DataFrame:
    """Count, total and mean over all orders; zero when there are no amounts."""
    require_columns(orders, "total_amount")
    return orders.agg(
        F.count("*").alias("Total_Commandes"),
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("Chiffre_Affaires_Total"),
        F.coalesce(exact_avg("total_amount"), F.lit(0.0)).alias("Panier_Moyen"),
    )
