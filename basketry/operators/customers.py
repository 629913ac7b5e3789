"""Customer behaviour, segments and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.constants import CLIENT_PREFIX, LOWEST_SEGMENT, SEGMENTS
from basketry.functions.calendar import to_day
from basketry.functions.columns import first_rows, has_columns, require_columns
from basketry.functions.money import exact_avg, exact_sum
from basketry.operators.lookup import attach_record


def segment_label(spend: str, segments=SEGMENTS, lowest: str = LOWEST_SEGMENT) -> Column:
    """Name of the first threshold reached; unknown spend counts as lowest."""
    (floor, name), *rest = segments
    label = F.when(F.col(spend) >= floor, name)
    for floor, name in rest:
        label = label.when(F.col(spend) >= floor, name)
    return label.otherwise(lowest)


def customer_behavior(orders: DataFrame) -> DataFrame:
    """Orders, purchase days, spend and mean basket per customer, in one aggregation.

    Orders without a customer are counted in a null row that carries no amounts.
    """
    require_columns(orders, "customer_id", "date")
    measures = [
        F.count("*").alias("nombre_commandes"),
        F.count_distinct(to_day("date")).alias("jours_achat"),
    ]
    if not has_columns(orders, "total_amount"):
        return orders.groupBy("customer_id").agg(*measures)
    grouped = orders.groupBy("customer_id").agg(
        *measures,
        exact_sum("total_amount").alias("total_depense"),
        exact_avg("total_amount").alias("panier_moyen"),
    )
    known = F.col("customer_id").isNotNull()
    return grouped.withColumns({a: F.when(known, F.col(a)) for a in ("total_depense", "panier_moyen")})


def customer_segments(behavior: DataFrame, segments=SEGMENTS) -> DataFrame:
    require_columns(behavior, "total_depense")
    return behavior.withColumn("segment", segment_label("total_depense", segments))


def segment_summary(segmented: DataFrame) -> DataFrame:
    """Customers, mean spend and mean number of orders per segment."""
    return segmented.groupBy("segment").agg(
        F.count("*").alias("nb_clients"),
        exact_avg("total_depense").alias("depense_moyenne"),
        F.try_divide(F.sum("nombre_commandes"), F.count("nombre_commandes")).alias("commandes_moyennes"),
    )


def top_by_orders(behavior: DataFrame, n: int | None = 10) -> DataFrame:
    return first_rows(behavior.orderBy(F.desc("nombre_commandes"), F.asc("customer_id")), n)


def customer_spend(orders: DataFrame) -> DataFrame:
    """Total, count and mean amount per customer."""
    require_columns(orders, "customer_id", "total_amount")
    return orders.groupBy("customer_id").agg(
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_spent"),
        F.count("*").alias("order_count"),
        exact_avg("total_amount").alias("avg_order"),
    )


def _customer(*fields: str) -> Column:
    return F.when(F.col("name").isNotNull(), F.struct(*fields))


def _with_name(customers: DataFrame) -> DataFrame:
    """Customers; without a name column every name is unknown."""
    return customers if has_columns(customers, "name") else customers.withColumn("name", F.lit(None).cast("string"))


def _fallback_name() -> Column:
    return F.concat(F.lit(CLIENT_PREFIX), F.right(F.col("customer_id").cast("string"), F.lit(4)))


def top_spenders(orders: DataFrame, n: int = 5) -> DataFrame:
    return customer_spend(orders).orderBy(F.desc("total_spent"), F.asc("customer_id")).limit(n)


def top_customers(orders: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Highest spenders with their name; unknown ids show their last four characters."""
    named = attach_record(top_spenders(orders, n), _with_name(customers), "customer_id", _customer("name"))
    return named.select(
        "customer_id",
        F.coalesce("record.name", _fallback_name()).alias("client_name"),
        "total_spent",
        "order_count",
        "avg_order",
    )


def top_customer_labels(orders: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Short chart label per top customer: ``name (loc)`` cut to twelve characters."""
    name = F.col("record.name")
    if has_columns(customers, "location"):
        record = _customer("name", "location")
        place = F.substring("record.location", 1, 3)
        full = F.coalesce(F.concat(F.substring(name, 1, 10), F.lit(" ("), place, F.lit(")")), name)
    else:
        record, full = _customer("name"), name
    return attach_record(top_spenders(orders, n), _with_name(customers), "customer_id", record).select(
        "customer_id",
        F.coalesce(F.substring(full, 1, 12), _fallback_name()).alias("label"),
        "total_spent",
    )


def customers_by_location(customers: DataFrame) -> DataFrame:
    require_columns(customers, "location")
    return customers.groupBy("location").agg(F.count("*").alias("Nombre_Clients"))


def customer_overview(customers: DataFrame) -> DataFrame:
    """Number of customers and of distinct cities, a missing city counting as one."""
    if not has_columns(customers, "location"):
        return customers.agg(F.count("*").alias("n_customers"), F.lit(0).cast("bigint").alias("n_cities"))
    unknown = F.max(F.when(F.col("location").isNull(), 1).otherwise(0)).cast("bigint")
    cities = F.count_distinct("location") + F.coalesce(unknown, F.lit(0))
    return customers.agg(F.count("*").alias("n_customers"), cities.alias("n_cities"))
