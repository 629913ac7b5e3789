"""Sales over time: days, months and recent history.

Input is order rows, usually already filtered to delivered ones. Amount columns
appear only when the input has ``total_amount``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.calendar import AsOf, dated, month_key, to_day
from basketry.functions.columns import has_columns, require_columns
from basketry.functions.money import exact_avg, exact_sum
from basketry.functions.predicates import since_days


def daily_sales(orders: DataFrame) -> DataFrame:
    """Orders, distinct customers, total and mean amount per day, in one aggregation.

    Orders without a date are counted in a null day that carries no amounts.
    """
    require_columns(orders, "date", "customer_id")
    measures = [
        F.count("*").alias("nb_commandes"),
        F.count_distinct("customer_id").alias("clients_uniques"),
    ]
    amounts = []
    if has_columns(orders, "total_amount"):
        amounts = ["total_ventes_day", "panier_moyen_day"]
        measures += [exact_sum("total_amount").alias(amounts[0]), exact_avg("total_amount").alias(amounts[1])]
    grouped = orders.groupBy(to_day("date").alias("date_jour")).agg(*measures)
    dated = F.col("date_jour").isNotNull()
    return grouped.withColumns({a: F.when(dated, F.col(a)) for a in amounts}) if amounts else grouped


def daily_counts(orders: DataFrame) -> DataFrame:
    """Orders per day only, for statistics that need neither amounts nor customers."""
    return orders.groupBy(to_day("date").alias("date_jour")).agg(F.count("*").alias("nb_commandes"))


def daily_stats(daily: DataFrame) -> DataFrame:
    """Mean, maximum and minimum orders per day and the number of dated days."""
    return daily.agg(
        F.try_divide(F.sum("nb_commandes"), F.count("nb_commandes")).alias("commandes_moyennes_par_jour"),
        F.max("nb_commandes").alias("max_commandes_jour"),
        F.min("nb_commandes").alias("min_commandes_jour"),
        F.count("date_jour").alias("nombre_jours_analyses"),
    )


def on_edge_days(orders: DataFrame, n: int = 5, latest: bool = False) -> DataFrame:
    """The orders of the first (or latest) ``n`` days, and those without a date.

    Finding these days groups the date column only. Sales of those days then
    shuffle the customers of few orders instead of all.
    """
    day = to_day("date")
    days = orders.select(day.alias("d")).distinct().orderBy(F.desc("d") if latest else F.asc("d")).limit(n)
    bound = days.agg(F.min("d") if latest else F.max("d")).scalar()
    return orders.filter((day >= bound if latest else day <= bound) | day.isNull())


def first_days(daily: DataFrame, n: int = 5) -> DataFrame:
    return daily.orderBy(F.asc("date_jour")).limit(n)


def last_days(daily: DataFrame, n: int = 5) -> DataFrame:
    return daily.orderBy(F.desc("date_jour")).limit(n)


def best_days(daily: DataFrame, n: int = 5) -> DataFrame:
    """Days with the highest sales, or the most orders when there are no amounts."""
    if has_columns(daily, "total_ventes_day"):
        rank, kept = "total_ventes_day", ["date_jour", "nb_commandes", "total_ventes_day", "panier_moyen_day"]
    else:
        rank, kept = "nb_commandes", ["date_jour", "nb_commandes", "clients_uniques"]
    return daily.orderBy(F.desc(rank), F.asc("date_jour")).select(*kept).limit(n)


def order_day_window(orders: DataFrame) -> DataFrame:
    """Every order with the total and mean amount of its day.

    The window over whole days becomes an aggregate joined back. Its rows are
    calendar days, so Spark usually broadcasts them and the orders are neither
    shuffled nor sorted.
    """
    require_columns(orders, "date", "total_amount")
    with_day = orders.withColumn("date_jour", to_day("date"))
    per_day = with_day.groupBy(F.col("date_jour").alias("day_key")).agg(
        exact_sum("total_amount").alias("total_ventes_day"),
        exact_avg("total_amount").alias("panier_moyen_day"),
    )
    same_day = F.col("date_jour").eqNullSafe(F.col("day_key"))
    return with_day.join(per_day, same_day, "left").drop("day_key")


def monthly_sales(orders: DataFrame) -> DataFrame:
    """Total, count and mean amount per ``yyyy-MM``."""
    require_columns(orders, "date", "total_amount")
    # Months are grouped as dates; only the groups are formatted.
    grouped = orders.groupBy(F.trunc(to_day("date"), "month").alias("year_month")).agg(
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_sales"),
        F.count("*").alias("order_count"),
        exact_avg("total_amount").alias("avg_sale"),
    )
    return grouped.withColumn("year_month", month_key("year_month"))


def monthly_first(monthly: DataFrame, n: int = 12, latest: bool = False) -> DataFrame:
    """The oldest ``n`` months, or the most recent ones with ``latest``."""
    order = F.desc("year_month") if latest else F.asc("year_month")
    return monthly.orderBy(order).limit(n)


def monthly_display(monthly: DataFrame, n: int = 12, shown: int = 6, latest: bool = False) -> DataFrame:
    """The last ``shown`` months among those kept by ``monthly_first``."""
    return monthly_first(monthly, n, latest).orderBy(F.desc("year_month")).limit(shown)


def daily_history(orders: DataFrame, days: int = 30, as_of: AsOf = None) -> DataFrame:
    """Daily sales since ``as_of`` minus ``days``."""
    require_columns(orders, "date", "total_amount")
    recent = dated(orders).filter(since_days("date", days, as_of))
    grouped = recent.groupBy(to_day("date").alias("day")).agg(
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("daily_sales")
    )
    return grouped.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def daily_history_mean(history: DataFrame) -> DataFrame:
    """Mean of the daily sales and the number of days behind it."""
    return history.agg(exact_avg("daily_sales").alias("hist_avg"), F.count("*").alias("n_days"))
