"""Named queries over the star-schema tables: key -> (spark, sf_dir) -> DataFrame.

Statuses in these tables are single letters; F plays the delivered order. The
latest order date stands for "now". Customers there spend far more than the
default segment thresholds, so the thresholds are scaled up.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions import predicates as pred
from basketry.functions.calendar import add_calendar, latest, weekday_name
from basketry.operators import (
    customers as cust,
    distribution,
    documents,
    forecast as fc,
    products as prod,
    profile,
    reports,
    sales,
    shares,
)
from basketry.sources import extended_json
from basketry.sources.dataset import Dataset, load_dataset
from basketry.sources.writers import json_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PATTERNS = ("%F%",)
VALUE = "F"
SEGMENTS = ((1_000_000, "VIP"), (500_000, "Fidèle"), (100_000, "Actif"))
FORECAST_DAYS = 7


def query(build: Callable[[Dataset], DataFrame]) -> Callable[[Dataset], DataFrame]:
    """Register ``build`` under its own name, opening the dataset for it."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(load_dataset(spark, sf_dir))
    return build


def delivered(d: Dataset) -> DataFrame:
    return d.orders.filter(pred.delivered_like(patterns=PATTERNS))


def delivered_lines(d: Dataset) -> DataFrame:
    """Lines of delivered orders."""
    return documents.lines_of(d.lines, delivered(d))


def product_facts(d: Dataset) -> DataFrame:
    return prod.product_item_facts(delivered_lines(d), d.products)


# Scans, previews, profiles


@query
def scan_orders(d: Dataset) -> DataFrame:
    return d.orders


@query
def collection_profile(d: Dataset) -> DataFrame:
    return profile.collection_profile(d.collections())


@query
def preview_orders(d: Dataset) -> DataFrame:
    return profile.preview(d.orders, "order_id", 20)


@query
def schema_listing(d: Dataset) -> DataFrame:
    listings = [profile.schema_listing(name, df) for name, df in d.collections().items()]
    return reduce(DataFrame.unionByName, listings)


@query
def missing_values(d: Dataset) -> DataFrame:
    return profile.missing_values(d.customers)


@query
def search_contains(d: Dataset) -> DataFrame:
    return profile.search(d.orders, "payment_method", "URGENT")


@query
def search_hits(d: Dataset) -> DataFrame:
    return profile.search_hits(d.customers, "name", "42")


@query
def export_json_rows(d: Dataset) -> DataFrame:
    return json_rows(d.orders)


@query
def store_export(d: Dataset) -> DataFrame:
    """Orders as they come back from the export of a document store."""
    return extended_json.parsed_lines(extended_json.export_lines(d.orders), d.orders.schema)


@query
def store_export_items(d: Dataset) -> DataFrame:
    """Items of delivered orders, from nested documents in the export of a document store."""
    nested = documents.order_documents(delivered(d), delivered_lines(d), d.products).select("order_id", "items")
    back = extended_json.parsed_lines(extended_json.export_lines(nested), nested.schema)
    return documents.explode_items(back)


@query
def export_marks(d: Dataset) -> DataFrame:
    return extended_json.marked_keys(extended_json.export_lines(d.orders))


@query
def signup_period(d: Dataset) -> DataFrame:
    return profile.period(d.customers, "join_date", "Premier_inscrit", "Dernier_inscrit")


@query
def order_period(d: Dataset) -> DataFrame:
    return profile.period(d.orders, "date", "Premiere_commande", "Derniere_commande")


# Delivered filters and statuses


@query
def delivered_like(d: Dataset) -> DataFrame:
    return delivered(d).select("order_id", "status", "total_amount")


@query
def delivered_contains(d: Dataset) -> DataFrame:
    return d.orders.filter(pred.delivered_contains(value=VALUE)).select("order_id", "status", "total_amount")


@query
def delivered_regex(d: Dataset) -> DataFrame:
    return d.orders.filter(pred.delivered_regex(value="f")).select("order_id", "status", "total_amount")


@query
def distinct_statuses(d: Dataset) -> DataFrame:
    return shares.distinct_values(d.orders, "status")


@query
def status_share(d: Dataset) -> DataFrame:
    return shares.share(d.orders, "status")


@query
def status_distribution(d: Dataset) -> DataFrame:
    return shares.status_distribution(d.orders)


@query
def statuses_by_count(d: Dataset) -> DataFrame:
    return shares.by_count(shares.status_counts(d.orders), "count", "status")


@query
def status_counts(d: Dataset) -> DataFrame:
    return shares.status_counts(d.orders)


# KPI reports


@query
def basic_statistics(d: Dataset) -> DataFrame:
    return reports.basic_statistics(d.orders, d.customers, d.products, pred.delivered_like(patterns=PATTERNS))


@query
def summary_report(d: Dataset) -> DataFrame:
    return reports.summary_report(d.orders, d.customers, d.products, pred.delivered_like(patterns=PATTERNS))


@query
def quick_kpis(d: Dataset) -> DataFrame:
    return reports.quick_kpis(d.orders, pred.delivered_regex(value=VALUE))


@query
def delivered_revenue(d: Dataset) -> DataFrame:
    return reports.delivered_revenue(delivered(d))


@query
def order_statistics(d: Dataset) -> DataFrame:
    return reports.order_statistics(d.orders)


# Calendar and time


@query
def calendar_features(d: Dataset) -> DataFrame:
    return add_calendar(delivered(d)).select(
        "order_id", "date_formatted", "year", "month", "day", "weekday", "is_weekend", "month_year"
    )


@query
def weekday_names(d: Dataset) -> DataFrame:
    """Orders per French weekday name."""
    return d.orders.groupBy(
        F.dayofweek("date").alias("weekday"), weekday_name("date").alias("weekday_name")
    ).agg(F.count("*").alias("n_orders"))


@query
def daily_sales(d: Dataset) -> DataFrame:
    return sales.daily_sales(delivered(d))


@query
def daily_stats(d: Dataset) -> DataFrame:
    return sales.daily_stats(sales.daily_counts(delivered(d)))


@query
def first_days(d: Dataset) -> DataFrame:
    return sales.first_days(sales.daily_sales(sales.on_edge_days(delivered(d))))


@query
def last_days(d: Dataset) -> DataFrame:
    return sales.last_days(sales.daily_sales(sales.on_edge_days(delivered(d), latest=True)))


@query
def best_days(d: Dataset) -> DataFrame:
    return sales.best_days(sales.daily_sales(delivered(d)))


@query
def order_day_window(d: Dataset) -> DataFrame:
    return sales.order_day_window(delivered(d)).select(
        "order_id", "date_jour", "total_amount", "total_ventes_day", "panier_moyen_day"
    )


@query
def monthly_sales(d: Dataset) -> DataFrame:
    return sales.monthly_sales(delivered(d))


@query
def monthly_first12(d: Dataset) -> DataFrame:
    return sales.monthly_first(sales.monthly_sales(delivered(d)))


@query
def monthly_display6(d: Dataset) -> DataFrame:
    return sales.monthly_display(sales.monthly_sales(delivered(d)))


def _history(d: Dataset) -> DataFrame:
    return sales.daily_history(delivered(d), 30, latest(d.orders))


@query
def daily_history_30d(d: Dataset) -> DataFrame:
    return _history(d)


@query
def daily_history_mean(d: Dataset) -> DataFrame:
    return sales.daily_history_mean(_history(d))


@query
def amount_histogram(d: Dataset) -> DataFrame:
    return distribution.histogram(delivered(d))


@query
def amount_center(d: Dataset) -> DataFrame:
    return distribution.amount_center(delivered(d))


# Payments


@query
def payment_mix(d: Dataset) -> DataFrame:
    return shares.payment_mix(d.orders)


@query
def payment_distribution(d: Dataset) -> DataFrame:
    return shares.payment_distribution(d.orders)


@query
def payment_totals(d: Dataset) -> DataFrame:
    return shares.payment_totals(d.orders)


# Customers


@query
def customer_behavior(d: Dataset) -> DataFrame:
    return cust.customer_behavior(delivered(d))


def _segments(d: Dataset) -> DataFrame:
    return cust.customer_segments(cust.customer_behavior(delivered(d)), SEGMENTS)


@query
def customer_segments(d: Dataset) -> DataFrame:
    return _segments(d).select("customer_id", "total_depense", "segment")


@query
def segment_summary(d: Dataset) -> DataFrame:
    return cust.segment_summary(_segments(d))


@query
def top_customers_count(d: Dataset) -> DataFrame:
    return cust.top_by_orders(cust.customer_behavior(delivered(d)).select(
        "customer_id", "nombre_commandes", "jours_achat"
    ))


@query
def customer_behavior_top100(d: Dataset) -> DataFrame:
    return cust.top_by_orders(_segments(d), 100)


@query
def top_customers(d: Dataset) -> DataFrame:
    return cust.top_customers(delivered(d), d.customers)


@query
def top_customer_labels(d: Dataset) -> DataFrame:
    return cust.top_customer_labels(delivered(d), d.customers)


@query
def customers_by_location(d: Dataset) -> DataFrame:
    return cust.customers_by_location(d.customers)


@query
def customer_overview(d: Dataset) -> DataFrame:
    return cust.customer_overview(d.customers)


# Products and items


@query
def product_sales(d: Dataset) -> DataFrame:
    return prod.product_sales(product_facts(d))


@query
def top_products_count(d: Dataset) -> DataFrame:
    return prod.top_products_by_count(prod.product_sales(product_facts(d)))


@query
def top_products_revenue(d: Dataset) -> DataFrame:
    return prod.top_products_by_revenue(product_facts(d))


@query
def product_catalog(d: Dataset) -> DataFrame:
    return prod.product_catalog(d.products)


@query
def price_statistics(d: Dataset) -> DataFrame:
    return prod.price_statistics(d.products)


@query
def category_distribution(d: Dataset) -> DataFrame:
    return prod.category_distribution(d.products)


@query
def order_documents(d: Dataset) -> DataFrame:
    nested = documents.order_documents(d.orders, d.lines, d.products)
    return nested.withColumn("items", F.to_json("items"))  # text compares the same on every engine


@query
def order_documents_json(d: Dataset) -> DataFrame:
    # Orders are not split here, so there is no part to tell apart.
    return json_rows(documents.order_documents(d.orders, d.lines, d.products).drop("part", "items_total"))


@query
def exploded_items(d: Dataset) -> DataFrame:
    # The lines are the items that documents would hold; there is no need to nest them first.
    return documents.item_lines(delivered_lines(d), d.products)


@query
def order_item_totals(d: Dataset) -> DataFrame:
    return documents.order_item_totals(d.orders, d.lines, d.products)


@query
def order_item_preview(d: Dataset) -> DataFrame:
    return documents.order_item_preview(d.orders, d.lines, d.products)


# Forecast


def _training_rows(d: Dataset) -> DataFrame:
    return fc.training_rows(d.orders, pred.delivered_contains(value=VALUE))


def _model(d: Dataset):
    return fc.fit_model(fc.training_features(_training_rows(d)))


def _forecast(d: Dataset) -> DataFrame:
    spark, as_of = d.orders.sparkSession, latest(d.orders)
    calendar = fc.future_calendar(spark, as_of, FORECAST_DAYS)
    return fc.forecast(_model(d), calendar, created_at=as_of)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Columns to so many decimals, where the last digits of doubles depend on the engine."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _stored_forecast(d: Dataset) -> DataFrame:
    """What stands for a stored forecast table in the reports on one."""
    spark, as_of = d.orders.sparkSession, latest(d.orders)
    return fc.weekday_forecast(_training_rows(d), fc.future_calendar(spark, as_of, FORECAST_DAYS), created_at=as_of)


@query
def training_rows(d: Dataset) -> DataFrame:
    return _training_rows(d)


@query
def training_features(d: Dataset) -> DataFrame:
    return fc.training_features(_training_rows(d))


@query
def training_features_daily(d: Dataset) -> DataFrame:
    return fc.training_features(_training_rows(d), grain="day")


@query
def future_calendar(d: Dataset) -> DataFrame:
    return fc.future_calendar(d.orders.sparkSession, latest(d.orders), FORECAST_DAYS)


@query
def model_coefficients(d: Dataset) -> DataFrame:
    return rounded(fc.model_coefficients(_model(d)), coefficient=6)


@query
def model_evaluation(d: Dataset) -> DataFrame:
    train, test = fc.split_holdout(_training_rows(d))
    model = fc.fit_model(fc.training_features(train))
    return rounded(fc.model_evaluation(model, fc.training_features(test)), rmse=3, mae=3, r2=9)


@query
def sales_forecast(d: Dataset) -> DataFrame:
    # Text compares the same on every engine.
    return rounded(_forecast(d), predicted_sales=6).withColumn("features_used", F.to_json("features_used"))


@query
def weekday_forecast(d: Dataset) -> DataFrame:
    return _stored_forecast(d).select("prediction_id", "predicted_date", "predicted_sales", "day", "month", "weekday", "model")


@query
def next_predictions(d: Dataset) -> DataFrame:
    return fc.next_predictions(_stored_forecast(d))


@query
def forecast_summary(d: Dataset) -> DataFrame:
    return fc.forecast_summary(_stored_forecast(d))


@query
def forecast_trend(d: Dataset) -> DataFrame:
    return fc.forecast_trend(fc.forecast_summary(_stored_forecast(d)), delivered(d))


@query
def forecast_vs_history(d: Dataset) -> DataFrame:
    return fc.forecast_vs_history(_stored_forecast(d), _history(d))
