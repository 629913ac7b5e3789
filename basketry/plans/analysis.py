"""Complete analyses: each returns its results as a dictionary of lazy frames.

Inputs are the three retail tables as they come from the source, orders with
their nested ``items`` where they have them. Parts whose columns are missing
are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.constants import OTHER_PAYMENT, SEGMENTS, STORED_ROWS
from basketry.functions.calendar import AsOf, add_calendar
from basketry.functions.columns import has_columns
from basketry.functions.predicates import delivered_contains, delivered_like, delivered_regex
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


def clean_orders(orders: DataFrame, delivered: Column | None = None, as_of: AsOf = None) -> DataFrame:
    """Delivered orders with calendar columns; orders without a status are all kept.

    Orders without any date column are dated ``as_of``.
    """
    if "status" in orders.columns:
        orders = orders.filter(delivered_like() if delivered is None else delivered)
    dated = add_calendar(orders, "date", as_of)
    return dated if "date" in orders.columns else dated.withColumn("date", F.col("date_formatted"))


def run_all(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    delivered: Column | None = None,
    segments=SEGMENTS,
    as_of: AsOf = None,
    stored_rows: int | None = STORED_ROWS,
) -> dict[str, DataFrame]:
    """The batch analysis: the four stored results, their rankings and the reports.

    ``stored(results)`` picks the frames that go to ``analysis_*`` tables. Stored customers and products
    are the first ``stored_rows``; None keeps them all.
    """
    cleaned = clean_orders(orders, delivered, as_of)
    out = {}
    if has_columns(orders, "status"):
        out["status_share"] = shares.share(orders, "status")
    if has_columns(cleaned, "customer_id"):
        daily = sales.daily_sales(cleaned)
        out |= {
            "daily_sales": daily,
            "daily_stats": sales.daily_stats(daily),
            "first_days": sales.first_days(sales.daily_sales(sales.on_edge_days(cleaned))),
            "best_days": sales.best_days(daily),
        }
        behavior = cust.customer_behavior(cleaned)
        if has_columns(behavior, "total_depense"):
            behavior = cust.customer_segments(behavior, segments)
            out["segment_summary"] = cust.segment_summary(behavior)
        out["customer_behavior"] = cust.top_by_orders(behavior, stored_rows)
        out["top_customers"] = cust.top_by_orders(behavior)
    if has_columns(cleaned, "items"):
        sold = prod.product_sales(documents.explode_items(cleaned.select("items"), "product_id", "name", "quantity"))
        out["product_sales"] = prod.top_products_by_count(sold, stored_rows)
        out["top_products"] = prod.top_products_by_count(sold)
    elif has_columns(products, "product_id", "name", "price", "category"):
        out["product_sales"] = prod.product_catalog(products, stored_rows)
    if has_columns(orders, "payment_method"):
        out["payment_methods"] = shares.payment_mix(orders)
    if has_columns(orders, "status"):
        wanted = delivered_like() if delivered is None else delivered
        out["basic_statistics"] = reports.basic_statistics(orders, customers, products, wanted)
        out["summary_report"] = reports.summary_report(orders, customers, products, wanted)
    return out


def stored(results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The results kept as ``analysis_*`` tables."""
    names = ("daily_sales", "product_sales", "customer_behavior", "payment_methods")
    return {n: results[n] for n in names if n in results}


def profile_collection(df: DataFrame, name: str, key: str | None = None) -> dict[str, DataFrame]:
    """Dimensions, schema, preview, missing values, and what the kind of table adds; listings by count.

    The preview goes by ``key``, or by all columns that can be ordered.
    """
    out = {
        "dimensions": profile.collection_profile({name: df}),
        "schema": profile.schema_listing(name, df),
        "preview": profile.preview(df, [key] if key else profile.orderable(df)),
        "missing_values": profile.missing_values(df),
    }
    kind = name.lower()
    if kind == "customers":
        if has_columns(df, "location"):
            out["by_location"] = shares.by_count(cust.customers_by_location(df), "Nombre_Clients", "location")
        if has_columns(df, "join_date"):
            out["signup_period"] = profile.period(df, "join_date", "Premier_inscrit", "Dernier_inscrit")
        out["overview"] = cust.customer_overview(df)
    elif kind == "orders":
        if has_columns(df, "total_amount"):
            out["statistics"] = reports.order_statistics(df)
            if has_columns(df, "status"):
                out["by_status"] = shares.by_count(shares.status_distribution(df), "nombre", "status")
            if has_columns(df, "payment_method"):
                out["by_payment"] = shares.by_count(shares.payment_distribution(df), "nombre", "payment_method")
        if has_columns(df, "date"):
            out["order_period"] = profile.period(df, "date", "Premiere_commande", "Derniere_commande")
        if has_columns(df, "items", "order_id"):
            out["item_preview"] = documents.document_item_preview(df)
    elif kind == "products":
        if has_columns(df, "price"):
            out["price_statistics"] = prod.price_statistics(df)
        for column in ("category", "available"):
            counts = prod.category_distribution(df, column)
            if counts is not None:
                out[f"by_{column}"] = shares.by_count(counts, counts.columns[1], column)
    return out


def dashboard(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    predictions: DataFrame | None = None,
    as_of: AsOf = None,
    delivered: Column | None = None,
    history_days: int = 30,
    latest_months: bool = False,
) -> dict[str, DataFrame]:
    """The data behind every dashboard panel; panels whose columns are missing are left out.

    Nothing runs before a panel is used. ``latest_months`` shows the most recent months instead of the
    oldest ones.
    """
    out: dict[str, DataFrame] = {}

    def panel(name: str, build, *needs: str) -> None:
        if has_columns(orders, *needs):
            out[name] = build()

    wanted = delivered_regex() if delivered is None else delivered
    panel("statuses", lambda: shares.status_counts(orders), "status")
    panel("payments", lambda: shares.payment_totals(orders), "payment_method", "total_amount")
    panel("payments_chart", lambda: shares.payment_totals(orders, unknown=OTHER_PAYMENT), "payment_method", "total_amount")
    if delivered is None and not has_columns(orders, "status"):
        return out | _forecast_panels(predictions, None, None)
    done = orders.filter(wanted)
    months = lambda: sales.monthly_sales(done)
    panel("summary", lambda: reports.basic_statistics(orders, customers, products, wanted))
    panel("revenue", lambda: reports.delivered_revenue(done), "total_amount")
    panel("top_customers", lambda: cust.top_customers(done, customers), "customer_id", "total_amount")
    panel("top_customer_labels", lambda: cust.top_customer_labels(done, customers), "customer_id", "total_amount")
    panel("months", lambda: sales.monthly_first(months(), latest=latest_months), "date", "total_amount")
    panel("months_shown", lambda: sales.monthly_display(months(), latest=latest_months), "date", "total_amount")
    panel("amount_histogram", lambda: distribution.histogram(done), "total_amount")
    panel("amount_center", lambda: distribution.amount_center(done), "total_amount")
    panel("history", lambda: sales.daily_history(done, history_days, as_of), "date", "total_amount")
    panel("top_products", lambda: prod.top_products_by_revenue(documents.explode_items(done.select("items"))), "items")
    priced = done if has_columns(orders, "total_amount") else None
    return out | _forecast_panels(predictions, priced, out.get("history"))


def _forecast_panels(predictions: DataFrame | None, done: DataFrame | None, history: DataFrame | None) -> dict[str, DataFrame]:
    if predictions is None:
        return {}
    summary = fc.forecast_summary(predictions)
    out = {"predictions": fc.read_forecast(predictions).orderBy("predicted_date"), "forecast_summary": summary}
    if done is not None:
        out["forecast_trend"] = fc.forecast_trend(summary, done)
    if history is not None:
        out["forecast_vs_history"] = fc.forecast_vs_history(predictions, history)
    return out


def quick_dashboard(
    orders: DataFrame, predictions: DataFrame | None = None, delivered: Column | None = None
) -> dict[str, DataFrame]:
    """The short report: KPIs and the next predictions."""
    wanted = delivered_regex() if delivered is None else delivered
    out = {"kpis": reports.quick_kpis(orders, wanted)}
    if predictions is not None:
        out["next_predictions"] = fc.next_predictions(predictions)
    return out


def run_forecast(
    orders: DataFrame,
    days: int = 7,
    as_of: AsOf = None,
    delivered: Column | None = None,
    grain: str = "order",
) -> DataFrame:
    """Train on delivered orders (all, when hardly any are delivered) and forecast ``days`` days."""
    wanted = delivered_contains() if delivered is None else delivered
    model = fc.fit_model(fc.training_features(fc.training_rows(orders, wanted), grain))
    return fc.forecast(model, fc.future_calendar(orders.sparkSession, as_of, days), created_at=as_of)
