"""The complete analyses on nested documents, and plans that must keep their shape."""

from __future__ import annotations

import datetime as dt

import pytest

from basketry import schemas
from basketry.plans import analysis
from basketry.plans.catalog import QUERIES
from basketry.sources.readers import load_table
from basketry.sources.writers import Target, replace_table, save_results
from conftest import one, rows_of

AS_OF = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def shop(spark):
    item = lambda p, q: (p, f"Produit {p}", 10 * int(p[1:]), q)
    orders = [
        (f"ORD-{i:04d}", f"CUST-{i % 4:03d}", AS_OF - dt.timedelta(days=3 * i), [item("P1", 1), item(f"P{i % 3 + 1}", 2)],
         float(10 + 20 * (i % 3 + 1)), ("carte", "paypal")[i % 2], ("livré", "Livré", "en cours")[i % 3])
        for i in range(30)
    ]
    products = [(f"P{i}", f"Produit {i}", "tv", "", 10 * i, 5, "S") for i in range(1, 5)]
    customers = [(f"CUST-{i:03d}", f"Client {i}", "e", "t", AS_OF, "Tunis") for i in range(3)]
    return (
        spark.createDataFrame(orders, schemas.ORDERS),
        spark.createDataFrame(products, schemas.PRODUCTS),
        spark.createDataFrame(customers, schemas.CUSTOMERS),
    )


def test_run_all_and_save(shop, tmp_path, spark):
    orders, products, customers = shop
    results = analysis.run_all(orders, products, customers)
    assert one(results["basic_statistics"])["delivered_orders"] == 20
    assert results["daily_sales"].count() == 20
    assert rows_of(results["product_sales"])[0][:3] == ("P1", "Produit P1", 30)
    assert {r.segment for r in results["customer_behavior"].collect()} == {"Actif"}
    outcome = save_results(analysis.stored(results), Target(str(tmp_path)))
    assert outcome == dict.fromkeys(("daily_sales", "product_sales", "customer_behavior", "payment_methods"), "saved")
    assert spark.read.parquet(f"{tmp_path}/analysis_payment_methods").count() == 2


def test_run_all_without_optional_columns(shop):
    orders, products, customers = shop
    results = analysis.run_all(orders.drop("items", "total_amount", "status", "payment_method"), products, customers)
    assert "payment_methods" not in results and "summary_report" not in results
    fewer = analysis.run_all(orders.drop("total_amount", "customer_id"), products, customers)
    assert one(fewer["basic_statistics"]).keys() == {"total_orders", "delivered_orders", "delivered_pct", "total_customers", "total_products"}
    assert {r.metric for r in fewer["summary_report"].collect()} == {"commandes_totales", "commandes_nettoyees", "taux_utilisation", "clients_inscrits", "produits_disponibles"}
    assert results["product_sales"].columns == ["product_id", "name", "price", "category"]
    assert results["customer_behavior"].columns == ["customer_id", "nombre_commandes", "jours_achat"]


def test_run_all_without_dates(shop):
    orders, products, customers = shop
    daily = analysis.run_all(orders.drop("date"), products, customers, as_of=dt.date(2020, 1, 2))["daily_sales"]
    assert [(r.date_jour, r.nb_commandes) for r in daily.collect()] == [(dt.date(2020, 1, 2), 20)]


def test_profiles(shop):
    orders, products, customers = shop
    for df, name in ((orders, "orders"), (products, "products"), (customers, "Customers")):
        parts = analysis.profile_collection(df, name)
        for part in parts.values():
            part.collect()
        assert {"dimensions", "schema", "preview", "missing_values"} < set(parts)
    assert analysis.profile_collection(orders, "orders")["item_preview"].count() == 6
    assert "by_available" not in analysis.profile_collection(products, "products")


def test_dashboards(shop):
    orders, products, customers = shop
    predictions = analysis.run_forecast(orders, 7, AS_OF)
    panels = analysis.dashboard(orders, customers, products, predictions, AS_OF)
    for panel in panels.values():
        panel.collect()
    assert one(panels["summary"])["delivered_orders"] == 20
    assert sum(r.n for r in panels["amount_histogram"].collect()) == 20
    assert {r.client_name for r in panels["top_customers"].collect()} == {"Client 0", "Client 1", "Client 2", "Client -003"}
    assert panels["predictions"].count() == 7
    quick = analysis.quick_dashboard(orders, predictions)
    assert quick["next_predictions"].count() == 5 and one(quick["kpis"])["total_orders"] == 30


@pytest.mark.parametrize("fmt, options", [("parquet", {}), ("json", {})])
def test_stored_forecast_is_read_back(shop, spark, tmp_path, fmt, options):
    made = analysis.run_forecast(shop[0], 7, AS_OF)
    replace_table(made, "predictions", Target(str(tmp_path), fmt, options))
    stored = load_table(spark, f"{tmp_path}/predictions", fmt, schemas.PREDICTIONS)
    assert rows_of(stored) == rows_of(made)
    assert rows_of(analysis.quick_dashboard(shop[0], stored)["next_predictions"])[0][1] == dt.date(2024, 3, 2)


def test_forecast_as_csv(shop, spark, tmp_path):
    made = analysis.run_forecast(shop[0], 3, AS_OF)
    replace_table(made, "predictions", Target(str(tmp_path), "csv", {"header": True}))
    stored = spark.read.csv(f"{tmp_path}/predictions", header=True)
    assert stored.count() == 3
    assert {r.features_used for r in stored.collect()} == {'["day","weekday","month"]'}


def test_daily_grain_forecast_is_a_daily_total(shop):
    orders = shop[0]
    twice = orders.unionByName(orders)
    one_order = analysis.run_forecast(twice, 1, AS_OF).first().predicted_sales
    one_day = analysis.run_forecast(twice, 1, AS_OF, grain="day").first().predicted_sales
    assert one_day == pytest.approx(2 * one_order, rel=1e-2)


def physical(spark, sf_dir, key):
    return QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["daily_sales", "customer_behavior", "payment_mix"])
def test_fused_aggregations_have_no_join_or_window(spark, sf_dir, key):
    plan = physical(spark, sf_dir, key)
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize(
    "key", ["best_days", "top_products_revenue", "top_products_count", "top_customers_count", "monthly_first12", "preview_orders"]
)
def test_rankings_do_not_sort_everything(spark, sf_dir, key):
    assert "TakeOrderedAndProject" in physical(spark, sf_dir, key)


def test_no_query_uses_a_cartesian_product_or_python(spark, sf_dir):
    for key in QUERIES:
        plan = physical(spark, sf_dir, key)
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
            assert operator not in plan, (key, operator)


def test_counting_customers_reads_one_table(spark, sf_dir):
    plan = physical(spark, sf_dir, "basic_statistics")
    assert "nation.parquet" not in plan and "events.parquet" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = physical(spark, sf_dir, "monthly_sales")
    assert "StringContains(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("column", ["payment_method", "status", "total_amount", "customer_id", "date", "items"])
def test_dashboard_without_a_column(shop, column):
    orders, products, customers = shop
    panels = analysis.dashboard(orders.drop(column), customers, products, as_of=AS_OF, latest_months=True)
    assert panels
    for panel in panels.values():
        panel.collect()
    assert ("summary" in panels) == (column != "status")


def test_customers_without_names_and_forecasts_without_a_model(shop, spark):
    orders, products, customers = shop
    panels = analysis.dashboard(orders, customers.drop("name"), products, as_of=AS_OF)
    assert all(r.client_name.startswith("Client ") for r in panels["top_customers"].collect())
    stored = spark.createDataFrame([("p", "2024-03-02", 5.0)], "prediction_id string, predicted_date string, predicted_sales double")
    assert analysis.dashboard(orders, customers, products, stored, AS_OF)["forecast_summary"].count() == 1


def test_all_rows_can_be_stored_and_listings_go_by_count(shop):
    orders, products, customers = shop
    assert analysis.run_all(orders, products, customers, stored_rows=None)["customer_behavior"].count() == 4
    assert analysis.run_all(orders, products, customers, stored_rows=1)["customer_behavior"].count() == 1
    counts = [r.nombre for r in analysis.profile_collection(orders, "orders")["by_status"].collect()]
    assert counts == sorted(counts, reverse=True)
