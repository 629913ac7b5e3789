from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from basketry.functions.money import exact_avg, exact_sum, percent_rounded
from basketry.operators import reports, sales, shares
from basketry.functions.predicates import delivered_like
from conftest import ORDER_FIELDS, one, rows_of


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


ROWS = [
    ("o1", "a", day(1, 9), 10.10, "carte", "livré"),
    ("o2", "a", day(1, 17), 20.20, "carte", "Livré"),
    ("o3", "b", day(2), 30.30, "paypal", "livré"),
    ("o4", None, None, 5.00, None, "livré"),
    ("o5", "c", day(3), None, "", "livré"),
    ("o6", "c", day(3), 100.0, "paypal", "annulé"),
    ("o7", "d", day(3), 7.0, "paypal", None),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ROWS, ORDER_FIELDS)


@pytest.fixture(scope="module")
def done(orders):
    return orders.filter(delivered_like())


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.range(100_000).select((F.col("id") % 7 * 0.1).alias("x"))
    expected = sum((i % 7) for i in range(100_000)) / 10
    for n in (1, 3, 8):
        assert df.repartition(n).agg(exact_sum("x")).first()[0] == expected


def test_exact_sum_of_negatives_nulls_and_nothing(spark):
    df = spark.createDataFrame([(-5.25,), (2.1,), (None,)], "x double")
    assert tuple(df.agg(exact_sum("x"), exact_avg("x")).first()) == (-3.15, -1.575)
    assert tuple(df.limit(0).agg(exact_sum("x"), exact_avg("x")).first()) == (None, None)


def test_exact_sum_keeps_three_decimals_and_large_totals(spark):
    df = spark.createDataFrame([(0.001,), (900_000_000.125,), (900_000_000.125,)], "x double")
    assert df.agg(exact_sum("x")).first()[0] == 1_800_000_000.251


def test_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (5, 0)], "part bigint, whole bigint")
    assert [r[0] for r in df.select(percent_rounded("part", "whole")).collect()] == [0.13, 33.33, None]


def test_daily_sales_with_null_day(done):
    assert rows_of(sales.daily_sales(done)) == [
        (None, 1, 0, None, None),
        (dt.date(2024, 1, 1), 2, 1, 30.3, 15.15),
        (dt.date(2024, 1, 2), 1, 1, 30.3, 30.3),
        (dt.date(2024, 1, 3), 1, 1, None, None),
    ]


def test_daily_sales_equals_window_distinct_join(done):
    dated = done.withColumn("d", F.to_date("date"))
    counts = dated.groupBy("d").agg(F.count("*"), F.count_distinct("customer_id"))
    w = Window.partitionBy("d")
    amounts = dated.select(
        F.col("d").alias("d2"), F.sum("total_amount").over(w), F.avg("total_amount").over(w)
    ).distinct()
    joined = counts.join(amounts, F.col("d") == F.col("d2"), "left").drop("d2")
    theirs, ours = rows_of(joined), rows_of(sales.daily_sales(done))
    assert [r[:3] for r in theirs] == [r[:3] for r in ours]
    for a, b in zip(theirs, ours):
        assert a[3:] == pytest.approx(b[3:]) if a[3] is not None else b[3:] == (None, None)


def test_daily_stats_counts_dated_days_only(done):
    assert one(sales.daily_stats(sales.daily_sales(done))) == {
        "commandes_moyennes_par_jour": 1.25,
        "max_commandes_jour": 2,
        "min_commandes_jour": 1,
        "nombre_jours_analyses": 3,
    }


def test_best_days_ties_go_to_the_earlier_day(done):
    best = sales.best_days(sales.daily_sales(done), 2).collect()
    assert [r.date_jour.day for r in best] == [1, 2]


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_edge_days_equal_the_full_ranking(done, n):
    undated = done.withColumn("date", F.lit(None).cast("timestamp"))
    for df in (done, done.filter("date is not null"), undated, done.limit(0)):
        daily = sales.daily_sales(df)
        assert sales.first_days(sales.daily_sales(sales.on_edge_days(df, n)), n).collect() == sales.first_days(daily, n).collect()
        latest = sales.daily_sales(sales.on_edge_days(df, n, latest=True))
        assert sales.last_days(latest, n).collect() == sales.last_days(daily, n).collect()


def test_without_amounts_only_counts(done):
    daily = sales.daily_sales(done.drop("total_amount"))
    assert daily.columns == ["date_jour", "nb_commandes", "clients_uniques"]
    assert sales.best_days(daily, 1).first().nb_commandes == 2


def test_order_day_window_keeps_every_order(done):
    out = {r.order_id: r for r in sales.order_day_window(done).collect()}
    assert len(out) == 5
    assert (out["o1"].total_ventes_day, out["o2"].panier_moyen_day) == (30.3, 15.15)
    # a null date is a day of its own in a window
    assert out["o4"].total_ventes_day == 5.0


def test_monthly_first_and_display(spark):
    rows = [(dt.datetime(2023 + m // 12, m % 12 + 1, 1), float(m)) for m in range(15)]
    monthly = sales.monthly_sales(spark.createDataFrame(rows, "date timestamp, total_amount double"))
    first = [r.year_month for r in sales.monthly_first(monthly).collect()]
    assert first[0] == "2023-01" and first[-1] == "2023-12" and len(first) == 12
    shown = sorted(r.year_month for r in sales.monthly_display(monthly).collect())
    assert shown == first[-6:]
    recent = sorted(r.year_month for r in sales.monthly_first(monthly, latest=True).collect())
    assert recent[0] == "2023-04" and recent[-1] == "2024-03"


def test_history_mean(orders):
    history = sales.daily_history(orders, 1, day(3))
    assert rows_of(history) == [("2024-01-02", 30.3), ("2024-01-03", 107.0)]
    assert one(sales.daily_history_mean(history)) == {"hist_avg": 68.65, "n_days": 2}


def test_status_share_and_counts(orders):
    assert rows_of(shares.share(orders, "status")) == [
        (None, 1, 14.29), ("Livré", 1, 14.29), ("annulé", 1, 14.29), ("livré", 4, 57.14),
    ]
    counts = {r.status: r["count"] for r in shares.status_counts(orders).collect()}
    assert counts == {"Inconnu": 1, "Livré": 1, "annulé": 1, "livré": 4}
    assert sum(r.percentage for r in shares.status_counts(orders).collect()) == pytest.approx(100)


def test_payment_mix_null_method_has_no_amounts(orders):
    out = {r.payment_method: r for r in shares.payment_mix(orders).collect()}
    assert (out[None].nombre_commandes, out[None].montant_total, out[None].panier_moyen) == (1, None, None)
    assert out["carte"].montant_total == 30.3
    assert out["paypal"].pourcentage == 42.86


def test_payment_totals_keeps_amounts_of_unnamed(orders):
    out = rows_of(shares.payment_totals(orders).select("payment_method", "count", "total_amount", "avg_amount"))
    assert out == [
        ("Non spécifié", 1, 0.0, None),
        ("Non spécifié", 1, 5.0, 5.0),
        ("carte", 2, 30.3, 15.15),
        ("paypal", 3, 137.3, 137.3 / 3),
    ]


def test_delivered_revenue_of_nothing_has_no_row(done):
    assert reports.delivered_revenue(done.limit(0)).count() == 0
    assert one(reports.delivered_revenue(done)) == {
        "total_sales": 65.6, "avg_order": 16.4, "max_order": 30.3, "min_order": 5.0,
    }


def test_kpis_of_empty_tables(spark, orders):
    empty = orders.limit(0)
    people = spark.createDataFrame([], "customer_id string")
    got = one(reports.basic_statistics(empty, people, people, delivered_like()))
    assert got == {
        "total_orders": 0, "delivered_orders": 0, "delivered_pct": None, "total_customers": 0,
        "total_products": 0, "total_revenue": 0.0, "avg_order_value": 0.0,
    }
    metrics = {r.metric for r in reports.summary_report(empty, people, people, delivered_like()).collect()}
    assert metrics == {"commandes_totales", "commandes_nettoyees", "clients_inscrits", "produits_disponibles"}
    assert one(reports.order_statistics(empty))["Panier_Moyen"] == 0.0
    assert one(reports.quick_kpis(empty, delivered_like()))["total"] is None


def test_summary_report(spark, orders):
    people = spark.createDataFrame([(str(i),) for i in range(8)], "customer_id string")
    got = {r.metric: r.value for r in reports.summary_report(orders, people, people, delivered_like()).collect()}
    assert got["commandes_totales"] == 7 and got["commandes_nettoyees"] == 5
    assert got["clients_actifs"] == 3 and got["taux_activation"] == 37.5
    assert got["chiffre_affaires"] == 65.6 and got["panier_moyen"] == 16.4


def test_daily_totals_add_up(spark, sf_dir):
    from basketry.plans.catalog import QUERIES

    total = QUERIES["delivered_revenue"](spark, sf_dir).first().total_sales
    daily = QUERIES["daily_sales"](spark, sf_dir).agg(exact_sum("total_ventes_day")).first()[0]
    monthly = QUERIES["monthly_sales"](spark, sf_dir).agg(exact_sum("total_sales")).first()[0]
    assert total == daily == monthly


def test_small_amounts_are_not_cut(spark):
    df = spark.createDataFrame([(0.00001,)] * 10, "x double")
    assert df.agg(exact_sum("x")).first()[0] == 0.0001
    assert df.agg(exact_avg("x")).first()[0] == 0.00001


def test_amounts_beyond_decimals_end_no_job(spark):
    rows = [("a", 1.5), ("a", float("nan")), ("b", 1e15), ("b", 0.25), ("c", float("inf")), ("d", 1e300), ("e", -3.0), ("e", 0.1), ("e", 0.2), ("f", 9.5e13)]
    found = {r[0]: r[1] for r in spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert str(found.pop("a")) == "nan"
    assert found == {"b": 1e15 + 0.25, "c": float("inf"), "d": 1e300, "e": -2.7, "f": 9.5e13}


def test_decimals_are_summed_as_decimals(spark):
    df = spark.range(1000).selectExpr("cast(0.000000000000000001 as decimal(30,18)) as x", "cast(0.01 as decimal(10,2)) as y")
    assert tuple(df.agg(exact_sum("x"), exact_sum("y")).first()) == (1e-15, 10.0)


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("cast(id as double) / 7 as x")
    sums = {df.repartition(n).agg(exact_sum("x")).first()[0] for n in (1, 3, 17)}
    assert len(sums) == 1


@pytest.mark.parametrize("bad", ["not a date", ""])
def test_one_rule_for_text_dates(spark, bad):
    from basketry.operators import forecast as fc

    df = spark.createDataFrame([("o1", "c", "2024-02-10 10:00:00", 5.0), ("o2", "c", bad, 7.0)], "order_id string, customer_id string, date string, total_amount double")
    assert len(sales.daily_sales(df).collect()) == 2
    assert [(r.day, r.daily_sales) for r in sales.daily_history(df, 30, dt.datetime(2024, 3, 1)).collect()] == [("2024-02-10", 5.0)]
    assert {r.year_month for r in sales.monthly_sales(df).collect()} == {"2024-02", None}
    for grain in ("order", "day"):
        assert sorted((r.total_amount, r.month) for r in fc.training_features(df, grain).collect()) == [(5.0, 2), (7.0, None)]


@pytest.mark.parametrize("key", ["payment_mix", "payment_totals"])
def test_payments_scan_orders_once(spark, sf_dir, key):
    from basketry.plans.catalog import QUERIES

    df = QUERIES[key](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Scan parquet") - plan.split("Initial Plan")[0].count("ReusedExchange") <= 2
