from __future__ import annotations

import datetime as dt

import pytest

from basketry.operators import customers as cust
from conftest import ORDER_FIELDS, one, rows_of


def order(i, customer, amount, day=1):
    return (f"o{i}", customer, dt.datetime(2024, 1, day), amount, "carte", "livré")


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        order(1, "CUST-001", 10.0),
        order(2, "CUST-001", 20.0),
        order(3, "CUST-001", 30.0, 2),
        order(4, "CUST-002", 60.0),
        order(5, "CUST-9999", 50.0),
        order(6, None, 40.0),
    ]
    return spark.createDataFrame(rows, ORDER_FIELDS)


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        ("CUST-001", "Ines Ben Ali", "Tunis"),
        ("CUST-002", "Ali", None),
        ("CUST-002", "Ali", None),
        ("CUST-003", None, "Sfax"),
    ]
    return spark.createDataFrame(rows, "customer_id string, name string, location string")


def test_segment_borders(spark):
    spends = [99.99, 100.0, 499.99, 500.0, 999.99, 1000.0, None]
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(spends)], "customer_id string, total_depense double")
    labels = [r.segment for r in cust.customer_segments(df).orderBy("customer_id").collect()]
    assert labels == ["Occasionnel", "Actif", "Actif", "Fidèle", "Fidèle", "VIP", "Occasionnel"]


def test_behavior_null_customer_has_no_amounts(orders):
    assert rows_of(cust.customer_behavior(orders)) == [
        (None, 1, 1, None, None),
        ("CUST-001", 3, 2, 60.0, 20.0),
        ("CUST-002", 1, 1, 60.0, 60.0),
        ("CUST-9999", 1, 1, 50.0, 50.0),
    ]


def test_behavior_without_amounts(orders):
    out = cust.customer_behavior(orders.drop("total_amount"))
    assert out.columns == ["customer_id", "nombre_commandes", "jours_achat"]


def test_segment_summary_covers_every_customer(orders):
    segmented = cust.customer_segments(cust.customer_behavior(orders), ((60, "big"), (50, "mid")))
    assert rows_of(cust.segment_summary(segmented)) == [
        ("Occasionnel", 1, None, 1.0), ("big", 2, 60.0, 2.0), ("mid", 1, 50.0, 1.0),
    ]


def test_top_by_orders_breaks_ties_by_id(orders):
    top = cust.top_by_orders(cust.customer_behavior(orders.filter("customer_id is not null")), 2).collect()
    assert [r.customer_id for r in top] == ["CUST-001", "CUST-002"]


def test_top_customers_names_duplicates_and_unknown(orders, people):
    out = {r.customer_id: r for r in cust.top_customers(orders, people, 3).collect()}
    assert len(out) == 3
    assert out["CUST-001"].client_name == "Ines Ben Ali"
    assert out["CUST-002"].client_name == "Ali"  # inserted twice, one row
    assert out["CUST-9999"].client_name == "Client 9999"
    assert (out["CUST-001"].total_spent, out["CUST-001"].order_count) == (60.0, 3)


def test_top_customer_labels(orders, people):
    labels = {r.customer_id: r.label for r in cust.top_customer_labels(orders, people, 3).collect()}
    assert labels == {"CUST-001": "Ines Ben A (", "CUST-002": "Ali", "CUST-9999": "Client 9999"}
    plain = {r.label for r in cust.top_customer_labels(orders, people.drop("location"), 1).collect()}
    assert plain == {"Ines Ben Ali"}


def test_top_customers_of_no_orders(orders, people):
    assert cust.top_customers(orders.limit(0), people).count() == 0


def test_overview_counts_missing_city_as_one(people, spark):
    assert one(cust.customer_overview(people)) == {"n_customers": 4, "n_cities": 3}
    assert one(cust.customer_overview(people.drop("location"))) == {"n_customers": 4, "n_cities": 0}
    assert one(cust.customer_overview(people.limit(0))) == {"n_customers": 0, "n_cities": 0}


def test_by_location(people):
    assert rows_of(cust.customers_by_location(people)) == [(None, 2), ("Sfax", 1), ("Tunis", 1)]
