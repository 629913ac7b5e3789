from __future__ import annotations

import json
import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.sources import extended_json
from basketry.sources.readers import list_tables, load_collections, load_first, load_table, table_exists
from basketry.sources.writers import Target, export_json, json_rows, replace_table, save_results
from conftest import ITEM, rows_of


@pytest.fixture
def orders(spark):
    rows = [
        ("o1", "c1", dt.datetime(2024, 1, 1, 8, 30), [("P1", "Télé", 10, 2)], 20.0, "carte", "livré"),
        ("o2", "c2", None, None, None, None, "annulé"),
    ]
    return spark.createDataFrame(rows, schemas.ORDERS)


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_round_trip(spark, orders, tmp_path, fmt):
    replace_table(orders, "orders", Target(str(tmp_path), fmt))
    back = load_table(spark, f"{tmp_path}/orders", fmt, schemas.ORDERS)
    assert rows_of(back) == rows_of(orders)


def test_csv_with_explicit_schema(spark, tmp_path):
    (tmp_path / "products.csv").write_text(
        "product_id,name,category,description,price,stock,supplier\nP1,Télé,tv,\"a, b\",399,5,S\n", encoding="utf-8"
    )
    df = load_table(spark, f"{tmp_path}/products.csv", "csv", schemas.PRODUCTS, header=True)
    assert rows_of(df) == [("P1", "Télé", "tv", "a, b", 399, 5, "S")]


def test_first_readable_source_wins(spark, orders, tmp_path):
    orders.write.parquet(f"{tmp_path}/good")
    candidates = [
        {"fmt": "no_such_connector", "database": "shop", "collection": "orders"},
        {"path": f"{tmp_path}/missing"},
        {"path": f"{tmp_path}/good"},
    ]
    assert load_first(spark, candidates, schemas.ORDERS).count() == 2


def test_no_readable_source_gives_typed_empty(spark, tmp_path):
    df = load_first(spark, [{"path": f"{tmp_path}/missing"}], schemas.ORDERS)
    assert df.count() == 0 and df.columns[0] == "order_id" and df.schema["items"].dataType.typeName() == "array"


def test_collections_fall_back_one_by_one(spark, orders, tmp_path):
    orders.write.json(f"{tmp_path}/orders")
    got = load_collections(
        spark,
        [lambda name: {"path": f"{tmp_path}/{name}.parquet"}, lambda name: {"path": f"{tmp_path}/{name}", "fmt": "json"}],
    )
    assert {name: df.count() for name, df in got.items()} == {"orders": 2, "products": 0, "customers": 0}
    assert "join_date" in got["customers"].columns


def test_table_existence(spark, orders, tmp_path):
    orders.write.parquet(f"{tmp_path}/good")
    orders.createOrReplaceTempView("shop_orders")
    assert table_exists(spark, "shop_orders") and not table_exists(spark, "nothing_here")
    assert "shop_orders" in list_tables(spark)
    assert table_exists(spark, f"{tmp_path}/good", "parquet")
    assert not table_exists(spark, f"{tmp_path}/bad", "parquet")
    spark.catalog.dropTempView("shop_orders")


def test_save_results_isolates_failures(spark, orders, tmp_path):
    ok = orders.select("order_id")
    broken = orders.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    results = {"good": ok, "none": None, "empty": ok.limit(0), "broken": broken}
    outcome = save_results(results, Target(str(tmp_path)))
    assert outcome["good"] == "saved" and outcome["none"] == outcome["empty"] == "empty"
    assert outcome["broken"].startswith("failed")
    assert load_table(spark, f"{tmp_path}/analysis_good").count() == 2
    assert not table_exists(spark, f"{tmp_path}/analysis_empty", "parquet")


def test_save_results_tries_the_alternative(spark, orders, tmp_path):
    outcome = save_results(
        {"good": orders}, Target(str(tmp_path), "no_such_connector"), Target(str(tmp_path), "json")
    )
    assert outcome == {"good": "saved (alternative)"}
    assert load_table(spark, f"{tmp_path}/analysis_good", "json", schemas.ORDERS).count() == 2


def test_saving_replaces(spark, orders, tmp_path):
    target = Target(str(tmp_path))
    replace_table(orders, "predictions", target)
    replace_table(orders.limit(1), "predictions", target)
    assert load_table(spark, f"{tmp_path}/predictions").count() == 1


def test_a_failed_replacement_leaves_the_old_rows(spark, orders, tmp_path):
    target = Target(str(tmp_path))
    replace_table(orders, "predictions", target)
    half = spark.range(0, 1000, 1, 10).select(F.when(F.col("id") > 900, F.raise_error(F.lit("boom")).cast("string")).otherwise("x").alias("order_id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(half, "predictions", target)
    assert rows_of(load_table(spark, f"{tmp_path}/predictions", schema=schemas.ORDERS)) == rows_of(orders)
    assert [p.name for p in tmp_path.iterdir()] == ["predictions"]  # nothing is left beside it


def test_an_empty_result_touches_no_table(spark, orders, tmp_path):
    target = Target(str(tmp_path))
    assert save_results({"a": orders}, target) == {"a": "saved"}
    assert save_results({"a": orders.limit(0), "b": orders.filter("order_id = 'none'")}, target) == {"a": "empty", "b": "empty"}
    assert load_table(spark, f"{tmp_path}/analysis_a").count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["analysis_a"]
    replace_table(orders.limit(0), "analysis_a", target)  # a replacement may be empty
    assert load_table(spark, f"{tmp_path}/analysis_a", schema=schemas.ORDERS).count() == 0


def test_a_result_is_evaluated_once(spark, orders, tmp_path):
    rows = orders.groupBy("status").agg(F.count("*").alias("n"))  # a shuffle: one more job would show
    spark.sparkContext.setJobGroup("once", "saving")
    try:
        rows.write.parquet(f"{tmp_path}/plain")
        plain = len(spark.sparkContext.statusTracker().getJobIdsForGroup("once"))
        spark.sparkContext.setJobGroup("saved", "saving")
        assert save_results({"a": rows}, Target(str(tmp_path))) == {"a": "saved"}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("saved")) == plain
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not rows.is_cached


def test_json_export_keeps_nulls_accents_and_nesting(spark, orders, tmp_path):
    with_id = orders.withColumn("_id", F.struct(F.lit("abc").alias("oid")))
    export_json(with_id, f"{tmp_path}/out")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    docs = {d["order_id"]: d for d in map(json.loads, lines)}
    assert docs["o1"]["items"] == [{"product_id": "P1", "name": "Télé", "price": 10, "quantity": 2}]
    assert docs["o1"]["date"] == "2024-01-01 08:30:00" and docs["o1"]["_id"] == "{abc}"
    assert docs["o2"]["items"] is None and docs["o2"]["total_amount"] is None
    assert any("Télé" in line for line in lines)


def test_json_rows(spark):
    df = spark.createDataFrame([("é", None, [("P", None, 1, 2)])], f"a string, b int, items array<{ITEM}>")
    assert json.loads(json_rows(df).first().json) == {
        "a": "é", "b": None, "items": [{"product_id": "P", "name": None, "price": 1, "quantity": 2}],
    }


EXPORT = [
    '{"_id":{"$oid":"65a1b2c3d4e5f60718293a4b"},"order_id":"ORD-1","customer_id":"CUST-1","date":{"$date":"2024-01-02T08:30:00.250Z"},'
    '"items":[{"product_id":"P1","name":"Télé","price":{"$numberInt":"10"},"quantity":{"$numberLong":"2"}}],"total_amount":{"$numberDecimal":"20.50"},"payment_method":"carte","status":"livré"}',
    '{"order_id":"ORD-2","date":{"$date":{"$numberLong":"1704184200250"}},"items":[],"total_amount":{"$numberDouble":"NaN"},"status":null}',
    '{"order_id":"ORD-3","date":{"$date":1704184200250},"items":[{"product_id":"P2","price":3,"quantity":1},null],"total_amount":7}',
    '{"order_id":{"$oid":"65a1b2c3d4e5f60718293a4c"},"date":"2024-01-02 08:30:00.250","items":null,"total_amount":"free","customer_id":12,"payment_method":{"kind":"carte"}}',
    "", "   ", "not json", "[1]", '"text"',
]


def test_store_export_types(spark, tmp_path):
    (tmp_path / "orders.json").write_text("\n".join(EXPORT), encoding="utf-8")
    schema = "_id string, " + schemas.ORDERS
    at = dt.datetime(2024, 1, 2, 8, 30, 0, 250_000)
    found = {r.order_id: r for r in load_table(spark, f"{tmp_path}/orders.json", "extended-json", schema).collect()}
    assert len(found) == 4 and {r.date for r in found.values()} == {at}
    first = found["ORD-1"]
    assert (first["_id"], first.total_amount, first.status) == ("65a1b2c3d4e5f60718293a4b", 20.5, "livré")
    assert [tuple(i) for i in first["items"]] == [("P1", "Télé", 10, 2)]
    assert found["ORD-2"].total_amount != found["ORD-2"].total_amount and found["ORD-2"]["items"] == [] and found["ORD-2"].status is None
    assert [i and tuple(i) for i in found["ORD-3"]["items"]] == [("P2", None, 3, 1), None] and found["ORD-3"].total_amount == 7.0
    other = found["65a1b2c3d4e5f60718293a4c"]
    assert (other["items"], other.total_amount, other.customer_id, other.payment_method) == (None, None, "12", '{"kind":"carte"}')
    lines = spark.read.text(f"{tmp_path}/orders.json")
    assert extended_json.rejected_lines(lines).first()["n_rejected"] == 3
    marks = {r.mark: r.n_lines for r in extended_json.marked_keys(lines).collect()}
    assert marks == {"$oid": 2, "$date": 3, "$numberInt": 1, "$numberLong": 2, "$numberDouble": 1, "$numberDecimal": 1}


def test_store_export_decimals_dates_and_flags(spark):
    schema = "a decimal(10,2), b date, c boolean, d array<array<int>>, e struct<f:timestamp_ntz,g:string>"
    lines = ['{"a":{"$numberDecimal":"12.34"},"b":{"$date":"2024-02-29T23:00:00Z"},"c":true,"d":[[1,{"$numberInt":"2"}],[]],"e":{"f":{"$date":0},"g":{"$date":"2024-01-01T00:00:00Z"}}}', '{"c":"maybe","e":[1]}']
    got = extended_json.parsed_lines(spark.createDataFrame([(x,) for x in lines], "value string"), schema).collect()
    assert str(got[0].a) == "12.34" and got[0].b == dt.date(2024, 2, 29) and got[0].c is True and got[0].d == [[1, 2], []]
    assert (got[0].e.f, got[0].e.g) == (dt.datetime(1970, 1, 1), "2024-01-01T00:00:00.000Z")
    assert tuple(got[1]) == (None, None, None, None, None)
    with pytest.raises(TypeError, match="map"):
        extended_json.parsed_lines(spark.createDataFrame([("{}",)], "value string"), "a map<string,int>")


def test_both_exports_come_back(spark, orders, tmp_path):
    export_json(orders, f"{tmp_path}/plain")
    extended_json.export_lines(orders).write.text(f"{tmp_path}/marked")
    for name in ("plain", "marked"):
        back = load_table(spark, f"{tmp_path}/{name}", "extended-json", schemas.ORDERS)
        assert back.schema.simpleString() == orders.schema.simpleString() and rows_of(back) == rows_of(orders)
    got = load_collections(spark, [lambda name: {"path": f"{tmp_path}/{name}"}, lambda name: {"path": f"{tmp_path}/marked", "fmt": "extended-json"}])
    assert got["orders"].count() == 2
