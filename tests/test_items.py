"""Order documents, item rows and product rankings."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import documents, products as prod
from conftest import ITEM, one, rows_of

DOC_FIELDS = f"order_id string, status string, items array<{ITEM}>"


@pytest.fixture(scope="module")
def docs(spark):
    a, b = ("P1", "Alpha", 10, 2), ("P2", "Beta", 20, 1)
    rows = [
        ("o1", "livré", [a, b, a]),
        ("o2", "livré", [("P1", "Alpha", 12, 1)]),
        ("o3", "livré", []),
        ("o4", "livré", None),
        ("o5", "annulé", [("P3", None, 5, 7)]),
    ]
    return spark.createDataFrame(rows, DOC_FIELDS)


@pytest.fixture(scope="module")
def catalogue(spark):
    rows = [("P1", "Alpha", "tv", 10.5), ("P2", "Beta", "tv", 20.0), ("P3", "Gamma", None, 5.0)]
    return spark.createDataFrame(rows, "product_id string, name string, category string, price double")


def test_explode_drops_empty_and_missing(docs):
    items = documents.explode_items(docs)
    assert items.columns == ["order_id", "status", "product_id", "name", "price", "quantity"]
    assert items.groupBy("order_id").count().count() == 3
    assert items.count() == 5


def test_only_the_wanted_fields_of_stored_items_are_read(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/orders")
    stored = spark.read.schema(docs.schema).parquet(f"{tmp_path}/orders")
    counted = documents.explode_items(stored.select("items"), "product_id", "quantity").groupBy("product_id").agg(F.sum("quantity").alias("n"))
    assert rows_of(counted) == [("P1", 5), ("P2", 1), ("P3", 7)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<items:array<struct<product_id:string,quantity:bigint>>>" in plan
    sales = prod.product_sales(documents.explode_items(stored.select("items"), "product_id", "name", "quantity"))
    assert "price" not in sales._jdf.queryExecution().executedPlan().toString()


def test_a_null_item_is_a_row_of_nulls(spark):
    docs = spark.createDataFrame([("o1", "livré", [None, ("P1", "Alpha", 10, 2)])], DOC_FIELDS)
    assert rows_of(documents.explode_items(docs)) == [("o1", "livré", None, None, None, None), ("o1", "livré", "P1", "Alpha", 10, 2)]


def test_product_sales_counts_lines(docs):
    sales = prod.product_sales(documents.explode_items(docs))
    assert rows_of(sales) == [("P1", "Alpha", 3, 5), ("P2", "Beta", 1, 1), ("P3", None, 1, 7)]
    assert [r.product_id for r in prod.top_products_by_count(sales, 2).collect()] == ["P1", "P2"]


def test_product_revenue_uses_the_price_of_each_item(docs):
    top = prod.top_products_by_revenue(documents.explode_items(docs)).collect()
    assert [(r.name, r.total_sold, r.total_revenue) for r in top] == [
        ("Alpha", 5, 52.0), ("Inconnu", 7, 35.0), ("Beta", 1, 20.0),
    ]
    assert top[0].avg_price == pytest.approx(32 / 3)


def test_preaggregated_facts_give_the_same_ranking(spark, catalogue):
    lines = spark.createDataFrame(
        [("o1", "P1", 2.0), ("o1", "P1", 3.0), ("o2", "P2", 1.0), ("o3", "P9", 4.0)],
        "order_id string, product_id string, quantity double",
    )
    facts = prod.product_item_facts(lines, catalogue)
    flat = documents.item_lines(lines, catalogue)
    assert rows_of(prod.product_sales(facts)) == rows_of(prod.product_sales(flat))
    assert rows_of(prod.product_revenue(facts)) == rows_of(prod.product_revenue(flat))


def test_a_product_loaded_twice_does_not_repeat_lines(spark, catalogue):
    lines = spark.createDataFrame([("o1", "P1", 2), ("o1", "P2", 1)], "order_id string, product_id string, quantity bigint")
    twice = catalogue.unionByName(catalogue)
    assert rows_of(documents.item_lines(lines, twice)) == rows_of(documents.item_lines(lines, catalogue))
    assert rows_of(prod.product_item_facts(lines, twice)) == rows_of(prod.product_item_facts(lines, catalogue))


def test_catalogue_listings(catalogue):
    assert prod.product_catalog(catalogue, 2).count() == 2
    assert rows_of(prod.category_distribution(catalogue)) == [(None, 1), ("tv", 2)]
    assert prod.category_distribution(catalogue, "available") is None
    stocked = catalogue.withColumn("available", F.col("price") > 6)
    assert rows_of(prod.category_distribution(stocked, "available")) == [(False, 1), (True, 2)]
    assert one(prod.price_statistics(catalogue)) == {
        "Nombre_Produits": 3, "Prix_Moyen": 35.5 / 3, "Prix_Min": 5.0, "Prix_Max": 20.0,
    }


@pytest.fixture(scope="module")
def flat(spark):
    orders = spark.createDataFrame(
        [(f"o{i}", dt.datetime(2024, 1, 1)) for i in range(40)], "order_id string, date timestamp"
    )
    # Order o0 holds most lines; o39 has none.
    lines = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("o0")).otherwise(F.concat(F.lit("o"), (F.col("id") % 39).cast("string"))).alias("order_id"),
        F.concat(F.lit("P"), (F.col("id") % 3 + 1).cast("string")).alias("product_id"),
        (F.col("id") % 5 + 1).alias("quantity"),
    )
    return orders, lines


@pytest.mark.parametrize("split", [None, 7, 10_000])
def test_documents_hold_every_line(flat, catalogue, split):
    orders, lines = flat
    docs = documents.order_documents(orders, lines, catalogue, split).cache()
    assert docs.count() == docs.select("order_id", "part").distinct().count()
    back = documents.explode_items(docs).drop("date")
    assert rows_of(back) == rows_of(documents.item_lines(lines, catalogue))
    totals = docs.groupBy("order_id").agg(F.sum(F.size("items")).alias("n"), F.round(F.sum("items_total"), 4).alias("t"))
    assert rows_of(totals) == rows_of(documents.order_item_totals(orders, lines, catalogue))
    empty = docs.filter(F.size("items") == 0).collect()
    assert [(r.order_id, r.part, r["items"], r.items_total) for r in empty] == [("o39", 0, [], 0.0)]
    if split != 7:
        assert docs.count() == 40
    docs.unpersist()


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(documents, "GATHER_LINES", 100)


def test_large_orders_are_the_same_documents(flat, catalogue, spark, monkeypatch):
    orders, lines = flat
    whole = rows_of(documents.order_documents(orders, lines, catalogue))
    monkeypatch.setattr(documents, "GATHER_LINES", 100)
    assert [tuple(r) for r in documents.large_orders(lines).collect()] == [("o0", 16)]
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    for partitions, given in ((3, lines), (8, lines.repartition(5)), (200, lines.repartition(2, "product_id"))):
        spark.conf.set(key, str(partitions))
        assert rows_of(documents.order_documents(orders, given, catalogue)) == whole
    spark.conf.set(key, before)


def test_no_task_gathers_a_large_order(spark, catalogue, small_parts):
    """A third of 30,000 lines in one order: its parts hold about as many lines each, in different groups."""
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), (F.col("id") % 5000).cast("string"))).alias("order_id"),
        F.concat(F.lit("P"), (F.col("id") % 997).cast("string")).alias("product_id"),
        (F.col("id") % 7 + 1).alias("quantity"),
    )
    large = documents.large_orders(lines)
    assert [r.order_id for r in large.collect()] == ["hot"]
    sizes = sorted(r.n for r in documents.large_order_parts(lines, large, catalogue).select(F.size("items").alias("n")).collect())
    assert sum(sizes) == 10_000 and len(sizes) == 100 and sizes[-1] < 2 * sizes[50]
    orders = spark.createDataFrame([("hot",), ("o1",), ("none",)], "order_id string")
    found = {r.order_id: len(r["items"]) for r in documents.order_documents(orders, lines, catalogue).collect()}
    assert found == {"hot": 10_000, "o1": lines.filter("order_id = 'o1'").count(), "none": 0}


def test_no_order_is_large_by_number_alone(flat, monkeypatch):
    monkeypatch.setattr(documents, "GATHER_LINES", 1)
    monkeypatch.setattr(documents, "MOST_LARGE", 2)
    assert [r.order_id for r in documents.large_orders(flat[1]).collect()] == ["o0"]


def test_documents_do_not_depend_on_the_cluster(flat, catalogue, spark):
    orders, lines = flat
    key, found = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    for partitions, given in ((3, lines), (8, lines.repartition(5)), (200, lines.repartition(2, "product_id"))):
        spark.conf.set(key, str(partitions))
        found.append(rows_of(documents.order_documents(orders, given, catalogue, 100)))
    spark.conf.set(key, before)
    assert found[0] == found[1] == found[2]


def test_preview_of_split_documents(spark, catalogue, flat):
    orders, lines = flat
    whole = documents.order_documents(orders, lines, catalogue)
    split = documents.order_documents(orders, lines, catalogue, 10)
    shown = documents.document_item_preview(split, 3, 2)
    assert [(r.order_id, r.position) for r in shown.orderBy("order_id", "position").collect()] == [(o, p) for o in ("o0", "o1", "o10") for p in (1, 2)]
    assert documents.document_item_preview(whole, 3, 2).count() == 6


def test_item_queries_need_no_window_and_run_nothing_early(spark, sf_dir):
    from basketry.plans.catalog import QUERIES

    plan = QUERIES["exploded_items"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_a_hot_product_is_split_by_adaptive_execution(spark, no_broadcast):
    lines = spark.range(200_000).select(F.col("id").cast("string").alias("order_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5_000).alias("product_id"), F.lit(1).alias("quantity"))
    products = spark.range(5_000).select(F.col("id").alias("product_id"), F.lit("n").alias("name"), F.lit(1.0).alias("price"))
    settings = {"skewedPartitionThresholdInBytes": "64k", "skewedPartitionFactor": "1.5"}
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.adaptive.skewJoin.{k}", v)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    joined = documents.item_lines(lines, products)
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    for k in settings:
        spark.conf.unset(f"spark.sql.adaptive.skewJoin.{k}")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert "skew=true" in plan


def test_items_are_ordered_and_totalled(spark, catalogue):
    orders = spark.createDataFrame([("o1",)], "order_id string")
    lines = spark.createDataFrame(
        [("o1", "P2", 1), ("o1", "P1", 3), ("o1", "P1", 2)], "order_id string, product_id string, quantity bigint"
    )
    doc = documents.order_documents(orders, lines, catalogue).first()
    assert [(i.product_id, i.quantity) for i in doc["items"]] == [("P1", 2), ("P1", 3), ("P2", 1)]
    assert doc.items_total == 10.5 * 5 + 20.0 == sum(i.price * i.quantity for i in doc["items"])


def test_previews(docs, spark, catalogue):
    shown = documents.document_item_preview(docs, 2, 2)
    assert rows_of(shown.select("order_id", "position", "name")) == [
        ("o1", 1, "Alpha"), ("o1", 2, "Beta"), ("o2", 1, "Alpha"),
    ]
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    lines = spark.createDataFrame(
        [("o1", "P3", 1), ("o1", "P1", 1), ("o1", "P2", 1), ("o2", "P8", 1)],
        "order_id string, product_id string, quantity bigint",
    )
    flat = documents.order_item_preview(orders, lines, catalogue, 2, 2)
    assert rows_of(flat.select("order_id", "position", "name")) == [
        ("o1", 1, "Alpha"), ("o1", 2, "Beta"), ("o2", 1, "Inconnu"),
    ]
