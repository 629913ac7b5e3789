"""Explicit schemas, as DDL: the retail tables and the star-schema tables they are mapped from."""

from __future__ import annotations

ITEM = "struct<product_id:string,name:string,price:bigint,quantity:bigint>"

ORDERS = (
    "order_id string, customer_id string, date timestamp, "
    f"items array<{ITEM}>, total_amount double, payment_method string, status string"
)
PRODUCTS = (
    "product_id string, name string, category string, description string, "
    "price bigint, stock bigint, supplier string"
)
CUSTOMERS = (
    "customer_id string, name string, email string, phone string, "
    "join_date timestamp, location string"
)
PREDICTIONS = (
    "prediction_id string, predicted_date date, predicted_sales double, day int, month int, "
    "weekday string, model string, features_used array<string>, created_at string"
)

COLLECTIONS = {"orders": ORDERS, "products": PRODUCTS, "customers": CUSTOMERS}

STAR_TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
