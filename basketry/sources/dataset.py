"""Canonical retail views over a directory of star-schema parquet tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.schemas import STAR_TABLES
from basketry.sources.readers import load_table


@dataclass(frozen=True)
class Dataset:
    """Lazy views; a table is opened when a view over it is first used."""

    spark: SparkSession
    directory: str

    def _table(self, name: str) -> DataFrame:
        return load_table(self.spark, f"{self.directory}/{name}.parquet", schema=STAR_TABLES[name])

    @cached_property
    def orders(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("date"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with the name of their nation and the time of their first signup.

        Both lookups are unique on their join key, so Catalyst drops a join
        whose columns are not asked for: counting customers reads no events.
        """
        nations = (
            self._table("nation")
            .groupBy(F.col("n_nationkey").alias("c_nationkey"))
            .agg(F.min("n_name").alias("location"))
        )
        signups = (
            self._table("events")
            .filter(F.col("event_type") == "signup")
            .groupBy(F.col("user_id").alias("c_custkey"))
            .agg(F.min("ts").alias("join_date"))
        )
        return (
            self._table("customer")
            .join(nations, "c_nationkey", "left")
            .join(signups, "c_custkey", "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("name"),
                "location",
                "join_date",
            )
        )

    def collections(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "orders": self.orders, "products": self.products}


def load_dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    return Dataset(spark, sf_dir)
