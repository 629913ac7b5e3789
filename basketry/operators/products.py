"""Product rankings and catalogue listings.

Item operators read flat item facts: one row per sold item with ``product_id``,
``name``, ``price`` and ``quantity``. They also accept facts pre-aggregated per
product and price, where ``n_lines`` says how many items a row stands for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.constants import UNKNOWN
from basketry.functions.columns import first_rows, has_columns, require_columns
from basketry.functions.money import exact_avg, exact_sum


def _lines(items: DataFrame) -> str:
    return "n_lines" if has_columns(items, "n_lines") else "1"


def product_lookup(products: DataFrame) -> DataFrame:
    """Name and price of each product id, one row per id even if it was loaded twice."""
    require_columns(products, "product_id", "name", "price")
    return (
        products.groupBy("product_id")
        .agg(F.min(F.struct("name", "price")).alias("product"))
        .select("product_id", "product.name", "product.price")
    )


def product_item_facts(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Sold quantity and line count per product, with the product's name and price.

    Lines collapse to one row per product before they meet the products, so a
    best-seller holding a third of the lines costs no more than any other.
    """
    per_product = lines.groupBy("product_id").agg(
        F.count("*").alias("n_lines"), F.sum("quantity").alias("quantity")
    )
    return per_product.join(product_lookup(products), "product_id", "left")


def product_sales(items: DataFrame) -> DataFrame:
    """Times sold and quantity per product id and name."""
    require_columns(items, "product_id", "name", "quantity")
    return items.groupBy("product_id", F.col("name").alias("produit")).agg(
        F.expr(f"sum({_lines(items)})").alias("nb_ventes"), F.sum("quantity").alias("quantite_totale")
    )


def top_products_by_count(sales: DataFrame, n: int | None = 10) -> DataFrame:
    return first_rows(sales.orderBy(F.desc("nb_ventes"), F.asc("product_id"), F.asc("produit")), n)


def product_revenue(items: DataFrame) -> DataFrame:
    """Quantity, revenue and mean item price per product id and name."""
    require_columns(items, "product_id", "name", "price", "quantity")
    n = _lines(items)
    revenue = exact_sum("price * quantity")
    priced = F.expr(f"sum(if(price is null, null, {n}))")
    return items.groupBy("product_id", "name").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_sold"),
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue"),
        F.try_divide(exact_sum(f"price * {n}"), priced).alias("avg_price"),
    )


def top_products_by_revenue(items: DataFrame, n: int = 5, unknown: str = UNKNOWN) -> DataFrame:
    top = product_revenue(items).orderBy(F.desc("total_revenue"), F.asc("product_id"), F.asc("name")).limit(n)
    return top.withColumn("name", F.coalesce("name", F.lit(unknown)))


def product_catalog(products: DataFrame, n: int | None = 100) -> DataFrame:
    """Plain product listing, for orders that carry no items."""
    require_columns(products, "product_id", "name", "price", "category")
    return first_rows(products.select("product_id", "name", "price", "category").orderBy("product_id", "name"), n)


def price_statistics(products: DataFrame) -> DataFrame:
    require_columns(products, "price")
    return products.agg(
        F.count("*").alias("Nombre_Produits"),
        exact_avg("price").alias("Prix_Moyen"),
        F.min("price").alias("Prix_Min"),
        F.max("price").alias("Prix_Max"),
    )


def category_distribution(products: DataFrame, column: str = "category") -> DataFrame | None:
    """Products per category or availability; None when the column does not exist."""
    if column not in products.columns:
        return None
    return products.groupBy(column).agg(F.count("*").alias("count"))
