"""Order documents: orders with their line items nested, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.constants import UNKNOWN
from basketry.functions.columns import has_columns, require_columns
from basketry.functions.money import exact_sum
from basketry.operators.lookup import attach_record
from basketry.operators.products import product_lookup

ITEM_FIELDS = ("product_id", "name", "price", "quantity")
#: An order of more lines, and of more than one in so many of all lines, is gathered in parts of about so many.
GATHER_LINES, MOST_LARGE = 100_000, 10_000


def item_lines(lines: DataFrame, products: DataFrame, *others: str) -> DataFrame:
    """Each order line with the name and price of its product, and ``others`` of the line's columns.

    A product on very many lines is split by adaptive execution: the lines are the side that a left
    join may split.
    """
    require_columns(lines, "order_id", "product_id", "quantity")
    return lines.join(product_lookup(products), "product_id", "left").select("order_id", "product_id", "name", "price", "quantity", *others)


def lines_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The lines that belong to the given orders."""
    return lines.join(orders.select("order_id"), "order_id", "left_semi")


def large_orders(lines: DataFrame) -> DataFrame:
    """(order_id, parts) of the orders with very many lines: more than GATHER_LINES and more than one in MOST_LARGE of all.

    So there are fewer than MOST_LARGE of them, however many lines there are.
    """
    total = lines.agg(F.count("*")).scalar()
    sizes = lines.groupBy("order_id").agg(F.count("*").alias("n"))
    return sizes.filter((F.col("n") > GATHER_LINES) & (F.col("n") * MOST_LARGE > total)).select("order_id", F.ceil(F.col("n") / GATHER_LINES).alias("parts"))


def item_part(parts: str = "parts") -> Column:
    """Which of an order's parts a line belongs to; it follows from the line alone."""
    return F.pmod(F.xxhash64("product_id", "quantity"), F.col(parts))


def gathered(items: DataFrame, *keys: str) -> DataFrame:
    """Items of each key as an ordered array, and their total. The amount is multiplied once, below its sums."""
    # Name and price follow from the product, so this is the order of the whole item.
    return items.withColumn("amount", F.col("price") * F.col("quantity")).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("product_id", "name", "price", "quantity"))).alias("items"),
        exact_sum("amount").alias("items_total"),
    )


def large_order_parts(lines: DataFrame, large: DataFrame, products: DataFrame) -> DataFrame:
    """The lines of large orders as ordered partial arrays, each of a part of about GATHER_LINES lines."""
    # Fewer than MOST_LARGE rows are broadcast, see large_orders.
    items = item_lines(lines.join(F.broadcast(large), "order_id").withColumn("part", item_part()), products, "part")
    return gathered(items, "order_id", "part")


def order_documents(orders: DataFrame, lines: DataFrame, products: DataFrame, split_items: int | None = None) -> DataFrame:
    """One document per order: all its items as an ordered array, and their total.

    An order without lines keeps an empty array; ``part`` is 0. An order with very many lines is put
    together in two steps: its parts are gathered and sorted by different tasks, and the document is
    merged from these few sorted arrays.

    With ``split_items`` an order of more lines than that becomes several documents of about that size,
    numbered by ``part``, with ``items_total`` for the items in the document. The number of parts follows
    from the order's line count and an item's part from the item's own product and quantity, so the
    documents are the same on every cluster; an order's parts go to different tasks. Parts without an
    item are not documents.
    """
    zero = F.lit(0).cast("bigint")
    if split_items is not None:
        sizes = lines.groupBy("order_id").agg(F.ceil(F.count("*") / split_items).alias("parts")).filter("parts > 1")
        parted = lines.join(sizes, "order_id", "left").withColumn("part", F.coalesce(item_part(), zero))
        nested = gathered(item_lines(parted, products, "part"), "order_id", "part")
        joined = orders.join(nested, "order_id", "left")
    else:
        large = large_orders(lines)
        # Fewer than MOST_LARGE rows are broadcast, see large_orders.
        ordinary = gathered(item_lines(lines.join(F.broadcast(large), "order_id", "left_anti"), products), "order_id")
        merged = large_order_parts(lines, large, products).groupBy("order_id").agg(
            F.array_sort(F.flatten(F.collect_list("items"))).alias("many"),  # the sort merges what is sorted already
            exact_sum("items_total").alias("many_total"),
        )
        both = orders.join(ordinary, "order_id", "left").join(merged, "order_id", "left")
        joined = both.withColumns({"items": F.coalesce("items", "many"), "items_total": F.coalesce("items_total", "many_total"), "part": zero})
    no_items = F.array().cast(joined.schema["items"].dataType)
    return joined.select(
        "order_id",
        F.coalesce("part", zero).alias("part"),
        *[c for c in orders.columns if c != "order_id"],
        F.coalesce("items", no_items).alias("items"),
        F.coalesce("items_total", F.lit(0.0)).alias("items_total"),
    )


def explode_items(documents: DataFrame, *fields: str) -> DataFrame:
    """Flat item rows of order documents; empty and missing arrays give no row, a null item a row of nulls.

    ``fields`` are those of the item that are wanted, by default all. Only their columns of a stored
    table are read: the fields are taken out of the array one by one and zipped before the explode,
    since a generator over whole items would ask the scan for all of them.
    """
    require_columns(documents, "items")
    fields = fields or ITEM_FIELDS
    others = [c for c in documents.columns if c not in ("items", "part", "items_total")]
    item = F.arrays_zip(*(F.col("items").getField(f).alias(f) for f in fields))
    return documents.select(*others, F.explode(item).alias("item")).select(*others, *(F.col("item").getField(f).alias(f) for f in fields))


def order_item_totals(orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Number of items and the sum of price times quantity per order, without nesting."""
    priced = item_lines(lines, products).select("order_id", (F.col("price") * F.col("quantity")).alias("amount"))
    totals = priced.groupBy("order_id").agg(F.count("*").alias("n_items"), exact_sum("amount").alias("items_total"))
    return orders.select("order_id").join(totals, "order_id", "left").select(
        "order_id",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_total", F.lit(0.0)).alias("items_total"),
    )


def document_item_preview(documents: DataFrame, n_orders: int = 3, per_order: int = 2) -> DataFrame:
    """The first items of the first orders, names cut to thirty characters.

    Documents that share an order (``part``) count as one order, their items numbered from part to part;
    of several unsplit documents under one id the items count together.
    """
    require_columns(documents, "order_id", "items")
    part = F.col("part") if has_columns(documents, "part") else F.lit(0)
    few = documents.select("order_id", part.alias("part"), F.slice("items", 1, per_order).alias("items"))
    first = few.select("order_id").distinct().orderBy("order_id").limit(n_orders)
    # n_orders rows are broadcast; null ids are orders of their own group.
    chosen = few.join(F.broadcast(first.withColumnRenamed("order_id", "chosen")), F.col("order_id").eqNullSafe(F.col("chosen")), "left_semi")
    ranked = chosen.select("order_id", "part", F.posexplode("items").alias("at", "item"))
    number = F.row_number().over(Window.partitionBy("order_id").orderBy("part", "at", "item"))
    shown = ranked.withColumn("position", number).filter(F.col("position") <= per_order)
    return shown.select("order_id", "position", _short_name("item.name"), "item.quantity", "item.price")


def _short_name(column: str) -> Column:
    return F.substring(F.coalesce(column, F.lit(UNKNOWN)), 1, 30).alias("name")


def order_item_preview(
    orders: DataFrame, lines: DataFrame, products: DataFrame, n_orders: int = 3, per_order: int = 2
) -> DataFrame:
    """The first items of the first orders, names cut to thirty characters.

    The orders are cut to ``n_orders`` first, so the broadcast is of that size;
    the row-number filter prunes inside each task before the shuffle; products
    are looked up for the remaining ``n_orders * per_order`` rows only.
    """
    first = orders.select("order_id").orderBy("order_id").limit(n_orders)
    nth = F.row_number().over(Window.partitionBy("order_id").orderBy("product_id", "quantity"))
    shown = (
        lines.join(F.broadcast(first), "order_id", "left_semi")
        .withColumn("position", nth)
        .filter(F.col("position") <= per_order)
        .select("order_id", "position", "product_id", "quantity")
    )
    return attach_record(shown, products, "product_id", F.struct("name", "price")).select(
        "order_id", "position", _short_name("record.name"), "quantity", F.col("record.price").alias("price")
    )
