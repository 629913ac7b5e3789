"""Shards of equal bytes from indivisible groups, by Karmarkar-Karp differencing.

Groups are dealt by hash into buckets of some thousands. In each bucket the two partial partitions of
largest spread are combined again and again, one in descending and one in ascending order of its
sums, until one is left. The buckets' partial partitions are combined in the same way, level by
level, the last one on the driver over at most ``FAN`` rows.

A group above a fixed part of a bucket's share of a shard could outweigh its bucket, and the excesses of
many buckets would add up. Such groups are few (``LARGE`` per shard and bucket at most); they are placed
first, all together, and every bucket starts from its proportion of their sums, so that all buckets
together make up for them. The buckets go in waves of falling size; each starts from what stands after
the waves before, so what these leave uneven does not add up.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.llm.scratch import written

#: Partial partitions combined in one task or on the driver.
FAN = 4096
GROUPS_PER_BUCKET = 16_384
#: Large groups hold more than a bucket's share of a shard divided by this; so many are placed on the driver.
LARGE, ON_DRIVER = 64, 32_768
ROWS_PER_RANGE = 16_384


def differencing(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine n partial partitions (n x k sums); gives the k sums and, for every part, the final place of each of its k subsets."""
    n, k = parts.shape
    sums = [tuple(p) for p in parts.tolist()]
    heap = [(min(s) - max(s), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    made: list[tuple] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        x, y = sums[a], sums[b]
        down = sorted(range(k), key=lambda i: -x[i])
        up = sorted(range(k), key=y.__getitem__)
        both = tuple(x[i] + y[j] for i, j in zip(down, up))
        made.append((a, b, down, up))
        sums.append(both)
        heapq.heappush(heap, (min(both) - max(both), len(sums) - 1))
    places: list = [None] * len(sums)
    places[-1] = list(range(k))
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, down, up = made[node - n]
        of_a, of_b = [0] * k, [0] * k
        for slot, i, j in zip(places[node], down, up):
            of_a[i], of_b[j] = slot, slot
        places[a], places[b], places[node] = of_a, of_b, None
    return np.array(sums[-1], np.int64), np.array(places[:n], np.int32)


def _combined(parts: DataFrame, k: int, base: list[int] | None = None, of: int = 1) -> DataFrame:
    """parts: node, member, sums. Gives (node, member, places) rows, and one (node, null, sums) row per node.

    ``base``: sums that stand already, of which a node takes its proportion of ``of`` bytes; the places
    are then those of the base.
    """

    def combine(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("member")
        sums = np.stack(rows["sums"].to_numpy())
        if base is None:
            total, places = differencing(sums)
        else:
            share = [b * int(sums.sum()) // of for b in base]
            total, places = differencing(np.vstack([sums, share]))
            places = np.argsort(places[-1])[places[:-1]]
        members = [*rows["member"].tolist(), None]
        return pd.DataFrame({"node": key[0], "member": pd.array(members, "Int64"), "places": [*places.tolist(), total.tolist()]})

    return written(parts.groupBy("node").applyInPandas(combine, "node long, member long, places array<long>"), "partial-partitions")


def _by_levels(parts: DataFrame, nodes: int, k: int) -> DataFrame:
    """(member, shard) of parts: node, member, sums."""
    out = _combined(parts, k)
    placed = out.where("member is not null").select("member", "node", F.col("places")[0].alias("shard"))
    while nodes > FAN:
        sums = out.where("member is null").select(F.col("node").alias("member"), F.col("places").alias("sums"))
        out = _combined(sums.select(F.floor(F.col("member") / FAN).alias("node"), "member", "sums"), k)
        up = out.where("member is not null").select(F.col("member").alias("node"), F.col("node").alias("above"), "places")
        placed = placed.join(up, "node").select("member", F.col("above").alias("node"), F.element_at("places", (F.col("shard") + 1).cast("int")).alias("shard"))
        nodes = -(-nodes // FAN)
    last = out.where("member is null").select("node", "places").orderBy("node").collect()  # at most FAN rows
    top = differencing(np.array([r["places"] for r in last], np.int64))[1] if last else np.zeros((0, k))
    of_top = [(int(r["node"]), j, int(top[i][j])) for i, r in enumerate(last) for j in range(k)]
    final = parts.sparkSession.createDataFrame(of_top, "node long, shard long, final int")
    return placed.join(F.broadcast(final), ["node", "shard"]).select("member", F.col("final").alias("shard"))  # FAN x k rows at most


def _placed(groups: DataFrame, n: int, total: int, k: int) -> DataFrame:
    """(member, shard) of n groups: member, bytes."""
    nodes = max(1, -(-n // GROUPS_PER_BUCKET))
    is_large = F.col("bytes").cast("decimal(38,0)") * (LARGE * k * nodes) > F.lit(total)
    large = groups.where(is_large)
    many, of_large = large.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    empty = F.array_repeat(F.lit(0).cast("long"), k - 1)
    parts = lambda rows, m: rows.select(F.pmod("member", F.lit(m)).alias("node"), "member", F.concat(F.array("bytes"), empty).alias("sums"))
    if not many:
        return _by_levels(parts(groups, nodes), nodes, k)
    if many <= ON_DRIVER:
        rows = large.orderBy("member").collect()
        base, placed = differencing(np.array([[r["bytes"]] + [0] * (k - 1) for r in rows], np.int64))
        base = base.tolist()
        first = groups.sparkSession.createDataFrame([(r["member"], int(p[0])) for r, p in zip(rows, placed)], "member long, shard int")
    else:  # more than half are large only with very many shards: then no bucket is finer than another
        first = written(_placed(large, many, of_large, k) if 2 * many < n else _by_levels(parts(large, nodes), nodes, k), "large-groups")
        base = [0] * k
        for r in large.join(first, "member").groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # one per shard
            base[r["shard"]] = r["bytes"]
    placed, begin, left = first.select("member", F.col("shard").cast("int")), 0, total - of_large
    small = groups.where(~is_large)
    while begin < nodes:
        upto = begin + max(1, (nodes - begin) * 7 // 8)
        now = small.where(F.pmod("member", F.lit(nodes)).between(begin, upto - 1))
        out = _combined(parts(now, nodes), k, base, max(1, left)).where("member is not null")
        found = out.select("member", F.col("places")[0].cast("int").alias("shard"))
        if upto < nodes:
            for r in now.join(found, "member").groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # one per shard
                base[r["shard"]] += r["bytes"]
                left -= r["bytes"]
        placed, begin = placed.union(found), upto
    return placed


def shards_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, size (UTF-8 bytes + 1), text_crc32, shard, slot (gapless within its shard).

    Rows of equal text go to one shard; a null text counts as an empty one. Rows without id and
    repeated rows are placed like others. A group larger than a shard's share makes its shard that
    much larger: groups are indivisible. An empty table gives no rows. Other columns are ignored.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.xxhash64(text).alias("member")
    )
    sized = written(sized, "sizes")
    # Texts that share a 64-bit hash would stay together too, which the law allows.
    groups = sized.groupBy("member").agg(F.sum("size").alias("bytes"))
    counted = written(groups, "groups")
    n, total = counted.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    shard_of = _placed(counted, n, total or 0, n_shards)
    rows = sized.join(shard_of, "member").select("id", "size", "crc", "shard")
    ranges = max(1, -(-sized.count() // ROWS_PER_RANGE))
    rows = written(rows.withColumn("range", F.pmod(F.xxhash64("id", "crc"), F.lit(ranges))), "placed")
    # Slots: numbered within (shard, range), ranges one after another. No task sees a whole shard or group.
    counts = rows.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "range", (F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "range").orderBy("id", "crc")) - 1
    numbered = rows.withColumn("within", within).join(before, ["shard", "range"])
    return numbered.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = shards_by_bytes(docs, 8)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
