"""Approximate nearest neighbours by inner product: a neighbour graph from NN-descent, searched greedily.

Equal vectors are one node of the graph. Each node starts with its best neighbours among small random
groups of nodes that lie on the same side of a few random planes. Then neighbours of neighbours are
joined: every node brings together those it points to and those that point to it, and pairs that beat
what a node has are kept. A query starts from the neighbours of its own node; as long as one of its
best finds has not been looked behind, the find's neighbours, on both sides, are scored too.

Lists are kept on both sides short (``DEGREE``); a node that very many point to brings a random part of
them together at a time. This is the approximation of the index; every row is in it, and the scores
that are returned are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.llm.block_search import _matrix
from basketry.llm.scratch import written
from basketry.llm.vectors import usable_vectors

#: Neighbours of a node, rounds of descent, pairs that a node may gain from one meeting.
DEGREE, ROUNDS, GAIN = 48, 4, 8
#: Random groupings at the start, nodes of a group, and neighbours that one grouping gives.
STARTS, GROUP, FIRST = 8, 1024, 20
#: Finds a query keeps, finds it looks behind in a round, rounds at most, and nodes that are scored together.
POOL, LOOK, SEARCH_ROUNDS, BLOCK = 128, 48, 6, 2048


def _lists(values: np.ndarray, n: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(values, kind))


def _binary(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((width * np.arange(len(x) + 1)).astype(np.int32)), pa.py_buffer(x)])


def _vectors(column: pa.Array, kind: str = "<f4") -> np.ndarray:
    """The matrix of a column of binaries of one length."""
    size = np.dtype(kind).itemsize
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, kind)[borders[0] // size : borders[-1] // size].reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def _nodes(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, x, h) of distinct vectors, h being x in half precision, and members (node, id): the k + 1 smallest ids of each node.

    More members than that can never be among the k nearest of a query, as ties go to the smaller id.
    """
    same = Window.partitionBy("v")
    ranked = rows.withColumn("place", F.row_number().over(same.orderBy("id"))).where(F.col("place") <= k + 1)
    grouped = written(ranked.withColumn("node", F.min("id").over(same)), "members")
    width = grouped.agg(F.max(F.size("v"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            with np.errstate(over="ignore"):
                x = np.clip(np.pad(x, ((0, 0), (0, width - x.shape[1]))), -1e18, 1e18).astype("<f4")
                h = np.clip(x, -6e4, 6e4).astype("<f2")
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(x), _binary(h)], ["id", "x", "h"])

    nodes = grouped.where("place = 1").select("id", "v").mapInArrow(pack, "id long, x binary, h binary")
    return written(nodes, "nodes"), grouped.select("node", "id", "v")


def _start(nodes: DataFrame, n: int) -> DataFrame:
    """(id, other, s): the best of each node in ``STARTS`` random groups."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / GROUP))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1))
            for start in range(STARTS):
                planes = np.random.default_rng(start).standard_normal((x.shape[1], bits)).astype("<f4")
                code = (x @ planes > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((code.astype(np.int64) * STARTS) + start)], ["id", "x", "side"])

    dealt = nodes.select("id", "x").mapInArrow(deal, "id long, x binary, side long")
    # A side with many nodes is cut into groups by hash, in proportion to its size.
    sizes = dealt.groupBy("side").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    grouped = dealt.join(sizes, "side").select("id", "x", "side", F.pmod(F.xxhash64("id", "side"), F.col("parts")).alias("part"))

    def best(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _vectors(table.column("x").combine_chunks())
        keep = min(FIRST, len(ids) - 1)
        if not keep:
            return pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "s": pa.array([], pa.float32())})
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        at = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
        return pa.table({"id": np.repeat(ids, keep), "other": ids[at.ravel()], "s": np.take_along_axis(s, at, 1).ravel()})

    return grouped.groupBy("side", "part").applyInArrow(best, "id long, other long, s float")


def _kept(found: DataFrame) -> DataFrame:
    """(id, others, scores, fresh) from rows (id, other, s, fresh): the best ``DEGREE`` different others of each node."""
    rows = found.groupBy("id").agg(F.collect_list(F.struct("other", "s", "fresh")).alias("f"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            n = np.diff(column.offsets.to_numpy())
            other, s, fresh = (c.to_numpy(zero_copy_only=False) for c in column.flatten().flatten())
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((fresh, other, owner))  # what was there before counts as known
            owner, other, s, fresh = owner[order], other[order], s[order], fresh[order]
            one = np.append(True, (owner[1:] != owner[:-1]) | (other[1:] != other[:-1]))[: len(owner)]
            owner, other, s, fresh = owner[one], other[one], s[one], fresh[one]
            order = np.lexsort((other, -s, owner))
            owner, other, s, fresh = owner[order], other[order], s[order], fresh[order]
            m = np.bincount(owner, minlength=len(n))
            use = np.arange(len(owner)) - np.repeat(np.cumsum(m) - m, m) < DEGREE
            m = np.minimum(m, DEGREE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(other[use], m, pa.int64()), _lists(s[use].astype(np.float32), m, pa.float32()), _lists(fresh[use], m, pa.bool_())], ["id", "others", "scores", "fresh"]
            )

    return rows.mapInArrow(cut, "id long, others array<long>, scores array<float>, fresh array<boolean>")


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("id", F.explode(F.arrays_zip("others", "scores", "fresh")).alias("e")).select("id", F.col("e.others").alias("other"), F.col("e.scores").alias("s"), F.col("e.fresh").alias("fresh"))


def _joined(graph: DataFrame, nodes: DataFrame, number: int) -> DataFrame:
    """Rows (id, other, s) that beat what id has, from meetings of neighbours of a common node."""
    edges = _edges(graph)
    worst = graph.select("id", F.when(F.size("scores") < DEGREE, F.lit(float("-inf"))).otherwise(F.array_min("scores")).cast("float").alias("worst"))
    known = nodes.join(worst, "id", "left").select(F.col("id").alias("who"), "h", F.coalesce("worst", F.lit(float("-inf")).cast("float")).alias("worst"))
    # Those that point to a node: a random part, in proportion, where there are more than DEGREE of them.
    pointed = edges.groupBy("other").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DEGREE)
    back = edges.join(pointed, "other", "left").where(
        F.col("n").isNull() | (F.pmod(F.xxhash64("id", "other", F.lit(number)), F.col("n")) < DEGREE)
    ).select(F.col("other").alias("at"), F.col("id").alias("who"), "fresh")
    meet = edges.select(F.col("id").alias("at"), F.col("other").alias("who"), "fresh").union(back)
    rows = meet.join(known, "who").groupBy("at").agg(F.collect_list(F.struct("who", "fresh", "h", "worst")).alias("m"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            cuts = column.offsets.to_numpy()
            who, fresh, x, worst = column.flatten().flatten()
            who, fresh, worst, x, cuts = who.to_numpy(), fresh.to_numpy(zero_copy_only=False), worst.to_numpy(), _vectors(x, "<f2"), cuts - cuts[0]
            out = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                w, new = who[lo:hi], fresh[lo:hi]
                near = x[lo:hi].astype("<f4")
                s = near @ near.T
                good = (s > worst[lo:hi][:, None]) & (new[:, None] | new[None, :]) & (w[:, None] != w[None, :])
                if not good.any():
                    continue
                s[~good] = -np.inf
                gain = min(GAIN, hi - lo)
                at = np.argpartition(-s, gain - 1, axis=1)[:, :gain]
                value = np.take_along_axis(s, at, 1)
                i, j = np.nonzero(value > -np.inf)
                out.append((w[i], w[at[i, j]], value[i, j]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["id", "other", "s"])

    return rows.select("m").mapInArrow(pairs, "id long, other long, s float")


def build_graph(nodes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(id, others, scores, fresh) of each node that has a neighbour, from nodes (id, x, h)."""
    n = nodes.count()
    graph = written(_kept(_start(nodes, n).withColumn("fresh", F.lit(True))), "graph")
    for number in range(rounds):
        old = _edges(graph).withColumn("fresh", F.lit(False))
        graph = written(_kept(old.union(_joined(graph, nodes, number).withColumn("fresh", F.lit(True)))), "graph")
    return graph


def _dot(a: str, b: str) -> Column:
    """Inner product of two array columns in double precision, over the shorter one."""
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p)


def _both_sides(graph: DataFrame) -> DataFrame:
    """(node, beside): the nodes that a node points to, and the ``DEGREE`` nearest that point to it."""
    edges = _edges(graph).select("id", "other", "s")
    nearest_first = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("s"), "id"))
    back = edges.withColumn("place", nearest_first).where(F.col("place") <= DEGREE).select(F.col("other").alias("node"), F.col("id").alias("to"))
    return edges.select(F.col("id").alias("node"), F.col("other").alias("to")).union(back).groupBy("node").agg(F.collect_set("to").alias("beside"))


def _search(graph: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, node): the finds of each query; queries: (query, node), node being the query's own."""
    wanted = written(queries.join(nodes, nodes["id"] == queries["node"]).select("query", F.col("x").alias("q")), "query-vectors")
    near = written(_both_sides(graph), "beside")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("s"), "node"))
    blocks = max(1, nodes.count() // BLOCK)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).alias("block")
    placed = nodes.select("id", "x", block("id")).groupBy("block")

    def score(asked: pa.Table, there: pa.Table) -> pa.Table:
        asked, there = asked.combine_chunks(), there.combine_chunks()
        if not len(asked) or not len(there):
            return pa.table({"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
        ids, x = there.column("id").to_numpy(), _vectors(there.column("x").combine_chunks())
        order = np.argsort(ids)
        lists = asked.column("nodes").combine_chunks()
        n, node = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        owner, at = np.repeat(np.arange(len(n)), n), order[np.searchsorted(ids[order], node)]
        q, s = _vectors(asked.column("q").combine_chunks()), np.empty(len(node))
        for lo in range(0, len(node), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            s[part] = np.einsum("ij,ij->i", q[owner[part]], x[at[part]])
        return pa.table({"query": asked.column("query").to_numpy()[owner], "node": node, "s": s})

    def scored(pairs: DataFrame) -> DataFrame:
        """pairs (query, node) with s. A query's vector travels once for each block of nodes, not for each pair."""
        lists = pairs.groupBy("query", block("node")).agg(F.collect_list("node").alias("nodes"))
        return lists.join(wanted, "query").groupBy("block").cogroup(placed).applyInArrow(score, "query long, node long, s double")

    pool = written(scored(queries).withColumn("looked", F.lit(False)), "search")
    for _ in range(SEARCH_ROUNDS):
        ranked = pool.withColumn("place", rank)
        ahead = ranked.where((F.col("place") <= LOOK) & ~F.col("looked"))
        beyond = ahead.join(near, "node").select("query", F.explode("beside").alias("node")).distinct()
        new = scored(beyond.join(pool, ["query", "node"], "left_anti")).withColumn("looked", F.lit(False))
        seen = ranked.select("query", "node", "s", (F.col("looked") | (F.col("place") <= LOOK)).alias("looked"))
        pool = written(seen.union(new).withColumn("place", rank).where(F.col("place") <= POOL).drop("place"), "search")
        if pool.withColumn("place", rank).where((F.col("place") <= LOOK) & ~F.col("looked")).isEmpty():
            break
    return pool.select("query", "node")


def nearest(vectors: DataFrame, k: int, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each query row, by inner product.

    ``is_query`` is a condition on the column ``id``. Vectors of zeros take no part; ``usable_vectors``
    says what else does not and what repeated rows and ids mean. Ties go to the smaller id. Scores are
    inner products of the original vectors in double precision. Where there are k or fewer candidates
    all of them are found. Vectors of different lengths are compared over the shorter one.
    """
    rows = written(usable_vectors(vectors, id_col, vec_col, zero=False), "vectors")
    nodes, members = _nodes(rows, k)
    graph = build_graph(nodes)
    queries = rows.where(is_query).select(F.col("id").alias("query"), F.col("v").alias("q"))
    own = queries.join(members.select("v", "node").distinct(), queries["q"] == F.col("v")).select("query", "node")
    found = _search(graph, nodes, written(own, "queries"))
    pairs = found.join(members.select("node", "id", "v"), "node").where(F.col("id") != F.col("query")).join(queries, "query")
    exact = pairs.select(F.col("query").alias("query_id"), "id", _dot("q", "v").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return exact.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, 20, F.col("id") % 20 == 0, "vec_id", "embedding").withColumnRenamed("id", "vec_id")
