"""Exact top-k by integer inner product, block at a time with pruning.

The dimensions are the terms. Vectors are renumbered so that similar ones stand together and cut into
ranges (blocks). A block keeps the largest and smallest value of each term, which bound the score of
all its vectors for a query, and a forward index (its matrix). Blocks are ordered by bound and scored
for the queries whose bound reaches their k-th best score.

Blocks lie in groups, groups are dealt over slabs, queries lie in chunks. A task holds a slab and all
chunks pass it, so that vectors travel once in each pass, and queries once for each slab. A first pass
scores only each query's best block of every few groups; a score that k other vectors reach by it is the
threshold from which the second pass starts, which leaves out no block whose bound reaches it. Products are made in the narrowest numbers that hold all
their sums exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.llm.scratch import written
from basketry.llm.vectors import usable_vectors

SCALE, BLOCK, BLOCKS, CHUNK, CODE_BITS, MOST_TILES = 1024, 128, 16, 512, 8, 4096
#: Numbers in a slab; groups that the first pass takes as one; blocks in a product; chunks scored together in the first and in the second pass.
SLAB, SPAN, RUN, OPENING, TOGETHER = 2**24, 4, 4, 8, 2
#: Sums of float32 and float64 products are exact below these; larger ones are made of Python's integers.
EXACT32, EXACT = float(2**24), float(2**53)
LONG = 2**63


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column; shorter vectors are filled up with zeros."""
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(n) and (n == n[0]).all():
        return flat.reshape(len(n), n[0])
    out = np.zeros((len(n), int(n.max(initial=0))))
    out[np.arange(out.shape[1]) < n[:, None]] = flat
    return out


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in two bytes if they fit, else as they are."""
    return x.astype("<i2") if np.abs(x).max(initial=0) < 2**15 else x


def _numbers(held: bytes, n: int) -> np.ndarray:
    return np.frombuffer(held, "<i2" if len(held) == 2 * n else "<f8")


def _joined(held: list[bytes], width: np.ndarray) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    w = int(width.max(initial=0))
    if (width == w).all() and len({len(h) for h in held}) == 1:
        return _numbers(b"".join(held), len(held) * w).reshape(len(held), w)
    x = np.zeros((len(held), w))
    for row, h, n in zip(x, held, width):
        row[:n] = _numbers(h, n)
    return x


def _coded(rows: DataFrame) -> DataFrame:
    """(id, code, width, x): the signs of a few fixed projections, and the components as floor(1024 x) in a binary."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            planes = np.random.default_rng(7).standard_normal((x.shape[1], CODE_BITS))
            with np.errstate(over="ignore", invalid="ignore"):
                signs = x @ planes > 0
                x = _narrow(np.floor(SCALE * x))
            width = pa.array(np.full(len(x), x.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signs @ (1 << np.arange(CODE_BITS)), pa.int64()), width, pa.array([r.tobytes() for r in x], pa.binary())], ["id", "code", "width", "x"])

    return rows.mapInArrow(code, "id long, code long, width int, x binary")


def _arranged(coded: DataFrame) -> DataFrame:
    """Rows in an order that brings similar vectors together: by code, then by id."""
    return coded.repartitionByRange("code", "id").sortWithinPartitions("code", "id").drop("code")


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """(part, place, size, width, ids, x): consecutive rows of (id, width, x), ``most`` at a time; ``place`` counts within a part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, len(batch), most):
                some = batch.slice(lo, most)
                x = _narrow(_joined(some.column(2).to_pylist(), some.column(1).to_numpy()))
                held = [part, place, len(some), x.shape[1], some.column(0).to_numpy().astype("<i8").tobytes(), x.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([h], t) for h, t in zip(held, [pa.int32()] * 4 + [pa.binary()] * 2)], ["part", "place", "size", "width", "ids", "x"])
                place += 1

    return rows.select("id", "width", "x").mapInArrow(pack, "part int, place int, size int, width int, ids binary, x binary")


def _best(owner: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries of each owner: high score first, then small id."""
    order = np.lexsort((ident, -score, owner))
    owner = owner[order]
    first = np.append(True, owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    rank = np.arange(len(owner)) - np.repeat(at, np.diff(np.append(at, len(owner))))
    return order[rank < k]


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows; a product of two lengths is more than any sum of products of their components, in any order."""
    x = x.astype(np.float64, copy=False)
    with np.errstate(over="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", x, x)) * (1 + 1e-9)


def _floats(score: np.ndarray) -> np.ndarray:
    """Doubles; integers beyond a double's range become its ends."""
    if score.dtype != object:
        return score.astype(np.float64, copy=False)
    most = float(np.finfo(np.float64).max)
    return np.array([float(max(-most, min(most, s))) for s in score.flat], np.float64).reshape(score.shape)


def _lowered(kth: np.ndarray) -> np.ndarray:
    """No more than the score that was rounded to a double: beyond exactness lowered by more than the rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.where(np.abs(kth) < EXACT, kth, kth - np.abs(kth) * 1e-12)


class _Group:
    """Blocks of vectors with the bounds of each block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x.astype(np.float32) if x.dtype == np.int16 else x
        self.starts = np.arange(0, len(x), BLOCK)
        self.high, self.low = np.maximum.reduceat(self.x, self.starts), np.minimum.reduceat(self.x, self.starts)
        self.norm = _norms(self.x).max()


class _Queries:
    """Queries with the k best that each has found so far; ``kth`` is a score that the k-th best reaches at least."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.ids, self.x, self.kth, self.k = ids, x.astype(np.float32) if x.dtype == np.int16 else x, floor.astype(np.float64), k
        self.norms, self.all, self.scored = _norms(self.x), np.arange(len(ids)), 0
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.waiting, self.rooms = 0, {}

    def bounds(self, groups: list[_Group]) -> np.ndarray:
        """No query scores more than this with any vector of a block; blocks of all groups side by side."""
        d = min(self.x.shape[1], max(g.x.shape[1] for g in groups))
        high, low = (np.concatenate([np.pad(b[:, :d], ((0, 0), (0, max(0, d - b.shape[1])))) for b in side]) for side in zip(*((g.high, g.low) for g in groups)))
        with np.errstate(over="ignore", invalid="ignore"):
            most = self.norms * _norms(np.maximum(np.abs(high), np.abs(low))).max(initial=0)
            kind = np.float32 if most.max(initial=0) < EXACT32 else np.float64
            q = self.x[:, :d].astype(kind, copy=False)
            out = np.hstack([np.maximum(q, 0), np.minimum(q, 0)]) @ np.hstack([high, low]).T.astype(kind, copy=False)
            if not (most < EXACT).all():  # raised by more than the rounding
                out = np.nan_to_num(out + (most * max(1, d) * 2.0**-50)[:, None], nan=np.inf, posinf=np.inf)
        return out

    def room(self, kind: type, n: int) -> np.ndarray:
        """Memory for a product, used again and again."""
        if kind not in self.rooms or len(self.rooms[kind]) < n:
            self.rooms[kind] = np.empty(max(n, len(self.all) * BLOCK), kind)
        return self.rooms[kind][:n]

    def products(self, rows: np.ndarray, group: _Group, at: slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(some of the rows, their scores with some vectors of a group), split by the numbers that the sums need."""
        d = min(self.x.shape[1], group.x.shape[1])
        self.scored += len(rows) * -(-len(group.ids[at]) // BLOCK)
        with np.errstate(over="ignore", invalid="ignore"):
            most = self.norms[rows] * group.norm
        if (most < EXACT32).all():
            kinds = [(np.float32, rows)]
        else:
            kinds = [(np.float32, rows[most < EXACT32]), (np.float64, rows[(most >= EXACT32) & (most < EXACT)]), (object, rows[~(most < EXACT)])]
        for kind, rows in kinds:
            if not len(rows):
                continue
            q, x = (self.x if rows is self.all else self.x[rows])[:, :d], group.x[at, :d]
            if kind is object:
                yield rows, _integers(q) @ _integers(x).T
            else:
                room = self.room(kind, len(q) * len(x)).reshape(len(q), len(x))
                yield rows, np.matmul(q.astype(kind, copy=False), x.astype(kind, copy=False).T, out=room)

    def score(self, rows: np.ndarray, group: _Group, at: slice) -> None:
        """Meet some vectors of a group."""
        for rows, s in self.products(rows, group, at):
            with np.errstate(over="ignore"):
                kth = self.kth[rows].astype(s.dtype)
            some = np.flatnonzero(s.max(axis=1) >= kth)
            if not len(some):
                continue
            s = s[some]
            i, j = np.nonzero(s >= kth[some][:, None])
            owner, ident = rows[some[i]], group.ids[at][j]
            other = ident != self.ids[owner]
            self.found.append((owner[other], ident[other], s[i, j][other].astype(object if s.dtype == object else np.float64)))
            self.waiting += int(other.sum())

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's place, id, score) of the best so far, in order; ``kth`` follows."""
        owner, ident, score = (np.concatenate(c) for c in zip(*self.found))
        keep = _best(owner, score, ident, self.k)
        owner, ident, score = self.found[0] = owner[keep], ident[keep], score[keep]
        self.found, self.waiting = self.found[:1], 0
        full = np.flatnonzero(np.bincount(owner, minlength=len(self.ids)) == self.k)
        if len(full):  # entries lie in order, the k-th of an owner is its last
            last = np.searchsorted(owner, full, side="right") - 1
            self.kth[full] = np.maximum(self.kth[full], _lowered(_floats(score[last])))
        return owner, ident, score

    def by_block(self, block: np.ndarray, live: np.ndarray, groups: list[_Group], ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(some of the live queries, their scores with the block that each has)."""
        live = live[np.argsort(block[live], kind="stable")]
        found, cuts = np.unique(block[live], return_index=True)
        for b, rows in zip(found, np.split(live, cuts[1:])):
            i = np.searchsorted(ends, b, side="right")
            start = groups[i].starts[b - ends[i]]  # counted from the end
            yield from self.products(rows, groups[i], slice(start, start + BLOCK))

    def open(self, groups: list[_Group], bounds: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each query scores that k + 1 vectors of a slab reach, one of which may be the query itself; -inf where there are fewer.

        These are the best of its best block, and the best score of its best block of every few groups.
        """
        n, spans = self.k + 1, range(0, len(groups), SPAN)
        most, first = np.full((len(self.ids), n + len(spans)), -np.inf), bounds.argmax(axis=1)
        for rows, s in self.by_block(first, self.all, groups, ends):
            best = s if s.shape[1] <= n else -np.partition(-s, n - 1, axis=1)[:, :n]
            most[rows, : best.shape[1]] = _floats(best)
        kth = most[:, :n].min(axis=1)
        for i, lo in enumerate(spans):
            begin, end = ends[lo] - len(groups[lo].starts), ends[min(lo + SPAN, len(groups)) - 1]
            block = begin + bounds[:, begin:end].argmax(axis=1)
            live = np.flatnonzero((bounds[self.all, block] >= kth) & (block != first))
            for rows, s in self.by_block(block, live, groups, ends):
                most[rows, n + i] = _floats(s.max(axis=1))
        return -np.partition(-most, n - 1, axis=1)[:, :n]

    def meet(self, group: _Group, bounds: np.ndarray) -> None:
        """Meet the blocks of a group that may have one of the best; while a query has no k-th score, one by one from the best bound."""
        order, done = np.argsort(-bounds.max(axis=0), kind="stable"), 0
        while done < len(order) and (self.kth == -np.inf).any():
            b = order[done]
            rows = np.flatnonzero(bounds[:, b] >= self.kth)
            if len(rows):
                self.score(rows, group, slice(group.starts[b], group.starts[b] + BLOCK))
                self.settle()
            done += 1
        if not done and bounds.min() >= self.kth.max():
            for start in group.starts[::RUN]:
                self.score(self.all, group, slice(start, start + RUN * BLOCK))
            return
        live = bounds >= self.kth[:, None]
        live[:, order[:done]] = False
        for lo in range(0, len(order), RUN):
            run = live[:, lo : lo + RUN]
            rows = np.flatnonzero(run.any(axis=1))
            if 2 * np.count_nonzero(run) > len(rows) * run.shape[1]:
                self.score(rows, group, slice(group.starts[lo], group.starts[lo] + RUN * BLOCK))
                continue
            for b in np.flatnonzero(run.any(axis=0)):
                self.score(np.flatnonzero(run[:, b]), group, slice(group.starts[lo + b], group.starts[lo + b] + BLOCK))

    def search(self, groups: list[_Group], bounds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best of all groups of a slab: the group of the highest bound first."""
        begin = ends - [len(g.starts) for g in groups]
        for i in np.argsort(-np.maximum.reduceat(bounds.max(axis=0), begin), kind="stable"):
            self.meet(groups[i], bounds[:, begin[i] : ends[i]])
            if self.waiting >= len(self.ids) * self.k:
                self.settle()
        return self.settle()


def _slab(groups: list[_Group], queries: _Queries) -> tuple[list[_Group], np.ndarray, np.ndarray]:
    """Groups with the bounds of their blocks and the ends of each group's blocks among them."""
    return groups, queries.bounds(groups), np.cumsum([len(g.starts) for g in groups])


def _tile(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, first_only: bool) -> tuple[np.ndarray, ...]:
    """(query index, id, score) of the best of one group for some queries, their k-th scores, and the number of scored blocks."""
    queries, groups = _Queries(q_ids, q, floor, k), [_Group(ids, x)]
    if first_only:
        queries.kth = np.maximum(queries.kth, _lowered(queries.open(*_slab(groups, queries)).min(axis=1)))
    return *(queries.settle() if first_only else queries.search(*_slab(groups, queries))), queries.kth, queries.scored


def _visits(batches: Iterable[pa.RecordBatch], together: int) -> Iterator[tuple[list[_Group], list[dict]]]:
    """Groups of a slab with some chunks at a time; rows come slab by slab, groups before chunks."""
    at, groups = None, []
    for batch in batches:
        slab, asks = batch.column("slab").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
        lo = 0
        while lo < len(batch):
            if slab[lo] != at:
                at, groups = slab[lo], []
            hi = lo + 1
            while asks[lo] and hi < min(len(batch), lo + together) and slab[hi] == at:
                hi += 1
            rows = batch.slice(lo, hi - lo).to_pylist()
            if asks[lo]:
                yield groups, rows
            else:
                groups.append(_Group(np.frombuffer(rows[0]["ids"], "<i8"), _held(rows[0])))
            lo = hi


def _held(row: dict) -> np.ndarray:
    return _numbers(row["x"], row["size"] * row["width"]).reshape(row["size"], row["width"])


def _asked(rows: list[dict], k: int) -> _Queries:
    xs = [_held(r) for r in rows]
    d = max(x.shape[1] for x in xs)
    x = np.concatenate([x if x.shape[1] == d else np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in xs])
    floor = np.concatenate([np.full(r["size"], -np.inf) if r["floor"] is None else np.frombuffer(r["floor"], "<f8") for r in rows])
    return _Queries(np.concatenate([np.frombuffer(r["ids"], "<i8") for r in rows]), x, floor, k)


def _dealt(groups: DataFrame) -> tuple[DataFrame, int]:
    """Groups with their slab, and the number of slabs; groups are dealt in turn."""
    spark = groups.sparkSession
    parts = groups.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("size").cast("long") * F.col("width")).alias("numbers")).orderBy("part").collect()
    n = sum(p.n for p in parts)
    slabs = max(1, -(-sum(p.numbers for p in parts) // SLAB), min(n, 4 * spark.sparkContext.defaultParallelism))
    first = np.cumsum([0, *(p.n for p in parts)]).tolist()
    firsts = spark.createDataFrame([(p.part, f) for p, f in zip(parts, first)], "part int, first long")
    return groups.join(F.broadcast(firsts), "part").withColumn("slab", F.pmod(F.col("first") + F.col("place"), F.lit(slabs)).cast("int")), slabs


def _met(groups: DataFrame, chunks: DataFrame, slabs: int) -> DataFrame:
    """Slab by slab its groups, then all chunks."""
    tiles = min(MOST_TILES, slabs)
    columns = ["slab", "asks", "part", "place", "size", "width", "ids", "x", "floor"]
    spread = chunks.withColumns({"asks": F.lit(True), "slab": F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))})
    held = groups.withColumns({"asks": F.lit(False), "floor": F.lit(None).cast("binary")})
    dealt = held.select(columns).union(spread.select(columns)).repartitionById(tiles, F.pmod("slab", F.lit(tiles)).cast("int"))
    return dealt.sortWithinPartitions("slab", "asks", "part", "place")


def top_k(vectors: DataFrame, k: int, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(query_id, rank, id, score): for each query row the k highest inner products with every other row.

    Vectors count as floor(1024 x) of each component; ties go to the smaller id. ``is_query`` is a
    condition on the column ``id``. ``usable_vectors`` says which rows take part and what repeated rows
    and ids mean; vectors of different lengths are compared over the shorter one. A query has as many
    rows as there are candidates, if fewer than k; an empty table gives none. Scores beyond a long
    are cut to the range of longs.
    """
    rows = written(_coded(usable_vectors(vectors, id_col, vec_col)), "vectors")
    groups = written(_packed(_arranged(rows), BLOCK * BLOCKS), "blocks")
    chunks = written(_packed(_arranged(rows.where(is_query)), CHUNK), "queries")
    dealt, slabs = _dealt(groups)

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, asking in _visits(batches, OPENING):
            queries = _asked(asking, k)
            best = queries.open(*_slab(held, queries))
            cuts = np.cumsum([0, *(r["size"] for r in asking)])
            columns = [pa.array([r[c] for r in asking], pa.int32()) for c in ("part", "place")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([best[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary())], ["part", "place", "scores"])

    def kth(found: pa.Table) -> pa.Table:
        best = np.concatenate([np.frombuffer(b, "<f8").reshape(-1, k + 1) for b in found["scores"].to_pylist()], axis=1)
        floor = _lowered(-np.partition(-best, k, axis=1)[:, k])  # one more than k: one may be the query itself
        return pa.table({"part": found["part"][:1], "place": found["place"][:1], "floor": pa.array([floor.tobytes()], pa.binary())})

    def closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, asking in _visits(batches, TOGETHER):
            queries = _asked(asking, k)
            owner, ident, score = queries.search(*_slab(held, queries))
            whole = score.astype(np.int64) if score.dtype != object and np.abs(score).max(initial=0) < EXACT else [min(LONG - 1, max(-LONG, int(s))) for s in score]
            yield pa.RecordBatch.from_arrays([pa.array(queries.ids[owner]), pa.array(ident), pa.array(whole, pa.int64())], ["query_id", "id", "score"])

    opened = _met(dealt, chunks.withColumn("floor", F.lit(None).cast("binary")), slabs).mapInArrow(opening, "part int, place int, scores binary")
    floors = opened.groupBy("part", "place").applyInArrow(kth, "part int, place int, floor binary")
    started = written(chunks.join(floors, ["part", "place"]), "query-floors")
    best = _met(dealt, started, slabs).mapInArrow(closing, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op7_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = top_k(vectors, 10, F.col("id") % 100 == 0, "vec_id", "embedding")
    return found.withColumnRenamed("id", "vec_id")
