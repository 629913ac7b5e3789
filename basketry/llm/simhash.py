"""SimHash near-duplicates.

Fingerprints are computed in Arrow batches; the search for close ones is a range join on a grid.
A fingerprint is cut into 2-bit segments; the counts of set bits (0 to 2) are its point. The Manhattan
distance of two points never exceeds the number of differing bits. The 32 coordinates are dealt into
groups, so many that two points within the radius are within distance 1 in at least one of them. In
that group's grid a point looks only into its own cell and the cells one step up in one coordinate (a
step down is the other point's step up). Every pair that meets is then compared exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.llm.components import components
from basketry.llm.scratch import written

SEED, SHINGLE, RADIUS = 42, 3, 2
#: Bytes of text split into words at a time.
PART_BYTES = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words, a part of the text at a time; bytes.lower and bytes.split know ASCII only."""
    at = 0
    while at < len(text):
        end = _SPACE.search(text, at + PART_BYTES)
        upto = end.start() if end else len(text)
        yield text[at:upto].lower().split()
        at = upto


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64-bit fingerprint: a bit is 1 if set in over half the hashes of all word shingles."""
    digest, counts, n, held = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for words in words_of(text):
        held += words
        if len(held) < width:
            continue
        rows = map(b" ".join, zip(*(held[i:] for i in range(width))))
        hashes = np.array([digest(s, SEED) for s in rows], "<u8")
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)
        held = held[len(held) - width + 1 :]
    if not n:
        if not held:
            return 0
        return digest(b" ".join(held), SEED)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text_col: str, keep: list[str], width: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` of docs, and ``fp`` (the fingerprint as a signed long)."""
    names = [f"c{i}" for i in range(len(keep))]
    chosen = docs.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keep, names)), F.col(f"`{text_col}`").alias("t"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema[:-1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py() or b"", width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], [*names, "fp"])

    return chosen.mapInArrow(work, f"{kinds}, fp long").toDF(*keep, "fp")


def _grids(fp: Column, radius: int) -> list[tuple[Column, int]]:
    """(cell, coordinates) of each group: 2-bit counts of set bits, packed into one long."""
    groups = (radius + 2) // 2
    borders = [64 * i // groups // 2 * 2 for i in range(groups + 1)]
    cells = []
    for lo, hi in zip(borders[:-1], borders[1:]):
        # an even number of bits under 64 each, so that no sum leaves the range of a long
        bits = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        ones = F.lit(int("01" * ((hi - lo) // 2), 2))
        cells.append((bits - F.shiftrightunsigned(bits, 1).bitwiseAND(ones), (hi - lo) // 2))
    return cells


def close_pairs(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of different values of the column fp (distinct longs) within ``radius`` >= 1 bits.

    A pair may come once from each group of coordinates. The exact comparison is part of the join's
    condition: pairs that only share a cell are never rows. The grid is that of 2 bits or more; a smaller
    radius is a matter of the comparison.
    """
    if radius < 1:
        raise ValueError("radius must be at least 1")
    cells, looks = [], []
    for g, (cell, n) in enumerate(_grids(F.col("fp"), max(radius, 2))):
        steps = [F.when(F.shiftrightunsigned(cell, 2 * i).bitwiseAND(F.lit(3)) < 2, cell + F.lit(1 << (2 * i))) for i in range(n)]
        cells.append(fps.select(F.lit(g).alias("g"), cell.alias("cell"), F.col("fp").alias("b")))
        looks.append(fps.select(F.lit(g).alias("g"), cell.alias("own"), F.explode(F.array_compact(F.array(cell, *steps))).alias("cell"), F.col("fp").alias("a")))
    met = reduce(DataFrame.union, looks).join(reduce(DataFrame.union, cells), ["g", "cell"])
    return met.where(((F.col("own") != F.col("cell")) | (F.col("a") < F.col("b"))) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")


def _roots(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint."""
    linked = components(close_pairs(fps, radius))
    return fps.select("fp").join(linked, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of ``radius`` (at least 1) or fewer differing
    bits. Null, empty and blank texts have fingerprint zero, which links like any other. A row without
    id belongs to its component but never names it; a component of such rows only has no name (null).
    Repeated rows stay repeated; an empty table gives no rows. A very long text is hashed whole, a part of
    it at a time. Other columns are ignored, so their names cannot clash.
    """
    marked = written(with_fingerprint(docs, text_col, [id_col], width).toDF("id", "fp"), "fingerprints")
    first = written(marked.groupBy("fp").agg(F.min("id").alias("low")), "distinct-fingerprints")
    roots = _roots(first, radius)
    named = written(first.join(roots, "fp").select("fp", "root", "low"), "roots")
    names = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = named.join(names, "root").select("fp", "component_id")
    return marked.join(found, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs with one row of each component: the one of smallest id; rows without id come last.

    Of several rows with that id exactly one stays. All columns are kept.
    """
    names = [f"k{i}" for i in range(len(docs.columns))]
    held = docs.toDF(*names)
    id_name, text_name = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rows = written(with_fingerprint(held, text_name, names, width).withColumn("row", F.monotonically_increasing_id()), "fingerprinted")
    order = F.struct(F.col(id_name).isNull(), F.col(id_name), F.col("row"))
    first = written(rows.groupBy("fp").agg(F.min(order).alias("low")), "distinct-fingerprints")
    stay = first.join(_roots(first, radius), "fp").groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.row").alias("row"))
    return rows.join(stay, "row", "left_semi").select(*names).toDF(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
