"""Shared by the corpus operators: reading tables, settling intermediates, flat byte views, linked classes."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyreel.sources.workspace import shared_folder

# Text that one numpy pass holds at once; the arrays beside it take some 100 times as much.
CHUNK_BYTES = 1 << 19


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of a few MB at most, whatever their number: texts differ in length by far."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 * CHUNK_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Plans that Python no longer needs are kept by the JVM until their handles here are gone.
    gc.collect()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, and always at least one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows end to end, and n + 1 offsets from 0. NULL counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def connected_classes(edges: DataFrame) -> DataFrame:
    """(node, class_id) for every node of an edge table (a, b): class_id is the smallest node linked to it.

    Alternates two steps that hang neighbours onto smaller nodes until every node hangs on its class
    id. A hub with many neighbours is only ever reduced to a minimum, never gathered. Rounds grow
    with the logarithm of the longest chain. Edges with a missing end are left out.
    """
    pairs = edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = settle(pairs.distinct())
    while True:
        # Larger neighbours hang onto the smallest neighbour (or the node itself) ...
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = settle(large.distinct())
        # ... then the node and its smaller neighbours hang onto the smallest of them.
        low = pairs.groupBy("a").agg(F.min("b").alias("m"))
        joined = pairs.join(low, "a")
        small = low.withColumnRenamed("m", "b").union(joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        pairs = settle(small.distinct())
        chained = pairs.join(pairs.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
        doubled = pairs.groupBy("a").count().filter("count > 1").select("a")
        if not chained.union(doubled).take(1):
            break
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("class_id"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("class_id")).union(roots)


def tree_sum(vectors: DataFrame, dtype: str, slices: int, fan: int = 8) -> DataFrame:
    """(part, data): the element-wise sum of the vectors (part, slice, data) of each part.

    ``slice`` counts from 0 to ``slices`` - 1 and several rows may share one. Each round adds the vectors of
    ``fan`` neighbouring slices, so no task holds more of them, whatever their number.
    """

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(0, dtype)
        for chunk in group.column("data").chunks:
            for i in range(len(chunk)):
                one = np.frombuffer(chunk[i].as_buffer(), dtype)
                total = total + one if len(total) else one.copy()
        return pa.table({"part": group.column("part")[:1], "slice": group.column("slice")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    while True:
        summed = vectors.withColumn("slice", F.floor(F.col("slice") / fan).cast("int"))
        vectors = summed.groupBy("part", "slice").applyInArrow(add, "part int, slice int, data binary")
        slices = -(-slices // fan)
        if slices <= 1:
            return vectors.select("part", "data")


# Odd multipliers of two rolling hashes modulo 2^64, and random values for the 256 bytes.
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, (2, 256), np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(which: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(which)
    if have is None or len(have[0]) < count:
        size = max(count, CHUNK_BYTES + 1)
        up = np.full(size, _MULTIPLIERS[which], np.uint64)
        down = np.full(size, pow(_MULTIPLIERS[which], -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 4 * CHUNK_BYTES:
            _POWERS[which] = have
    return have


class RangeHash:
    """64-bit hashes of any byte ranges of one array, from prefix sums. Equal bytes, equal hash."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.up, self.down = _powers(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[which][data] * self.up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
