"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is cut at quantiles of all rows into at most 2^bits cells. Numbers are cut at sketched
quantiles; whole texts at exact ones, from their distinct values with counts, ranked by a range exchange.
The cells are the coordinates of a
point on a Hilbert curve. Rows are sorted by the curve index, then by the tie columns, and cut into
runs of equal row counts (law ``rows``): neighbours on the curve share a file, so its minimum and
maximum are narrow in every dimension and a filter on any of them skips most files.

The sort is one range exchange of small rows, written once; the place of a row is its place in its
range plus the counted rows of the ranges before it. Runs follow from place, rows and shards by
arithmetic alone, so no group is ever held together and equal keys spread over shards where needed.

Rows: a NULL dimension sorts lowest. NULL text has size 16 and the checksum of no bytes. Ties on all
columns are exchangeable rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyreel.llm.common import settle

OVERHEAD = 16


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points with coordinates below 2^bits, one row a point (Skilling, 2004)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    step = np.int64(1) << (bits - 1)
    while step > 1:
        low = step - 1
        for d in range(dims):
            turned = (x[d] & step) != 0
            swap = np.where(turned, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[d] ^= swap
        step >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flips = np.zeros_like(x[0])
    step = np.int64(1) << (bits - 1)
    while step > 1:
        flips = np.where(x[-1] & step, flips ^ (step - 1), flips)
        step >>= 1
    x ^= flips
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> bit) & 1)
    return index


def text_fences(df: DataFrame, column: str, cells: int) -> list[str]:
    """The values at which the ranks of all rows, ordered by a text column, reach each 1 / cells; at most cells - 1."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ranged = settle(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("n").alias("n"), F.min("value").alias("low")).orderBy("low").collect()  # one row a range
    total = sum(r["n"] for r in totals)
    before, starts = 0, []
    for row in totals:
        starts.append((row["part"], before))
        before += row["n"]
    if not starts:
        return []
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "part int, before long"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("value")) + F.col("before")
    ranked = ranged.join(offsets, "part").select("value", "n", upto.alias("upto"))
    # The cell of a value's last row, where its first row lies in an earlier one.
    cell = F.floor(F.col("upto") * cells / total)
    ends = ranked.filter(cell > F.floor((F.col("upto") - F.col("n")) * cells / total))
    return sorted(r["value"] for r in ends.select("value").collect())[: cells - 1]


def hilbert_order(df: DataFrame, dimensions: Sequence[str], bits: int = 8) -> DataFrame:
    """``df`` with a column ``curve``: the Hilbert index of its quantised dimensions."""
    if not 0 < bits * len(dimensions) < 63:
        raise ValueError("bits x dimensions has to fit a long")
    texts = [isinstance(df.schema[c].dataType, StringType) for c in dimensions]
    values = [F.col(c) if text else F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c, text in zip(dimensions, texts, strict=True)]
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [F.percentile_approx(v, cuts, 10_000).alias(f"e{i}") for i, v in enumerate(values) if not texts[i]]
    edges = iter(df.select(*numbers).first() if numbers else [])
    # At most 2^bits - 1 values a dimension.
    fences = [
        np.array(text_fences(df, c, 1 << bits), object) if text else np.unique(np.array(next(edges) or [], np.float64))
        for c, text in zip(dimensions, texts, strict=True)
    ]

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        cells = []
        for f, c, text in zip(fences, columns, texts, strict=True):
            if text:
                # NULL lies below all texts.
                known = c.notna().to_numpy()
                cell = np.zeros(len(c), np.int64)
                cell[known] = 1 + np.searchsorted(f, c[known].to_numpy(object), side="left")
            else:
                cell = np.searchsorted(f, c.to_numpy(np.float64), side="right")
            # A dimension with few values still spreads over the whole side of the cube.
            cells.append((cell << bits) // (len(f) + 1 + text))
        return pd.Series(curve_index(np.stack(cells, axis=1), bits))

    return df.withColumn("curve", index(*values))


def cut_runs(df: DataFrame, order: Sequence[str], shards: int) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1, counts at most one apart) and ``slot`` (gapless from 0)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Ranges and places inside them are fixed by the write: the id holds the range above bit 33.
    placed = settle(ranged.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", 33).cast("int"))
    counts = placed.groupBy("_range").count().orderBy("_range").collect()  # one row a range
    total, before, offsets = 0, {}, []
    for row in counts:
        before[row["_range"]] = total
        total += row["count"]
    if not total:
        return placed.drop("_at", "_range").select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    spark = df.sparkSession
    offsets = spark.createDataFrame(list(before.items()), "_range int, _before long")
    rank = F.col("_before") + (F.col("_at") - F.shiftleft(F.col("_range").cast("long"), 33))
    small, larger = divmod(total, shards)
    head = larger * (small + 1)
    shard = F.when(F.col("_rank") < head, F.floor(F.col("_rank") / (small + 1))).otherwise(
        larger + F.floor((F.col("_rank") - head) / max(small, 1))
    )
    first = F.when(F.col("shard") < larger, F.col("shard").cast("long") * (small + 1)).otherwise(
        head + (F.col("shard").cast("long") - larger) * small
    )
    ranked = placed.join(F.broadcast(offsets), "_range").withColumn("_rank", rank)
    ranked = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("_rank") - first)
    return ranked.drop("_at", "_range", "_before", "_rank")


def write_shards(df: DataFrame, path: str, dimensions: Sequence[str], shards: int, ties: Sequence[str] = ()) -> None:
    """Whole rows as Parquet, one folder a shard, sorted along the curve inside it."""
    placed = cut_runs(hilbert_order(df, dimensions), ["curve", *ties], shards)
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_rows(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): digests of the shard every document falls into."""
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        docs["lang"],
        docs["source"],
    )
    placed = cut_runs(hilbert_order(rows, ["lang", "source", "size"]), ["curve", "size", "text_crc32", "doc_id"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
