"""Approximate nearest neighbours by a permutation index.

A vector is described by the order of its nearest pivots. Its posting goes into the inverted files
of its first ``POSTED`` pivots; a query reads the files of its first ``PROBED`` pivots, meets each
vector in the first of them that holds it, and ranks by the footrule distance of the pivot orders. What
lies within the query's cutoff is reranked by exact cosine in double precision.

Equal vectors are one index entry that names its smallest ids, so groups of copies cost one posting.
Pivots are the entries with the smallest hashes, about twice the square root of the number of
entries; they alone are sent to all tasks. Being a sample, they also set the cutoff: the footrule distance
of the query's ``CUTOFF``-th nearest pivot. So about ``CUTOFF / pivots`` of all entries are reranked: a share
that falls with the square root of the table, by one rule at every size. Files longer than ``FILE_ROWS`` are
cut into parts and their queries into blocks, and every block meets every part.

Every query finds at least ``k`` neighbours if so many candidates exist: a pivot stands in its own
file and is reranked there whatever its distance; with fewer pivots all entries are reranked.

Rows: vectors that are NULL, zero, or hold NULL or non-finite components take no part, neither do
vectors of another length than most, nor rows without an id. Ties of the cosine go to the smaller id.
Candidates are rows: an id that stands in several may take several ranks. A query is an id: all rows
with its own id are left out, and if they hold different vectors, a candidate counts by its best cosine with
any of them. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyreel.llm.common import settle

PIVOTS_PER_ROOT = 2.0
PERMUTATION = 48
POSTED = 24
PROBED = 48
# Entries are reranked up to the footrule distance of the pivot of this rank.
CUTOFF = 48
FILE_ROWS = 8192


def usable(embedding: str) -> Column:
    """Neither NULL nor zero, all components finite."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    nonzero = lambda v: v != 0
    column = F.col(embedding)
    return column.isNotNull() & ~F.coalesce(F.exists(column, bad), F.lit(True)) & F.coalesce(F.exists(column, nonzero), F.lit(False))


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """(entry, vector, first, only, ids): distinct vectors with their k + 1 smallest distinct ids.

    ``ids`` holds (vec_id, copies), at most k copies each; ``first`` is the smallest id, ``only`` the id
    of a vector that has one id. ``entry`` is a number of its own, fixed once the rows are written.
    """
    rows = vectors.filter(usable("vector") & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vector") == (lengths["n"] if lengths else 0))
    counted = rows.groupBy("vector", F.col("vec_id").cast("long").alias("vec_id")).agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = counted.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    few = few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("vec_id", "copies"))).alias("ids"))
    first = F.col("ids")[0]["vec_id"]
    only = F.when(F.size("ids") == 1, first)
    return few.select(F.monotonically_increasing_id().alias("entry"), "vector", first.alias("first"), only.alias("only"), "ids")


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _nearest_pivots(x: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` nearest pivots of each row, nearest first, ties to the smaller number."""
    distance = -np.round(_unit(x) @ pivots.T, 12)
    return np.argsort(distance, axis=1, kind="stable")[:, :count].astype(np.int32)


def describe(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``table`` (entry, vector) with ``order``: its nearest pivots."""
    count = min(PERMUTATION, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                order = _nearest_pivots(_matrix(part.column("vector")), pivots, count)
                flat = pa.array(order.ravel())
                lists = pa.ListArray.from_arrays(np.arange(0, order.size + 1, count, dtype=np.int32), flat)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "order"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return table.mapInArrow(run, f"{fields}, order array<int>")


def footrule(queries: np.ndarray, orders: np.ndarray, pivots: int) -> np.ndarray:
    """Footrule distance of two sets of pivot orders, queries x entries; a pivot missing in one stands at the end."""
    count = queries.shape[1]
    out = np.empty((len(queries), len(orders)), np.int32)
    at = np.arange(count)
    for i, query in enumerate(queries):
        place = np.full(pivots, count, np.int32)
        place[query] = at
        seen = place[orders]
        # Pivots of the entry, wherever the query has them, then those that only the query has.
        out[i] = np.abs(seen - at).sum(axis=1) + (count * (count + 1) // 2 - (count - seen).sum(axis=1))
    return out


def cosine(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine in double precision; scaled first, so that no product over- or underflows."""
    q, o = query / np.abs(query).max(), others / np.abs(others).max(axis=1, keepdims=True)
    return (o * q).sum(axis=1) / (np.sqrt((o * o).sum(axis=1)) * np.sqrt((q * q).sum()))


RESULT = "query long, entry long, first long, only long, score double"
DTYPES = {"query": "int64", "entry": "int64", "first": "int64", "only": "Int64", "score": "float64"}


def with_cutoff(asked: DataFrame, pivot_orders: np.ndarray) -> DataFrame:
    """``asked`` with the footrule distance up to which each query reranks."""
    count = len(pivot_orders)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cutoff = np.full(len(batch), np.iinfo(np.int32).max, np.int32)
            if count > CUTOFF:
                for at, order in enumerate(batch["order"]):
                    distances = footrule(np.asarray(order)[None], pivot_orders, count)[0]
                    cutoff[at] = np.partition(distances, CUTOFF - 1)[CUTOFF - 1]
            yield batch.assign(cutoff=cutoff)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields)
    return asked.mapInPandas(run, f"{fields}, cutoff int")


def leaders(scores: np.ndarray, first: np.ndarray, single: np.ndarray, k: int) -> list[int]:
    """Places of the best entries, best first, that suffice for k rows of other ids, whatever the query's id.

    An entry with several ids counts for itself; ``single`` ones of the same id count together, and k are enough.
    """
    kept: list[int] = []
    held: dict[int, int] = {}
    groups = 0
    for at in np.lexsort((first, -scores)).tolist():
        before = held.get(first[at], 0) if single[at] else 0
        if not before:
            if groups == k + 1:
                break
            groups += 1
        if single[at]:
            held[first[at]] = before + 1
        if before < k:
            kept.append(at)
    return kept


def _search(key, asked: pd.DataFrame, file: pd.DataFrame, pivots: int, k: int) -> pd.DataFrame:
    """Best entries of one part of a file for one block of its queries; each pair meets in one file."""
    empty = pd.DataFrame({c: pd.Series(dtype=t) for c, t in DTYPES.items()})
    if not len(asked) or not len(file):
        return empty
    pivot = key[0]
    orders, vectors = np.stack(file["order"].to_numpy()), np.stack(file["vector"].to_numpy()).astype(np.float64)
    names, first = file["entry"].to_numpy(), file["first"].to_numpy()
    # An entry with one id is known by it, which is its first.
    single = file["only"].notna().to_numpy()
    posted, own = orders[:, :POSTED], (file["number"] == pivot).to_numpy(bool, na_value=False)
    found = [empty]
    for query, vector, order, cutoff in zip(asked["entry"], asked["vector"], asked["order"], asked["cutoff"], strict=True):
        order = np.asarray(order)
        place = np.full(pivots, PROBED, np.int32)
        place[order[:PROBED]] = np.arange(len(order[:PROBED]))
        here = place[posted].min(axis=1) == place[pivot]
        near = footrule(order[None], orders[here], pivots)[0] <= cutoff
        at = np.flatnonzero(here)[near | own[here]]
        scores = cosine(np.asarray(vector, np.float64), vectors[at])
        top = leaders(scores, first[at], single[at], k)
        at = at[top]
        only = pd.array(np.where(single[at], first[at], 0), "Int64")
        only[~single[at]] = pd.NA
        found.append(pd.DataFrame({"query": query, "entry": names[at], "first": first[at], "only": only, "score": scores[top]}))
    return pd.concat(found, ignore_index=True)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, rows of its own id left out.

    ``vectors``: (vec_id, vector), all candidates. ``queries``: (vec_id), ids of rows among them.
    The driver and every task hold about twice the square root of the number of vectors.
    """
    spark = vectors.sparkSession
    table = settle(entries(vectors, k))
    total = table.count()
    wanted = max(1, min(total, math.ceil(PIVOTS_PER_ROOT * math.sqrt(total))))
    rows = table.withColumn("_h", F.xxhash64("vector")).orderBy("_h", "first", "entry").limit(wanted).select("entry", "vector").collect()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = _unit(np.array([r["vector"] for r in rows], np.float64))
    count = len(pivots)
    described = settle(describe(table.drop("ids"), pivots))
    numbers = spark.createDataFrame([(r["entry"], i) for i, r in enumerate(rows)], "entry long, number int")
    described = described.join(F.broadcast(numbers), "entry", "left")
    placed = described.filter("number IS NOT NULL").select("number", "order").collect()
    pivot_orders = np.array([r["order"] for r in sorted(placed, key=lambda r: r["number"])], np.int32)

    def filed(df: DataFrame, lists: int) -> DataFrame:
        return df.withColumn("pivot", F.explode(F.slice("order", 1, lists)))

    def per_pivot(df: DataFrame, lists: int, name: str) -> DataFrame:
        sizes = filed(df.select("order"), lists).groupBy("pivot").count()
        return sizes.select("pivot", F.ceil(F.col("count") / FILE_ROWS).cast("int").alias(name))

    # Every vector of an asked id is a query; equal vectors ask once.
    asked_rows = queries.select("vec_id").distinct().join(vectors.select("vec_id", "vector"), "vec_id").distinct()
    asked_rows = asked_rows.join(table.select("entry", "vector"), "vector")
    asked_rows = settle(asked_rows.select(F.col("vec_id").cast("long").alias("query_id"), F.col("entry").alias("query")))
    asked = described.join(asked_rows.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi")
    asked = settle(with_cutoff(asked.select("entry", "vector", "order"), pivot_orders))

    # One row a pivot: the parts its file is cut into, the blocks its queries are cut into.
    cut = per_pivot(described, POSTED, "parts").join(per_pivot(asked, PROBED, "blocks"), "pivot")
    cut = F.broadcast(spark.createDataFrame(cut.collect(), "pivot int, parts int, blocks int"))

    def split(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows fall into one of their own pieces and meet each of the other side's."""
        mine = F.pmod(F.xxhash64("entry"), F.col(own)).cast("int")
        return df.withColumns({own: mine, other: F.explode(F.sequence(F.lit(0), F.col(other) - 1))})

    posted = split(filed(described, POSTED).join(cut, "pivot"), "parts", "blocks")
    probing = split(filed(asked, PROBED).join(cut, "pivot"), "blocks", "parts")
    keys = ["pivot", "parts", "blocks"]
    found = (
        probing.groupBy(*keys).cogroup(posted.groupBy(*keys)).applyInPandas(lambda key, a, f: _search(key, a, f, count, k), RESULT)
    )
    # The same choice as within a file, over all files.
    best_first = [F.desc("score"), "first", "entry"]
    group = [F.col("only").isNull(), F.coalesce("only", "entry")]
    best = found.withColumn("_n", F.row_number().over(Window.partitionBy("query", *group).orderBy(*best_first))).filter(F.col("_n") <= k)
    groups = F.sum((F.col("_n") == 1).cast("int")).over(Window.partitionBy("query").orderBy(*best_first))
    best = best.withColumn("_groups", groups).filter(F.col("_groups") <= k + 1)
    named = best.join(table.select("entry", "ids"), "entry").select("query", "entry", "score", F.inline("ids"))
    answers = asked_rows.join(named, "query").filter("vec_id <> query_id")
    answers = answers.groupBy("query_id", "entry", "vec_id", "copies").agg(F.max("score").alias("score"))
    answers = answers.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
