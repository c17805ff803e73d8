"""Token counts of the documents in flat token files that carry no index.

A token file is a run of equally wide ids; documents are told apart only by an end-of-document id.
Files are read as blocks of a fixed number of ids, whatever documents they cut. Each block is
searched for the separator in one vectorised comparison. What a block leaves open (ids after its
last separator) is carried over the blocks that hold none by a prefix scan, so a document may span
any number of blocks, and a file any number of tasks.

The scan has two levels: running sums inside spans of ``SPAN`` blocks, then over one row per span.
One file may hold most of all blocks and still spreads over as many tasks as it has spans.

Rows: a NULL or empty document is a bare separator and counts 0 ids. Ids after a file's last
separator form a document without end, counted with ``closed`` false. An empty table or file has no
documents. A payload that is not a whole number of ids is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyreel.llm.bpe import read_ranks
from tallyreel.llm.common import settle, text_chunks

SPAN = 256
BLOCK_IDS = 1 << 17

BLOCKS = "file_id long, block_no long, payload binary, doc_ids array<long>"


@lru_cache(maxsize=2)
def _tokenizer(ranks_path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})


def tokenize(docs: DataFrame, ranks_path: str, pattern: str, separator: int, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat token files from documents: each input partition becomes one file, cut into blocks of ``block_ids``.

    ``doc_ids`` names the documents whose separator lies in the block, in file order. It only labels
    results; the scan never uses it to find a boundary.
    """
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(ranks_path, pattern).encode_ordinary
        file_id = TaskContext.get().partitionId()
        full = block_ids * width
        end = np.array([separator], dtype).tobytes()
        open_bytes, number = bytearray(), 0
        ends: list[tuple[int, int | None]] = []  # the block in which a document's separator falls
        written = 0

        def row(payload: bytes, number: int) -> pa.RecordBatch:
            named = [doc for block, doc in ends if block == number]
            ends[:] = [e for e in ends if e[0] != number]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file_id], pa.int64()),
                    pa.array([number], pa.int64()),
                    pa.array([payload], pa.binary()),
                    pa.array([named], pa.list_(pa.int64())),
                ],
                names=["file_id", "block_no", "payload", "doc_ids"],
            )

        for part in text_chunks(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                open_bytes += np.array(encode(text or ""), dtype).tobytes() + end
                ends.append(((written + len(open_bytes) - width) // full, doc_id))
                while len(open_bytes) >= full:
                    yield row(bytes(open_bytes[:full]), number)
                    del open_bytes[:full]
                    written += full
                    number += 1
        if open_bytes:
            yield row(bytes(open_bytes), number)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, BLOCKS)


def read_flat_files(spark: SparkSession, path: str, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of real binary files. A file comes as one row first, so it has to be below 2 GB."""
    width = np.dtype(dtype).itemsize * block_ids
    files = spark.read.format("binaryFile").load(path)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(width).cast("long"))
    blocks = files.select(F.xxhash64("path").alias("file_id"), "content", F.posexplode(starts).alias("block_no", "_from"))
    return blocks.filter("length(content) > 0").select(
        "file_id",
        F.col("block_no").cast("long").alias("block_no"),
        F.substring("content", (F.col("_from") + 1).cast("int"), F.lit(width)).alias("payload"),
        F.lit(None).cast("array<long>").alias("doc_ids"),
    )


def scan_blocks(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """Per block: ids before its first separator, document lengths between separators, ids after the last."""
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, inner, tail, size = [], [], [], []
            for payload in batch.column("payload").to_pylist():
                if len(payload) % width:
                    raise ValueError("a token block holds part of an id")
                ids = np.frombuffer(payload, dtype)
                at = np.flatnonzero(ids == separator)
                size.append(len(ids))
                head.append(int(at[0]) if len(at) else None)
                inner.append(np.diff(at) - 1 if len(at) else [])
                tail.append(len(ids) - 1 - int(at[-1]) if len(at) else len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file_id"),
                    batch.column("block_no"),
                    batch.column("doc_ids"),
                    pa.array(head, pa.int64()),
                    pa.array(inner, pa.list_(pa.int64())),
                    pa.array(tail, pa.int64()),
                    pa.array(size, pa.int64()),
                ],
                names=["file_id", "block_no", "doc_ids", "head", "inner", "tail", "size"],
            )

    schema = "file_id long, block_no long, doc_ids array<long>, head long, inner array<long>, tail long, size long"
    return blocks.select("file_id", "block_no", "payload", "doc_ids").mapInArrow(run, schema)


def stitch(scanned: DataFrame) -> DataFrame:
    """(file_id, block_no, doc_ids, head, inner, tail, carry, docs_before): the prefix scan over blocks.

    ``carry``: ids left open by the blocks before. An associative summary of a run of blocks is
    (holds a separator, open ids at its end, separators in it); the scan runs over it.
    """
    ends = F.when(F.col("head").isNull(), 0).otherwise(F.size("inner") + 1).cast("long")
    rows = scanned.withColumns({"_span": F.floor(F.col("block_no") / SPAN), "_ends": ends})
    inside = Window.partitionBy("file_id", "_span").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    # Separators seen so far in the span, and sizes so far: open ids = sizes since the last separator.
    rows = rows.withColumns(
        {
            "_size_before": F.coalesce(F.sum("size").over(inside), F.lit(0)),
            "_ends_before": F.coalesce(F.sum("_ends").over(inside), F.lit(0)),
        }
    )
    rows = rows.withColumn("_open_mark", F.when(F.col("head").isNotNull(), F.col("_size_before") + F.col("size") - F.col("tail")))
    rows = rows.withColumn("_last_mark", F.max("_open_mark").over(inside))
    spans = rows.groupBy("file_id", "_span").agg(
        F.sum("size").alias("s"), F.sum("_ends").alias("e"), F.max("_open_mark").alias("mark")
    )
    over = Window.partitionBy("file_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumns({"_s": F.coalesce(F.sum("s").over(over), F.lit(0)), "_e": F.coalesce(F.sum("e").over(over), F.lit(0))})
    spans = spans.withColumn("_m", F.coalesce(F.max(F.col("_s") + F.col("mark")).over(over), F.lit(0)))
    spans = spans.select("file_id", "_span", (F.col("_s") - F.col("_m")).alias("_carry"), "_e")
    carry = F.when(F.col("_last_mark").isNotNull(), F.col("_size_before") - F.col("_last_mark")).otherwise(
        F.col("_carry") + F.col("_size_before")
    )
    joined = rows.join(spans, ["file_id", "_span"])
    return joined.select(
        "file_id", "block_no", "doc_ids", "head", "inner", "tail", carry.alias("carry"), (F.col("_e") + F.col("_ends_before")).alias("docs_before")
    )


def count_tokens(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """(file_id, ordinal, doc_id, n_tokens, closed): one row per document of every file."""
    scanned = settle(scan_blocks(blocks, separator, dtype))
    stitched = stitch(scanned)
    lengths = F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner"))
    closed = stitched.filter("head is not null").select(
        "file_id", "doc_ids", "docs_before", F.posexplode(lengths).alias("_at", "n_tokens")
    )
    closed = closed.select(
        "file_id",
        (F.col("docs_before") + F.col("_at")).alias("ordinal"),
        F.get("doc_ids", F.col("_at")).alias("doc_id"),
        "n_tokens",
        F.lit(True).alias("closed"),
    )
    last = scanned.groupBy("file_id").agg(F.max("block_no").alias("block_no"))
    left = stitched.join(last, ["file_id", "block_no"])
    left = left.withColumn("n_tokens", F.when(F.col("head").isNull(), F.col("carry") + F.col("tail")).otherwise(F.col("tail")))
    docs = F.col("docs_before") + F.when(F.col("head").isNull(), 0).otherwise(F.size("inner") + 1)
    open_docs = left.filter("n_tokens > 0").select(
        "file_id", docs.alias("ordinal"), F.lit(None).cast("long").alias("doc_id"), "n_tokens", F.lit(False).alias("closed")
    )
    return closed.unionByName(open_docs)
