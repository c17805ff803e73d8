"""Removal of long repeated strings by prefix-free parsing.

A byte goes if a string of ``SPAN`` (100) bytes that covers it also starts earlier in the corpus, that
is in a document with a smaller id, or earlier in the same document. Strings never cross documents and
are judged on the input.

Parsing. A rolling hash over ``GRAM`` bytes picks triggers: the smallest hash in each run of
``SPAN - GRAM + 1`` positions, the rightmost among equals. So every 100-byte string holds a trigger, at
the same place wherever it stands. A phrase is what surrounds a trigger: all 100-byte strings that hold
its gram, 168 bytes. Where two strings are equal, so are their triggers, and both stand in phrases of
the same gram.

Dictionary. Grams that occur once lead nowhere and go. Equal phrases become one dictionary entry with
its first place; all later places are covered whole, without looking inside. What is left are entries
that share a gram but differ around it, mostly at the borders of repeated passages.

Order. The entries of a dictionary part are put in suffix order by prefix doubling (8, 16, 32, 64, then
100 bytes; ranks, not hashes), and equal strings by their place in the corpus: every one but the first
is marked. A part is a set of grams. A gram with too many different entries is cut first: its strings
are told apart by where they start, which leaves them a longer common core, and the cores are parts of
their own. So no part grows with the corpus.

Rows: NULL text counts as empty; texts below 100 bytes lose nothing. Of equal texts all but the smallest
doc_id go whole. Rows that repeat both doc_id and text hold one start each, so equal rows do not erase
each other. Where a doc_id, or NULL, stands with different texts, each text is a document of its own: the key
of a document is (doc_id, sub), where ``sub`` is the digest of the text in that case and empty otherwise.
NULL doc_ids sort lowest, texts of one id by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import CHUNK_BYTES, RangeHash, flat_bytes, settle, text_chunks

SPAN, GRAM = 100, 32
REACH = SPAN - GRAM  # how far a string that holds the gram starts before it
WIDTH = SPAN + REACH
PART_ROWS = 5_000
HOT_ROWS = 8_000
# Ids sent to all tasks while their counted number is at most this; beyond it the join is shuffled.
BROADCAST_IDS = 2_000_000
# Stands for a NULL doc_id.
NO_ID = -(1 << 62)
PLACE_BITS = 26
# A place packs the gram's position (above bit 14) with the first and last start (0 to REACH) that stay inside the text.
LO, HI = 1 << 7, 1 << 14


def triggers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, RangeHash]:
    """(row, position in data) of each trigger of each text, and the hashes of the data."""
    hashes = RangeHash(data)
    n = len(data) - GRAM + 1
    if n < REACH + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), hashes
    at = np.arange(n)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    # The position, inverted, in the low bits: the smallest key is the rightmost of the smallest hashes.
    low = (hashes(at, at + GRAM) & ~mask) | (mask - at.astype(np.uint64))
    reach = 1
    while 2 * reach <= REACH + 1:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    rest = REACH + 1 - reach
    low = np.minimum(low[: len(low) - rest], low[rest:])  # one key per 100-byte string
    start = np.arange(len(low))
    rows = np.searchsorted(offsets, start, side="right") - 1
    inside = start + SPAN <= offsets[rows + 1]
    found = np.unique((mask - (low[inside] & mask)).astype(np.int64))
    return np.searchsorted(offsets, found, side="right") - 1, found, hashes


def _pieces(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, row of each piece, its start in the text, text length): very long texts in overlapping pieces."""
    data, offsets = flat_bytes(part.column("text"))
    sizes = np.diff(offsets)
    if part.num_rows > 1 or len(data) <= 2 * CHUNK_BYTES:
        yield data, offsets, np.arange(part.num_rows), np.zeros(part.num_rows, np.int64), sizes
        return
    for start in range(0, len(data), CHUNK_BYTES):
        # Phrases of triggers in this piece need REACH bytes before and SPAN after them.
        low, high = max(0, start - WIDTH), min(len(data), start + CHUNK_BYTES + 2 * WIDTH)
        yield data[low:high], np.array([0, high - low]), np.zeros(1, np.int64), np.array([low]), sizes


def phrases(texts: DataFrame) -> DataFrame:
    """(gram, phrase, doc_id, sub, place): hashes of each trigger's gram and phrase (NULL where the text ends first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            for data, offsets, rows, starts, sizes in _pieces(part):
                row, at, hashes = triggers(data, offsets)
                inner = at - offsets[row] + starts[row]
                size = sizes[rows[row]]
                lo = np.maximum(0, REACH - inner)
                hi = np.minimum(REACH, REACH + size - SPAN - inner)
                whole = (lo == 0) & (hi == REACH)
                # In a piece of a long text, phrases at its cut edges are whole in the piece beside it.
                seen = (inner - starts[row] >= np.minimum(inner, REACH)) & (
                    offsets[row + 1] - at >= np.minimum(size - inner, SPAN)
                )
                a, b = np.maximum(at - REACH, 0), np.minimum(at + SPAN, len(data))
                span = hashes(a, b).view(np.int64)
                gram = hashes(at, at + GRAM).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[seen]),
                        pa.array(span[seen], mask=~whole[seen]),
                        pa.array(ids[rows[row]][seen], pa.int64()),
                        part.column("sub").take(pa.array(rows[row][seen])),
                        pa.array((inner * HI + lo * LO + hi)[seen]),
                    ],
                    names=["gram", "phrase", "doc_id", "sub", "place"],
                )

    return texts.mapInArrow(run, "gram long, phrase long, doc_id long, sub binary, place long")


def entry_bytes(active: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, first, last, doc_id, sub, at, lo, hi, entry): the 168 bytes of each dictionary entry, zeros beyond its text."""
    wanted = active.groupBy("doc_id", "sub").agg(F.collect_list(F.struct("gram", "place")).alias("marks"))
    joined = texts.join(wanted, ["doc_id", "sub"]).select("doc_id", "sub", "text", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            data, offsets = flat_bytes(part.column("text"))
            padded = np.concatenate([np.zeros(REACH, np.uint8), data, np.zeros(SPAN, np.uint8)])
            lists = part.column("marks")
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            marks = lists.flatten()
            gram, place = (marks.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row = np.repeat(np.arange(part.num_rows), counts)
            at, lo, hi = place // HI, place % HI // LO, place % LO
            for begin in range(0, len(at), 50_000):
                cut = slice(begin, begin + 50_000)
                first = offsets[row[cut]] + at[cut]
                entry = padded[first[:, None] + np.arange(WIDTH)]
                where = at[cut][:, None] - REACH + np.arange(WIDTH)
                entry[(where < 0) | (where >= np.diff(offsets)[row[cut]][:, None])] = 0
                n = len(entry)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[cut]),
                        pa.array(np.zeros(n, np.int32)),
                        pa.array(np.full(n, REACH, np.int32)),
                        part.column("doc_id").take(pa.array(row[cut])),
                        part.column("sub").take(pa.array(row[cut])),
                        pa.array(at[cut]),
                        pa.array(lo[cut].astype(np.int32)),
                        pa.array(hi[cut].astype(np.int32)),
                        _rows_of(entry),
                    ],
                    names=["key", "first", "last", "doc_id", "sub", "at", "lo", "hi", "entry"],
                )

    return joined.mapInArrow(run, ENTRIES)


ENTRIES = "key long, first int, last int, doc_id long, sub binary, at long, lo int, hi int, entry binary"


def _rows_of(entries: np.ndarray) -> pa.Array:
    offsets = np.arange(0, entries.size + 1, WIDTH, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(entries), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(entries))])


def narrower(hot: DataFrame) -> DataFrame:
    """Each entry twice: for the first and the second half of its starts, under the hash of their common core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column("entry"))
            hashes = RangeHash(data, 1)
            first, last, lo, hi = (batch.column(c).to_numpy() for c in ("first", "last", "lo", "hi"))
            middle = (first + last) // 2
            for a, b in ((first, middle), (middle + 1, last)):
                keep = (a <= b) & (np.maximum(a, lo) <= np.minimum(b, hi))
                core = hashes(offsets[:-1] + np.minimum(b, REACH), offsets[:-1] + a + SPAN)
                key = (core ^ (a.astype(np.uint64) << np.uint64(40))).view(np.int64)
                out = [pa.array(key), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *batch.columns[3:]]
                yield pa.RecordBatch.from_arrays(out, names=batch.schema.names).filter(pa.array(keep))

    return hot.mapInArrow(run, ENTRIES)


def suffix_ranks(entries: np.ndarray) -> np.ndarray:
    """Rank of the 100 bytes at each of the starts 0 to REACH of each entry, in byte order, by prefix doubling."""
    windows = np.lib.stride_tricks.sliding_window_view(entries, 8, axis=1)
    ranks = _dense(np.ascontiguousarray(windows).view(">u8")[..., 0].astype(np.uint64))
    for known in (8, 16, 32):
        ranks = _dense(_pair(ranks[:, :-known], ranks[:, known:]))
    return _dense(_pair(ranks[:, : REACH + 1], ranks[:, SPAN - 64 : SPAN - 64 + REACH + 1]))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left * np.int64(right.max() + 1) + right


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].reshape(values.shape).astype(np.int64)


def later_starts(ranks: np.ndarray, docs: np.ndarray, at: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Marks the usable starts whose string also starts earlier among the usable ones."""
    row, shift = np.nonzero(usable)
    rank, start = ranks[row, shift], at[row] - REACH + shift
    document = np.unique(docs, return_inverse=True)[1][row]
    order = np.lexsort((start, document, rank))
    rank, document, start = rank[order], document[order], start[order]
    head = np.ones(len(order), bool)
    head[1:] = rank[1:] != rank[:-1]
    first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = (document != document[first]) | (start != start[first])
    out = np.zeros(usable.shape, bool)
    out[row[order[later]], shift[order[later]]] = True
    return out


SPANS = "doc_id long, sub binary, begin long, end long"


def _documents(table: pa.Table) -> np.ndarray:
    """The place of each row's document in the order of (doc_id, sub)."""
    ids = np.unique(table.column("doc_id").to_numpy(), return_inverse=True)[1]
    subs = np.array(table.column("sub").to_pylist(), object)
    return ids * np.int64(len(subs)) + np.unique(subs, return_inverse=True)[1]


def _judge_part(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    entries = flat_bytes(table.column("entry").combine_chunks())[0].reshape(-1, WIDTH)
    at = table.column("at").to_numpy()
    first, last, lo, hi = (table.column(c).to_numpy() for c in ("first", "last", "lo", "hi"))
    shifts = np.arange(REACH + 1)
    usable = (shifts >= np.maximum(first, lo)[:, None]) & (shifts <= np.minimum(last, hi)[:, None])
    later = later_starts(suffix_ranks(entries), _documents(table), at, usable)
    edge = np.diff(later.astype(np.int8), axis=1, prepend=0, append=0)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1] - 1
    start = at[row] - REACH
    ids, subs = (table.column(c).take(pa.array(row)) for c in ("doc_id", "sub"))
    return pa.table({"doc_id": ids, "sub": subs, "begin": pa.array(start + begin), "end": pa.array(start + end + SPAN)})


def only(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` (not) in ``ids``; a counted, small set of ids is sent to all tasks, so no text is shuffled."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, ids.columns, how)


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the key of each row's document, (_key, _sub), and (doc_id, sub, size, digest) of all rows."""
    rows = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    digests = settle(rows.select("_key", size.alias("size"), digest.alias("digest")))
    several = digests.filter(F.col("_key") != NO_ID).groupBy("_key").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    several = settle(several.filter("lo <> hi").select("_key", F.lit(True).alias("_several")))

    def named(rows: DataFrame, digest: Column) -> DataFrame:
        small = several.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        if not several.take(1):
            rows = rows.withColumn("_several", F.lit(False))
        else:
            rows = rows.join(F.broadcast(several) if small else several, "_key", "left")
        own = F.coalesce("_several", F.lit(False)) | (F.col("_key") == NO_ID)
        return rows.withColumn("_sub", F.when(own, digest).otherwise(F.lit(b""))).drop("_several")

    digests = named(digests, F.col("digest")).select(F.col("_key").alias("doc_id"), F.col("_sub").alias("sub"), "size", "digest")
    return named(rows, digest), digests


def repeated_spans(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """(doc_id, sub, begin, end): byte ranges to remove; they may overlap. Takes what ``keyed`` returns."""
    rows = docs.select(F.col("_key").alias("doc_id"), F.col("_sub").alias("sub"), "text")
    rows = rows.filter(F.octet_length("text") >= SPAN)
    digests = digests.filter(F.col("size") >= SPAN)
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = settle(digests.join(firsts, "digest").filter("doc_id > first").select("doc_id", "sub", "size"))
    texts = only(rows, copies.select("doc_id", "sub").distinct(), "left_anti")

    parsed = phrases(texts)
    repeated = settle(parsed.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"))
    found = settle(parsed.join(repeated, "gram"))
    entries = found.filter("phrase is not null").groupBy("gram", "phrase").agg(F.min(F.struct("doc_id", "sub", "place")).alias("first"))
    entries = settle(entries)
    covered = found.join(entries, ["gram", "phrase"]).filter(F.struct("doc_id", "sub", "place") > F.col("first"))
    at = F.shiftright("place", 14)
    covered = covered.select("doc_id", "sub", (at - REACH).alias("begin"), (at + SPAN).alias("end"))

    active = entries.select("gram", "first.doc_id", "first.sub", "first.place").union(
        found.filter("phrase is null").select("gram", "doc_id", "sub", "place").distinct()
    )
    shared = active.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    active = settle(active.join(shared, "gram"))
    open_entries = settle(entry_bytes(active, only(texts, active.select("doc_id", "sub").distinct())))

    spans = [covered, copies.select("doc_id", "sub", F.lit(0).cast("long").alias("begin"), F.col("size").alias("end"))]
    while True:
        sized = settle(open_entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
        shape = sized.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
        if not shape["rows"]:
            break
        cold = open_entries.join(sized.filter(F.col("n") <= HOT_ROWS).select("key"), "key")
        parts = max(1, -(-shape["rows"] // PART_ROWS))
        cold = cold.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
        spans.append(cold.groupBy("part").applyInArrow(_judge_part, SPANS))
        if shape["most"] <= HOT_ROWS:
            break
        hot = open_entries.join(sized.filter(F.col("n") > HOT_ROWS).select("key"), "key").select(*open_entries.columns)
        # With one start left, the core is the string itself: the first place stays, all others go.
        single = hot.filter("first = last")
        least = single.groupBy("key").agg(F.min(F.struct("doc_id", "sub", "at")).alias("least"))
        single = single.join(least, "key").filter(F.struct("doc_id", "sub", "at") > F.col("least"))
        begin = F.col("at") - REACH + F.col("first")
        spans.append(single.select("doc_id", "sub", begin.alias("begin"), (begin + SPAN).alias("end")))
        open_entries = settle(narrower(hot.filter("first < last")))
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more.select("doc_id", "sub", F.col("begin").cast("long"), F.col("end").cast("long")))
    return out


def _cut(raw: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """The bytes outside all spans, the number removed, and the number of runs removed."""
    kept, at, removed, runs, last = [], 0, 0, 0, -1
    for begin, end in sorted((s["begin"], min(s["end"], len(raw))) for s in spans or ()):
        if begin >= end or (runs and end <= at):
            continue
        runs += begin > last
        kept.append(raw[at:begin])
        removed += end - max(at, begin)
        at = last = end
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def _with_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` that lose nothing, and the others with their ``_spans``."""
    rows, digests = keyed(docs)
    spans = repeated_spans(rows, digests).distinct().groupBy("doc_id", "sub")
    per_doc = spans.agg(F.collect_list(F.struct("begin", "end")).alias("_spans"))
    per_doc = settle(per_doc.withColumnsRenamed({"doc_id": "_key", "sub": "_sub"}))
    ids = per_doc.select("_key", "_sub")
    small = per_doc.count() <= BROADCAST_IDS
    known = F.broadcast(ids) if small else ids
    untouched = rows.join(known, ["_key", "_sub"], "left_anti").drop("_key", "_sub")
    touched = rows.join(known, ["_key", "_sub"], "left_semi") if small else rows
    return untouched, touched.join(per_doc, ["_key", "_sub"]).drop("_key", "_sub")


def removal_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    untouched, touched = _with_spans(rows)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    zero = F.lit(0).cast("long")
    clean = untouched.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            raws = [(t or "").encode() for t in part.column("text").to_pylist()]
            cuts = [_cut(r, s) for r, s in zip(raws, part.column("_spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(r) for r in raws], pa.int64()),
                    pa.array([c[1] for c in cuts], pa.int64()),
                    pa.array([c[2] for c in cuts], pa.int64()),
                    pa.array([hashlib.sha256(c[0]).hexdigest() for c in cuts], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return clean.unionByName(touched.select("doc_id", "text", "_spans").mapInArrow(run, schema))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text``, all columns kept.

    A character that loses some of its bytes goes with them. ``n_chars`` follows the new text.
    """
    columns = docs.columns
    untouched, touched = _with_spans(docs)
    schema = touched.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            texts = [
                _cut((t or "").encode(), s)[0].decode(errors="ignore")
                for t, s in zip(part.column("text").to_pylist(), part.column("_spans").to_pylist(), strict=True)
            ]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    changed = touched.mapInArrow(run, schema)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return untouched.select(*columns).unionByName(changed.select(*columns))
