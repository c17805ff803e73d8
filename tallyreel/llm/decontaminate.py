"""Benchmark decontamination: benchmark items found in documents with up to a few edits.

Pigeonhole: an item that may differ in k places is cut into k + 1 pieces; whatever the edits, one
piece stays whole. All pieces of all items are searched in one pass over a document by an
Aho-Corasick automaton. Around each exact hit the whole item is verified by Myers' bit-parallel
edit distance, as a substring of the document (free ends), with at most k edits.

Text is compared after lowering case and turning every run of signs other than letters and digits
into one space. k is ``edit_share`` of an item's length, so pieces have about 1 / edit_share signs
whatever the length. Items with fewer than ``min_chars`` signs must stand word for word (k = 0, at
word boundaries), since an edit would make another sentence of them.

Items are a stated set that meets all documents: they are taken in blocks of at most ``BLOCK_BYTES``,
one pass over the documents each, so what is sent to the tasks stays bounded for any number of items.
Rows carry their findings from block to block; nothing is joined.

Rows: NULL and empty texts and items match nothing. Repeated items (same normalised text) are
reported under each of their ids. An empty benchmark leaves every document clean. Documents that
repeat a doc_id, or have none, are judged each on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import settle, text_chunks

EDIT_SHARE = 0.05
MIN_CHARS = 32
BLOCK_BYTES = 16 << 20

_GAPS = regex.compile(r"[^\p{L}\p{N}]+")


def normalise(text: str | None) -> str:
    return _GAPS.sub(" ", (text or "").lower()).strip()


def best_distance(item: str, text: str, limit: int) -> tuple[int, int] | None:
    """Fewest edits between ``item`` and any substring of ``text``, and where that one ends; None above limit."""
    size = len(item)
    masks: dict[str, int] = {}
    for i, sign in enumerate(item):
        masks[sign] = masks.get(sign, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best: tuple[int, int] | None = None
    for at, sign in enumerate(text):
        eq = masks.get(sign, 0)
        across = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | ~(across | up) & full
        minus = up & across
        if score <= limit and (best is None or score < best[0]):
            best = score, at + 1
    return best


class ItemFinder:
    """Finds the items of one block in a text."""

    def __init__(self, items: list[tuple[int, str]], edit_share: float, min_chars: int = MIN_CHARS):
        self.min_chars = min_chars
        self.items = [(item_id, text, int(len(text) * edit_share) if len(text) >= min_chars else 0) for item_id, text in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, budget) in enumerate(self.items):
            cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[start:stop], []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def __call__(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, fewest edits, where the best match ends) of each item that the text holds."""
        text = normalise(text)
        found: dict[int, tuple[int, int]] = {}
        tried: set[tuple[int, int]] = set()
        if not self.items:
            return []
        for end, (length, owners) in self.automaton.iter(text):
            for number, offset in owners:
                _, item, budget = self.items[number]
                least = found[number][0] if number in found else budget + 1
                begin = end + 1 - length - offset  # where the item starts if no edit lies before the piece
                if least == 0 or (number, begin) in tried:
                    continue
                tried.add((number, begin))
                if len(item) < self.min_chars:
                    if " " + item + " " == " " * (begin == 0) + text[max(0, begin - 1) : end + 2] + " " * (end + 1 == len(text)):
                        found[number] = 0, end + 1
                    continue
                low = max(0, begin - budget)
                best = best_distance(item, text[low : begin + len(item) + budget], least - 1)
                if best:
                    found[number] = best[0], low + best[1]
        return [(self.items[n][0], edits, at) for n, (edits, at) in found.items()]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Benchmark items, normalised, in blocks of bounded size."""
    rows = benchmark.filter("text is not null and item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text")
    )
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    parts = max(1, -(-2 * total // block_bytes))
    for part in range(parts):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        items = sorted({(r["item_id"], normalise(r["text"])) for r in mine.collect()})
        yield [(i, t) for i, t in items if t]


def in_blocks(rows: DataFrame, blocks: Iterator[list[tuple[int, str]]], task) -> DataFrame:
    """``rows`` through one pass for each block; of several blocks the driver holds one at a time."""
    for number, items in enumerate(blocks):
        rows = (settle(rows) if number else rows).mapInArrow(task(items), rows.schema)
    return rows


def find_items(
    docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, min_edits): one row per row of ``docs``, its whole text searched."""
    none = [F.array().cast("array<long>").alias("item_ids"), F.array().cast("array<int>").alias("edits")]
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], *none)

    def adder(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = ItemFinder(items, edit_share, min_chars)
            for part in text_chunks(batches, "text"):
                found = [find(text) for text in part.column("text").to_pylist()]
                before = [part.column(c).to_pylist() for c in ("item_ids", "edits")]
                lists = [[old + [f[i] for f in one] for old, one in zip(before[i], found, strict=True)] for i in (0, 1)]
                columns = [part.column("doc_id"), part.column("text"), pa.array(lists[0], pa.list_(pa.int64())), pa.array(lists[1], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "item_ids", "edits"])

        return run

    found = in_blocks(rows, item_blocks(benchmark, block_bytes), adder)
    return found.select(
        "doc_id",
        (F.size("item_ids") > 0).alias("contaminated"),
        F.size(F.array_distinct("item_ids")).alias("n_items"),
        F.array_sort(F.array_distinct("item_ids")).alias("item_ids"),
        F.array_min("edits").alias("min_edits"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    share, least = options.get("edit_share", EDIT_SHARE), options.get("min_chars", MIN_CHARS)

    def keeper(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = ItemFinder(items, share, least)
            for part in text_chunks(batches, "text"):
                yield part.filter(pa.array([not find(t) for t in part.column("text").to_pylist()], pa.bool_()))

        return run

    return in_blocks(docs, item_blocks(benchmark, options.get("block_bytes", BLOCK_BYTES)), keeper)
