"""Alignment of two tokenizers, counted by minimal perfect hashing of distinct token pairs.

A text is cut into tokens twice: by a byte-level BPE (A) and by a piece model (B), which both spell the
same bytes. Where tokens of both end, a group ends; tokens whose byte ranges overlap are linked. Each
link covers the bytes between two neighbouring token ends, so a text has as many links as ends, and
groups, links and ids follow from cumulative sums of token lengths.

Counting all links of a corpus takes these steps, with no table that any single task or the
driver must hold whole:

1. Tokenize once and write the ids, two bytes each.
2. First pass over the ids: align, and write the distinct pairs of each task with their number.
3. The distinct pairs are dealt into parts by B id, about ``PART`` a part, so that all pairs of a B id meet. Each
   part gets a minimal perfect hash (levels of bits, each holding the pairs that hit a bit alone; the
   rank of the bit is the index) and its pairs in the order of their index, against which every lookup
   is verified. Tasks turn their pairs into dense vectors of counts by index, which are summed in a
   tree.
4. Second pass over the ids: align again, look the counts up, sum them per text.

Rows: one per row of the table, repeated and NULL ids too. A NULL or empty text has no tokens, nor has
one whose tokens do not spell a space and the text (either tokenizer may normalise). Very long texts
are tokenized between words and aligned between groups, piece by piece. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import CHUNK_BYTES, mix, settle, text_chunks, tree_sum

# Pairs of a part; pairs, or tokens, that a task holds at once; share of bits that the hash leaves free.
PART, HELD, SPARE = 1 << 20, 1 << 20, 2.0
# Words whose tokens a worker process keeps, twice.
REMEMBERED = 120_000
# A space between two words: no token of either kind goes across its start.
_CUT = re.compile(r"(?<=\S) (?=\S)")
CHUNKS = "chunk long, doc_ids array<long>, n_a array<long>, n_b array<long>, a binary, b binary"
SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
PARTIAL = f"chunk long, row int, doc_id long, {', '.join(c + ' long' for c in SUMS)}, groups_sha256 string"


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_level_path: str, piece_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.byte_level = Tokenizer.from_file(byte_level_path)
        self.byte_level.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        # Byte-level entries: printable signs stand for themselves, the other bytes for signs from U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        sign = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        vocabulary = self.byte_level.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.a_bytes[number] = bytes(sign[c] for c in entry) if all(c in sign for c in entry) else entry.encode()
        self.b_bytes = []
        for number in range(self.pieces.get_piece_size()):
            entry = self.pieces.id_to_piece(number)
            raw = bytes([int(entry[3:-1], 16)]) if self.pieces.is_byte(number) else entry.replace("▁", " ").encode()
            self.b_bytes.append(raw)
        self.young: dict[str, tuple[bytes, bytes] | None] = {}
        self.old = self.young
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by A and by B; none where the tokens do not spell a space and the text.

        Both libraries see each word once while the memory holds it: no token reaches over the space before one.
        """
        rows: list[list] = [[] for _ in texts]
        waiting, size = [], 0

        def flush() -> None:
            self._learn({w for _, words in waiting for w in words})
            for row, words in waiting:
                found = list(map(self.young.__getitem__, words))
                rows[row].append((b"".join([e[0] for e in found]), b"".join([e[1] for e in found])) if None not in found else None)

        for row, text in enumerate(texts):
            for piece in _word_pieces(text or ""):
                waiting.append((row, _CUT.split(piece)))
                size += len(piece)
                if size > CHUNK_BYTES:
                    flush()
                    waiting, size = [], 0
        flush()
        whole = [parts if None not in parts else [] for parts in rows]
        return tuple([np.frombuffer(b"".join([p[side] for p in parts]), "<u2") for parts in whole] for side in (0, 1))

    def _learn(self, words: set[str]) -> None:
        """All of them are in the young half of the memory then; what a full half held and nobody asks for again goes."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        new = words.difference(self.young)
        known = new.intersection(self.old)
        self.young.update({w: self.old[w] for w in known})
        new -= known
        # White space at either end, as texts have it, would join the space between two words.
        edges = {w for w in new if w != w.strip()}
        for word in edges:
            self._learn_one(word)
        new = list(new - edges)
        if not new:
            return
        # All new words as one text, which its tokens must spell.
        ends = np.cumsum([len(w.encode()) + 1 for w in new])
        a, b = self._ids(" ".join(new))
        if a is not None:
            cut_a, cut_b = (np.searchsorted(np.cumsum(sizes[ids]), ends) + 1 for sizes, ids in ((self.a_sizes, a), (self.b_sizes, b)))
            raw_a, raw_b = a.tobytes(), b.tobytes()
            low_a = low_b = 0
            for word, high_a, high_b in zip(new, (2 * cut_a).tolist(), (2 * cut_b).tolist(), strict=True):
                self.young[word] = raw_a[low_a:high_a], raw_b[low_b:high_b]
                low_a, low_b = high_a, high_b
            return
        for word in new:
            self._learn_one(word)

    def _learn_one(self, word: str) -> None:
        a, b = self._ids(word)
        self.young[word] = None if a is None else (a.tobytes(), b.tobytes())

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | tuple[None, None]:
        """Ids of a space and the text by both libraries, none where they do not spell it."""
        raw = b" " + text.encode()
        (entry,) = self.byte_level.encode_batch_fast([" " + text], add_special_tokens=False)
        a, b = (np.array(ids, "<u2") for ids in (entry.ids, self.pieces.encode(text)))
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != raw or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
            return None, None
        return a, b


def _word_pieces(text: str) -> Iterator[str]:
    """A text without its leading space, in pieces that each follow a space."""
    start = 0
    while len(text) - start > CHUNK_BYTES:
        cut = _CUT.search(text, start + CHUNK_BYTES)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    if text:
        yield text[start:]


@lru_cache(maxsize=2)
def load_tokenizers(byte_level_path: str, piece_path: str) -> Tokenizers:
    """One pair per worker process: the vocabulary files are installed on every machine."""
    return Tokenizers(byte_level_path, piece_path)


@lru_cache(maxsize=1)
def _spelled() -> pa.Array:
    """Every id in decimal, followed by a comma, a bar or a semicolon."""
    return pa.array([f"{i}{end}".encode() for i in range(1 << 16) for end in ",|;"], pa.binary())


class Alignment:
    """Links and groups of texts that stand end to end. ``a`` and ``b`` are ids, sizes are those of their tokens."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray):
        self.a, self.b = a, b
        self.a_ends, self.b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
        marks = np.zeros(int(self.a_ends[-1]) + 1 if len(a) else 1, np.uint8)
        marks[self.a_ends] = 1
        marks[self.b_ends] |= 2
        self.ends = np.flatnonzero(marks)
        at = marks[self.ends]
        of_a, of_b = at & 1, at >> 1
        self.link_a = np.cumsum(of_a) - of_a
        self.link_b = np.cumsum(of_b) - of_b
        self.common = self.ends[at == 3]

    def keys(self) -> np.ndarray:
        """B id and A id of each link in one number below 2^31."""
        return (self.b[self.link_b].astype(np.uint32) << 16) | self.a[self.link_a]

    def spelling(self) -> tuple[memoryview, np.ndarray]:
        """The groups as bytes, and where each token's bytes end, tokens in the order of the spelling."""
        group_a = np.searchsorted(self.common, self.a_ends)
        group_b = np.searchsorted(self.common, self.b_ends)
        before_a = np.searchsorted(group_b, group_a)  # B tokens of earlier groups
        before_b = np.searchsorted(group_a, group_b, side="right")
        shown = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = self.common[group_a] == self.a_ends, self.common[group_b] == self.b_ends
        shown[np.arange(len(self.a)) + before_a] = self.a.astype(np.int64) * 3 + last_a
        shown[np.arange(len(self.b)) + before_b] = self.b.astype(np.int64) * 3 + 2 * last_b
        words = _spelled().take(pa.array(shown))
        _, offsets, data = words.buffers()
        return memoryview(data or b""), np.frombuffer(offsets, np.int32)[: len(words) + 1]


def _group_cuts(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Stretches of about ``HELD`` tokens of one text that end where a group ends."""
    a_from = b_from = 0
    while a_from < len(a_sizes):
        held = HELD
        while True:
            a_ends = np.cumsum(a_sizes[a_from : a_from + held])
            b_ends = np.cumsum(b_sizes[b_from : b_from + held])
            common = np.intersect1d(a_ends, b_ends, assume_unique=True)
            if len(common):
                a_to = a_from + int(np.searchsorted(a_ends, common[-1])) + 1
                b_to = b_from + int(np.searchsorted(b_ends, common[-1])) + 1
                break
            held *= 2
        yield slice(a_from, a_to), slice(b_from, b_to)
        a_from, b_from = a_to, b_to


def _stretches(batch: pa.RecordBatch, i: int, sizes: tuple[np.ndarray, np.ndarray]):
    """(first text, tokens by A and by B of each text, alignment) for the stretches of one row of chunks."""
    counts_a, counts_b = (np.array(batch.column(c)[i].as_py(), np.int64) for c in ("n_a", "n_b"))
    a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), "<u2") for c in ("a", "b"))
    if len(counts_a) > 1 or len(a) + len(b) <= HELD:
        yield 0, counts_a, counts_b, Alignment(a, b, *sizes)
        return
    for mine_a, mine_b in _group_cuts(sizes[0][a], sizes[1][b]):
        part = Alignment(a[mine_a], b[mine_b], *sizes)
        yield 0, np.array([len(part.a)]), np.array([len(part.b)]), part


class PairHash:
    """Minimal perfect hash of distinct numbers: each level keeps those that hit one of its bits alone."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.offsets = np.cumsum([0, *(int(bits.sum()) for bits in levels)])
        self.ranks = [np.cumsum(bits, dtype=np.int32) - 1 for bits in levels]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64) + np.uint64((level + 1) << 33)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PairHash:
        levels = []
        while len(keys):
            size = max(64, int(SPARE * len(keys)))
            at = cls._places(keys, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            keys = keys[~bits[at]]
            if len(levels) > 64:
                raise ValueError("the numbers are not distinct")
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; any place, or -1, for a key that was not there: verify against the keys in order."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._places(keys[rest], level, len(bits))
            hit = bits[at]
            out[rest[hit]] = self.offsets[level] + ranks[at[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def to_bytes(self) -> bytes:
        head = json.dumps([len(bits) for bits in self.levels]).encode()
        return len(head).to_bytes(4, "little") + head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PairHash:
        at = 4 + int.from_bytes(raw[:4], "little")
        levels = []
        for size in json.loads(raw[4:at]):
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return cls(levels)


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((((keys >> 16).astype(np.int64) * 40503) & 0xFFFF) % parts).astype(np.int32)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


def _one(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(table.column(name)[0].as_buffer(), dtype)


def tokenize(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """Texts as ids, some half a megabyte of text a row; see ``CHUNKS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load_tokenizers(byte_level_path, piece_path)
        me = TaskContext.get().partitionId() << 32
        for number, part in enumerate(text_chunks(batches, "text")):
            a, b = both.encode(part.column("text").to_pylist())
            columns = [
                pa.array([me + number]),
                pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([[len(x) for x in a]], pa.list_(pa.int64())),
                pa.array([[len(x) for x in b]], pa.list_(pa.int64())),
                pa.array([np.concatenate(a).tobytes()], pa.binary()),
                pa.array([np.concatenate(b).tobytes()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_ids", "n_a", "n_b", "a", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """(slice, keys, n): the pairs that a task links, and how often; several rows where they are many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load_tokenizers(byte_level_path, piece_path)
        me = TaskContext.get().partitionId()
        keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

        def row() -> pa.RecordBatch:
            columns = [pa.array([me], pa.int32()), pa.array([keys.astype(np.int32)]), pa.array([counts])]
            return pa.RecordBatch.from_arrays(columns, names=["slice", "keys", "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                for *_, part in _stretches(batch, i, (both.a_sizes, both.b_sizes)):
                    more, n = np.unique(part.keys(), return_counts=True)
                    keys, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)
                    if len(keys) >= HELD:
                        yield row()
                        keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield row()

    return chunks.mapInArrow(run, "slice int, keys array<int>, n array<long>")


def hash_parts(keys: DataFrame, parts: int) -> DataFrame:
    """(part, hash, keys): the minimal perfect hash of the distinct keys of each part, and these in its order."""

    def run(group: pa.Table) -> pa.Table:
        mine = group.column("key").to_numpy().astype(np.uint32)
        hashed = PairHash.build(mine)
        ordered = np.empty_like(mine)
        ordered[hashed.index(mine)] = mine
        return pa.table({"part": group.column("part")[:1], "hash": pa.array([hashed.to_bytes()]), "keys": _binary(ordered)})

    part = F.expr("((key >> 16) * 40503) & 65535") % parts
    return keys.withColumn("part", part.cast("int")).groupBy("part").applyInArrow(run, "part int, hash binary, keys binary")


def _find(table: pa.Table, keys: np.ndarray, hashed: PairHash) -> np.ndarray:
    """Index of each key in the part's table; a key that is not there is an error."""
    at = hashed.index(keys)
    if len(at) and (at.min() < 0 or (_one(table, "keys", "<u4")[at] != keys).any()):
        raise ValueError("a pair is missing in its table")
    return at


def dense_counts(counted: DataFrame, tables: DataFrame, parts: int) -> DataFrame:
    """(part, data): how often each pair of a part is linked in the corpus, by its index."""
    slices = max(1, -(-(counted.agg(F.sum(F.size("keys"))).first()[0] or 0) // (4 * HELD)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = batch.column("keys")[i].values.to_numpy().astype(np.uint32)
                n = batch.column("n")[i].values.to_numpy()
                part = _part_of(keys, parts)
                for number in np.unique(part).tolist():
                    mine = part == number
                    columns = [pa.array([number], pa.int32()), batch.column("slice").slice(i, 1), _binary(keys[mine]), _binary(n[mine])]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "slice", "wanted", "n"])

    def vector(key: tuple, asked: pa.Table, table: pa.Table) -> pa.Table:
        total = np.zeros(len(_one(table, "keys", "<u4")), np.int64)
        hashed = PairHash.from_bytes(table.column("hash")[0].as_py())
        for i in range(asked.num_rows):
            keys, n = (np.frombuffer(asked.column(c)[i].as_buffer(), t) for c, t in (("wanted", "<u4"), ("n", "<i8")))
            total[_find(table, keys, hashed)] += n
        head = {"part": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32())}
        return pa.table({**head, "data": _binary(total)})

    dealt = counted.mapInArrow(deal, "part int, slice int, wanted binary, n binary").withColumn("slice", F.col("slice") % slices)
    vectors = _beside(dealt, tables, slices, vector, "part int, slice int, data binary")
    return tree_sum(vectors, "<i8", slices)


def _beside(asked: DataFrame, tables: DataFrame, slices: int, function, schema: str) -> DataFrame:
    """Each (part, slice) of ``asked`` together with the one table of its part."""
    copies = tables.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def guarded(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        # A slice without a row of its part has nothing to ask.
        return function(key, left, right) if left.num_rows else empty

    names = [c.strip().rsplit(" ", 1) for c in schema.split(",")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    empty = pa.table({n: pa.array([], kinds[t]) for n, t in names})
    return asked.groupBy("part", "slice").cogroup(copies.groupBy("part", "slice")).applyInArrow(guarded, schema)


def text_sums(chunks: DataFrame, tables: DataFrame, parts: int, byte_level_path: str, piece_path: str) -> DataFrame:
    """One row per text: the second pass. ``tables`` hold part, hash, keys, counts and whether a count is the best of its B id."""
    tokens = chunks.agg(F.sum(F.aggregate("n_a", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    slices = max(1, -(-tokens // (4 * HELD * parts)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load_tokenizers(byte_level_path, piece_path)
        for batch in batches:
            for i in range(batch.num_rows):
                yield from asked(batch, i, both)

    def asked(batch: pa.RecordBatch, i: int, both: Tokenizers) -> Iterator[pa.RecordBatch]:
        chunk = batch.column("chunk")[i].as_py()
        ids = batch.column("doc_ids").slice(i, 1).flatten()
        rows = len(ids)
        known = np.zeros((rows, 4), np.int64)
        hashes = [None] * rows
        piece = 0
        for _, n_a, n_b, part in _stretches(batch, i, (both.a_sizes, both.b_sizes)):
            text_a = np.repeat(np.arange(rows), n_a)
            row = text_a[part.link_a]
            common = np.searchsorted(part.common, np.concatenate([[0], part.a_ends])[np.cumsum(n_a)], side="right")
            groups = np.diff(common, prepend=0)
            known += np.stack([n_a, n_b, groups, np.bincount(row, minlength=rows)], axis=1)
            last = np.cumsum(n_a + n_b)
            data, ends = part.spelling() if last[-1:].any() else (None, None)
            for text in np.flatnonzero(n_a).tolist():
                low, high = ends[last[text] - n_a[text] - n_b[text]], ends[last[text]]
                if hashes[text] is None:
                    hashes[text] = hashlib.sha256()
                else:
                    hashes[text].update(b";")
                hashes[text].update(data[low : high - 1])
            pairs, n = np.unique((row.astype(np.uint64) << np.uint64(32)) | part.keys(), return_counts=True)
            keys = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            texts = (pairs >> np.uint64(32)).astype(np.uint32)
            parted = _part_of(keys, parts)
            for number in np.unique(parted).tolist():
                mine = parted == number
                yield request(chunk, piece, number, pa.array([None], pa.list_(pa.int64())), texts[mine], keys[mine], n[mine], None, None)
            piece += 1
        digest = ["" if h is None else h.hexdigest() for h in hashes]
        none = np.zeros(0, np.uint32)
        yield request(chunk, piece, 0, pa.array([ids.to_pylist()], pa.list_(pa.int64())), none, none, none, known, digest)

    def request(chunk, piece, part, ids, texts, keys, n, known, digest) -> pa.RecordBatch:
        columns = [
            pa.array([part], pa.int32()),
            pa.array([int(mix(np.array([chunk * 31 + piece], np.uint64))[0] % slices)], pa.int32()),
            pa.array([chunk]),
            ids,
            _binary(texts),
            _binary(keys),
            _binary(n.astype("<u4")),
            pa.array([None], pa.binary()) if known is None else _binary(known),
            pa.array([digest], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["part", "slice", "chunk", "doc_ids", "row", "wanted", "n", "known", "digest"])

    def look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            hashed = PairHash.from_bytes(right.column("hash")[0].as_py())
            counts, best = _one(right, "counts", "<i8"), _one(right, "best", "?")
        for i in range(left.num_rows):
            row, keys, n = (np.frombuffer(left.column(c)[i].as_buffer(), "<u4") for c in ("row", "wanted", "n"))
            chunk = left.column("chunk")[i].as_py()
            if len(keys):
                at = _find(right, keys, hashed)
                texts, which = np.unique(row, return_inverse=True)
                n_best, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                np.add.at(n_best, which, n * best[at])
                np.add.at(total, which, n * counts[at])
                columns = [texts.astype(np.int32), None, *[np.zeros(len(texts), np.int64)] * 4, n_best, total, None]
                out.append(partial(chunk, len(texts), columns))
            if left.column("known")[i].is_valid:
                known = np.frombuffer(left.column("known")[i].as_buffer(), np.int64).reshape(-1, 4)
                size = len(known)
                ids, digest = (left.column(c)[i].values for c in ("doc_ids", "digest"))
                columns = [np.arange(size, dtype=np.int32), ids, *known.T, *[np.zeros(size, np.int64)] * 2, digest]
                out.append(partial(chunk, size, columns))
        return pa.concat_tables(out)

    def partial(chunk: int, size: int, columns: list) -> pa.Table:
        kinds = [pa.int32(), pa.int64(), *[pa.int64()] * 6, pa.string()]
        arrays = [pa.nulls(size, t) if c is None else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.table([pa.array(np.full(size, chunk)), *arrays], names=["chunk", "row", "doc_id", *SUMS, "groups_sha256"])

    schema = "part int, slice int, chunk long, doc_ids array<long>, row binary, wanted binary, n binary, known binary, digest array<string>"
    found = _beside(chunks.mapInArrow(ask, schema), tables, slices, look_up, PARTIAL)
    one = [F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in SUMS], F.max("groups_sha256").alias("groups_sha256")]
    return found.groupBy("chunk", "row").agg(*one).drop("chunk", "row")


def mark_best(tables: DataFrame, sums: DataFrame) -> DataFrame:
    """(part, hash, keys, counts, best): a part holds all pairs of its B ids, so the highest count is known there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, counts = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("keys", "<u4"), ("data", "<i8")))
                ids, which = np.unique(keys >> 16, return_inverse=True)
                highest = np.zeros(len(ids), np.int64)
                np.maximum.at(highest, which, counts)
                columns = [batch.column(c).slice(i, 1) for c in ("part", "hash", "keys", "data")] + [_binary(counts == highest[which])]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "hash", "keys", "counts", "best"])

    joined = tables.join(sums, "part").select("part", "hash", "keys", "data")
    return joined.mapInArrow(run, "part int, hash binary, keys binary, counts binary, best binary")


def align(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): tokens, groups and links, and the corpus-wide counts of its links."""
    paths = byte_level_path, piece_path
    chunks = settle(tokenize(docs, *paths))
    counted = settle(pair_counts(chunks, *paths))
    keys = settle(counted.select(F.explode("keys").alias("key")).distinct())
    parts = max(1, -(-keys.count() // PART))
    tables = settle(hash_parts(keys, parts))
    tables = settle(mark_best(tables, dense_counts(counted, tables, parts)))
    return text_sums(chunks, tables, parts, *paths).select("doc_id", *SUMS, "groups_sha256")
