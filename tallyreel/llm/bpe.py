"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Each match of the split pattern is encoded on its own. A segment tree stands over its byte
positions; a leaf holds the rank of the pair that starts there, a node the smallest rank below it
and, among equals, the leftmost position. A merge takes the root, drops one leaf, sets the leaves
of the two live neighbours, and repairs the paths to the root: O(log n) for each of at most n
merges, so a piece of a million letters takes no square time. Short pieces of one batch share their
tree shape and go through numpy together; a long one climbs its own tree.

Rows: a NULL text encodes like an empty one (no ids). Nothing here looks at other rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyreel.llm.common import RangeHash, text_chunks

# Encoded pieces kept per worker in each of two generations. They save time and never change a result.
MEMO_PIECES = 100_000
LONG_PIECE = 512
ROWS_AT_ONCE = 2048
LONG_TEXT = 1 << 20
SURE_START = regex.compile(r"(?<=\S) (?=\p{L})")
LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
NONE = np.int64(1) << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _lay_out(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` (of the given sizes) in the given order, and where each of them ends."""
    taken = sizes[order]
    ends = np.cumsum(taken)
    shift = (np.cumsum(sizes) - sizes)[order] - (ends - taken)
    return flat[np.repeat(shift, taken) + np.arange(len(shift) and ends[-1])], ends


class Splitter:
    """Cuts texts into the matches of the split pattern, all texts of a batch at once.

    The pattern of the public byte-level vocabularies is known by its text: runs of letters, of
    digits and of other signs, each with one space before it; a run of white space without its last
    sign where more text follows; and English clitics. Its classes come from the regex module. Any
    other pattern is run by that module.
    """

    KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, pattern: str):
        self.find = None if pattern == self.KNOWN else regex.compile(pattern).finditer
        if self.find is None:
            every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(0x110000))
            self.kinds = np.full(0x110000, OTHER, np.uint8)
            for kind, sign in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
                for run in regex.finditer(sign, every):
                    self.kinds[run.start() : run.end()] = kind

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The UTF-8 bytes of all texts, where each piece starts in them, and n + 1 bounds of the texts."""
        texts = [t or "" for t in texts]
        whole = "".join(texts)
        data = np.frombuffer(whole.encode(), np.uint8)
        signs = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        bounds = np.cumsum([0, *map(len, texts)])
        width = 1 + (signs > 0x7F) + (signs > 0x7FF) + (signs > 0xFFFF).astype(np.int64)
        at = np.zeros(len(signs) + 1, np.int64)
        np.cumsum(width, out=at[1:])
        if self.find is None:
            starts = self._starts(signs, bounds)
        else:
            starts = [a + m.start() for a, t in zip(bounds.tolist(), texts, strict=False) for m in self.find(t)]
        return data, at[starts], at[bounds]

    def stretches(self, text: str) -> Iterator[str]:
        """Parts of a text that end where a piece surely begins: at one space between other sign and letter."""
        start = 0
        while self.find is None and len(text) - start > LONG_TEXT:
            cut = SURE_START.search(text, start + LONG_TEXT)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def _starts(self, signs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(signs)
        if not n:
            return np.zeros(0, np.int64)
        kind = self.kinds[signs]
        opens = np.ones(n + 1, bool)  # a run of one kind begins here
        opens[1:n] = kind[1:] != kind[:-1]
        opens[bounds] = True
        heads = np.zeros(n, bool)  # a text begins here
        heads[bounds[bounds < n]] = True
        starts = opens[:n].copy()
        # The last white space before more text stands alone, or goes with what follows if a plain space.
        last = np.flatnonzero(opens[1:n] & (kind[:-1] == SPACE) & ~heads[1:])
        starts[last] = True
        plain = last[signs[last] == 0x20]
        starts[plain + 1] = False
        # A lone apostrophe that starts a piece takes s, t, m, d, re, ve or ll from the letters after it.
        quote = np.flatnonzero((signs[:-1] == 0x27) & starts[:-1] & opens[1:n] & ~heads[1:] & (kind[1:] == LETTER))
        one = np.isin(signs[quote + 1], [ord(c) for c in "stmd"])
        second = np.minimum(quote + 2, n - 1)
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        two = np.logical_or.reduce([(signs[quote + 1] == a) & (signs[second] == b) for a, b in pairs])
        two &= (quote + 2 < n) & ~heads[second]
        for where, taken in ((quote[one], 1), (quote[two], 2)):
            starts[where + 1] = False
            rest = where + 1 + taken
            starts[rest[rest < n]] = True
        return np.flatnonzero(starts)


def _alike(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct piece, and which of them each piece equals. Pieces lie end to end.

    Hashes only propose: every piece is compared with the one it would share, byte by byte.
    """
    _, first, which = np.unique(RangeHash(data)(starts, ends), return_index=True, return_inverse=True)
    sizes, like = ends - starts, first[which]
    if (sizes[like] == sizes).all():
        shift = np.repeat(starts[like] - starts, sizes)
        at = np.arange(starts[0], ends[-1])
        if (data[at + shift] == data[at]).all():
            return first, which
    raw, known, places = data.tobytes(), {}, []
    which = np.empty(len(starts), np.int64)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        number = known.setdefault(raw[a:b], len(known))
        which[i] = number
        if number == len(places):
            places.append(i)
    return np.array(places, np.int64), which


class BytePairCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.splitter = Splitter(pattern)
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.base = np.int64(max(ranks.values()) + 1)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * int(self.base) + right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        in_order = [self.tokens.get(rank, b"") for rank in range(int(self.base))]
        self.token_bytes = np.frombuffer(b"".join(in_order), np.uint8)
        self.token_sizes = np.fromiter(map(len, in_order), np.int64, len(in_order))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. A very long text goes through in stretches, so memory stays flat."""
        if len(texts) == 1 and len(texts[0] or "") > LONG_TEXT:
            return [b"".join(self._encode_batch([part])[0] for part in self.splitter.stretches(texts[0]))]
        return self._encode_batch(texts)

    def _encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Distinct pieces of all texts are encoded once, then laid out in text order."""
        data, starts, texts_at = self.splitter(texts)
        if not len(starts):
            return [b""] * len(texts)
        ends = np.append(starts[1:], len(data))
        first, pieces = _alike(data, starts, ends)
        raw = data.tobytes()
        encoded = self._encode_pieces([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        flat = np.frombuffer(b"".join(encoded), "<u4")
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        ids, ends = _lay_out(flat, lengths, pieces)
        cuts = np.append(0, ends)[np.searchsorted(starts, texts_at)].tolist()
        return [ids[a:b].tobytes() for a, b in pairwise(cuts)]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0]

    def decode_all(self, encoded: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
        raw, ends = _lay_out(self.token_bytes, self.token_sizes, ids)
        ends = np.concatenate([[0], ends])[np.cumsum([0, *(len(e) // 4 for e in encoded)])].tolist()
        return [raw[a:b].tobytes() for a, b in pairwise(ends)]

    def _encode_pieces(self, raws: list[bytes]) -> list[bytes]:
        """Looks pieces up in two generations of memory, so that frequent ones outlive a full one."""
        memo, older = self.memo, self.older
        found = [memo.get(r) or older.get(r) for r in raws]
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            merged = self._merge([raws[i] for i in new])
            for i, ids in zip(new, merged, strict=True):
                found[i] = ids
        if len(memo) + len(new) > MEMO_PIECES:
            self.older, self.memo = memo, {}
        self.memo.update(zip(raws, found, strict=True))
        return found

    def _merge(self, raws: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = [None if w is None else w.to_bytes(4, "little") for w in map(self.ranks.get, raws)]
        shapes: dict[int, list[int]] = {}
        for i, ids in enumerate(out):
            if ids is None:
                if len(raws[i]) > LONG_PIECE:
                    out[i] = np.array(self._merge_long(raws[i]), "<u4").tobytes()
                else:
                    shapes.setdefault(1 << (len(raws[i]) - 1).bit_length(), []).append(i)
        for width, members in shapes.items():
            for at in range(0, len(members), ROWS_AT_ONCE):
                part = members[at : at + ROWS_AT_ONCE]
                for i, ids in zip(part, self._merge_many([raws[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def _merge_many(self, raws: list[bytes], width: int) -> list[bytes]:
        """All rows share one tree shape of ``width`` leaves; every step merges once in each open row."""
        count = len(raws)
        sizes = np.fromiter(map(len, raws), np.int64, count)
        filled = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(count, width)
        ids = self.byte_ids[filled]
        live = np.arange(width) < sizes[:, None]
        after = np.broadcast_to(np.arange(1, width + 1), (count, width)).copy()
        before = np.broadcast_to(np.arange(-1, width), (count, width + 1)).copy()
        tree = np.full((count, 2 * width), NONE, np.int64)
        ranks = self._rank_of(ids[:, :-1], ids[:, 1:])
        leaves = np.where(live[:, 1:] & (ranks < NONE), ranks * width + np.arange(width - 1), NONE)
        tree[:, width : 2 * width - 1] = leaves
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = tree[rows, 1]
            at, rank = best % width, best // width
            gone = after[rows, at]
            ids[rows, at] = rank
            live[rows, gone] = False
            right = after[rows, gone]
            after[rows, at] = right
            before[rows, right] = at
            self._set(tree, width, rows, gone, np.full(len(rows), NONE))
            has_right = right < sizes[rows]
            found = np.where(has_right, self._rank_of(rank, ids[rows, np.minimum(right, width - 1)]), NONE)
            self._set(tree, width, rows, at, found)
            left = before[rows, at]
            some = left >= 0
            if some.any():
                r, p = rows[some], left[some]
                self._set(tree, width, r, p, self._rank_of(ids[r, p], rank[some]))
            rows = rows[tree[rows, 1] < NONE]
        flat = ids[live].astype("<u4").tobytes()
        ends = 4 * np.cumsum(live.sum(axis=1))
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    @staticmethod
    def _set(tree: np.ndarray, width: int, rows: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> None:
        tree[rows, width + at] = np.where(ranks < NONE, ranks * width + at, NONE)
        node = (width + at) >> 1
        while node[0]:
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            node = node >> 1

    def _merge_long(self, raw: bytes) -> list[int]:
        count, base, pairs, none = len(raw), int(self.base), self.pairs, int(NONE)
        width = 1 << (count - 1).bit_length()
        ids = [int(self.byte_ids[b]) for b in raw]
        after, before = list(range(1, count + 1)), list(range(-1, count))
        tree = [none] * (2 * width)

        def leaf(at: int, right: int) -> int:
            rank = pairs.get(ids[at] * base + ids[right]) if right < count else None
            return none if rank is None else rank * width + at

        def put(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        for at in range(count - 1):
            tree[width + at] = leaf(at, at + 1)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        live = bytearray(b"\1") * count
        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            right = after[gone]
            ids[at], live[gone], after[at] = rank, 0, right
            if right < count:
                before[right] = at
            put(gone, none)
            put(at, leaf(at, right))
            if before[at] >= 0:
                put(before[at], leaf(before[at], at))
        return [token for token, on in zip(ids, live, strict=True) if on]


@lru_cache(maxsize=2)
def load_codec(ranks_path: str, pattern: str) -> BytePairCodec:
    """One codec per worker process: the vocabulary file is installed on every machine."""
    return BytePairCodec(read_ranks(ranks_path), pattern)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ids' number and hash, the hash of what they decode to.

    With ``keep_ids`` also the ids themselves and the decoded text. Repeated doc_ids keep a row each;
    other columns of ``docs`` are not read. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(ranks_path, pattern)
        for part in text_chunks(batches, "text"):
            encoded = codec.encode_all(part.column("text").to_pylist())
            decoded = codec.decode_all(encoded)
            columns = [
                part.column("doc_id"),
                pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded], pa.string()),
                pa.array([hashlib.sha256(raw).hexdigest() for raw in decoded], pa.string()),
            ]
            if keep_ids:
                columns += [pa.array(encoded, pa.binary()), pa.array([raw.decode() for raw in decoded], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" if keep_ids else ""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
