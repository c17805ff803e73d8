"""Cross-tokenizer alignment against a brute-force version, token by token."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyreel.llm import queries, token_align

SF_DIR = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(name) for name in (queries.BYTE_LEVEL, queries.PIECES)]


def token_bytes():
    """Token ids and bytes of a text by both libraries, A's bytes from its own offsets being no help: spelled out."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(x): x for x in shown}
    for x in range(256):
        if x not in shown:
            signs[chr(256 + len(signs) - len(shown))] = x

    def both(text):
        ours = a.encode(" " + text, add_special_tokens=False).ids
        theirs = b.encode(text)
        spell_a = [bytes(signs[c] for c in a.id_to_token(i)) for i in ours]
        spell_b = []
        for i in theirs:
            piece = b.id_to_piece(i)
            spell_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        raw = (" " + text).encode()
        if not text or b"".join(spell_a) != raw or b"".join(spell_b) != raw:
            return []
        return [ours, spell_a, theirs, spell_b]

    return both


def brute(texts):
    both, linked, out = token_bytes(), Counter(), []
    for text in texts:
        tokens = both(text or "") if text else []
        if not tokens:
            out.append((0, 0, "", []))
            continue
        spans = []
        for ids, spelled in (tokens[:2], tokens[2:]):
            ends = np.cumsum([len(s) for s in spelled]).tolist()
            spans.append([(i, end - len(s), end) for i, s, end in zip(ids, spelled, ends, strict=True)])
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        linked.update(links)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in spans))
            start = end
        out.append((len(spans[0]), len(spans[1]), ";".join(groups), links))
    best = Counter()
    for (_, j), n in linked.items():
        best[j] = max(best[j], n)
    rows = []
    for n_a, n_b, groups, links in out:
        rows.append(
            (n_a, n_b, len(groups.split(";")) if groups else 0, len(links), sum(linked[p] == best[p[1]] for p in links),
             sum(linked[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        )
    return rows


TEXTS = [
    "a  b", " lead", "trail ", "\n\nx\ttab", "<s> hi </s> <|endoftext|> <0x41>", "é日本語 ＡＢ \U0001f600\U0001f600 naïve", "▁mark", "\x00nul", "   ",
    "", None, "unusualness antidisestablishmentarianism", "1234567890 3.14", "don't we'll", "same text", "same text", "ab" * 300,
]


def frame(spark, texts, parts=3):
    rows = [(n % 7 if n else None, t, "x", "y") for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_a string, chunk string").repartition(parts)


def got(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, *tuple(r)[1:]) for r in df.collect())


def want(texts):
    return sorted((n > 0, n % 7, *row) for n, row in enumerate(brute(texts)))


def test_odd_texts_against_brute_force(spark):
    out = token_align.align(frame(spark, TEXTS), *PATHS)
    assert out.columns == ["doc_id", *token_align.SUMS, "groups_sha256"]
    assert got(out) == want(TEXTS)
    assert token_align.align(frame(spark, TEXTS).limit(0), *PATHS).count() == 0
    nothing = token_align.align(frame(spark, [None, "", "▁"]), *PATHS)
    assert got(nothing) == want([None, "", "▁"])


def test_many_parts_slices_and_stretches(spark, monkeypatch):
    draw = random.Random(5)
    letters = ["the ", "token", "ization ", "x", "é", "日", " ", "\n", "12", "don't "]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 400))) for _ in range(25)] + TEXTS
    wanted = want(texts)
    # Reaches what is sized on the driver and the functions sent to the workers; stretches are tested below.
    monkeypatch.setattr(token_align, "PART", 40)
    monkeypatch.setattr(token_align, "HELD", 64)
    assert got(token_align.align(frame(spark, texts), *PATHS)) == wanted


def test_pieces_of_a_long_text_have_the_same_tokens(monkeypatch):
    both = token_align.load_tokenizers(*PATHS)
    draw = random.Random(6)
    text = "".join(draw.choice(["word", " ", "  ", "é", "\n", " 1", "a", "　", ", "]) for _ in range(4000))
    whole = both.encode([text, " " + text, "", None])
    monkeypatch.setattr(token_align, "CHUNK_BYTES", 50)
    cut = both.encode([text, " " + text, "", None])
    for side, other in zip(whole, cut, strict=True):
        assert [x.tolist() for x in side] == [x.tolist() for x in other]
    assert len(list(token_align._word_pieces(text))) > 20
    ids, other = whole[0][0], whole[1][0]
    sizes = both.a_sizes, both.b_sizes
    spelled = bytes(token_align.Alignment(ids, other, *sizes).spelling()[0])
    monkeypatch.setattr(token_align, "HELD", 30)
    pieces = [token_align.Alignment(ids[a], other[b], *sizes) for a, b in token_align._group_cuts(sizes[0][ids], sizes[1][other])]
    assert len(pieces) > 50 and b"".join(bytes(p.spelling()[0]) for p in pieces) == spelled


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 50_000])
def test_minimal_perfect_hash(count):
    keys = np.random.default_rng(count).permutation(1 << 20)[:count].astype(np.uint32) * 7
    hashed = token_align.PairHash.from_bytes(token_align.PairHash.build(keys).to_bytes())
    assert sorted(hashed.index(keys).tolist()) == list(range(count))
    if count:
        other = hashed.index(np.arange(1, 2000, dtype=np.uint32))
        assert other.min() >= -1 and other.max() < count
        assert len(hashed.to_bytes()) < 40 + count


def test_op12_against_brute_force(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' WHERE len(text) < 2500").fetchall())
    ids = sorted(texts)
    rows = {i: row for i, row in zip(ids, brute([texts[i] for i in ids]), strict=True)}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("length(text) < 2500")
    assert {r["doc_id"]: tuple(r)[1:] for r in token_align.align(docs, *PATHS).collect()} == rows
    # Counts that do not depend on other documents also hold for the query over the whole table.
    whole = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_cross_tokenizer_alignment(spark, SF_DIR).collect()}
    assert all(whole[i][:4] == rows[i][:4] and whole[i][6] == rows[i][6] for i in ids)
    assert len(whole) == duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").fetchall()[0][0]
