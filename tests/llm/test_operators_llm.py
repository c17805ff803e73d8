"""Each corpus operator against brute force on small rows: NULLs, empty and long texts, ties, repeats."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from parity import differences

from tallyreel.llm import bpe, cotraining, decontaminate, hilbert, language_id, near_dedup, permutation_index, quotes, repeats, token_scan
from tallyreel.llm.common import connected_classes
from tallyreel.llm.queries import END_OF_DOCUMENT, ORACLE, RANKS

DOCS = "doc_id long, text string, lang string, source string, n_chars long, curve string, shard string"


def frame(spark, texts, first=0):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(first + i, t, "en" if i % 2 else None, f"src{i % 3}", len(t) if t else None, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# -- connected classes ------------------------------------------------------------------------


def test_connected_classes_of_chains_hubs_and_loops(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(5, n) for n in range(1000, 1300)]
    loose = [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(260)]
    edges = [*chain, *hub, *loose, (7, 7), (None, 4)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in [*chain, *hub, *loose]:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["class_id"] for r in connected_classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n or any(find(m) == n for m in parent if m != n)}
    assert connected_classes(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1: language identification ---------------------------------------------------------------


def test_language_id_learns_and_rejects(spark):
    rng = random.Random(5)
    stock = {"aa": ["lor", "mip", "sud", "tek"], "bb": ["qua", "zei", "xon", "vir"]}
    make = lambda lang: " ".join("".join(rng.choices(stock[lang], k=3)) for _ in range(40))
    rows = [(i, make(lang), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    rows += [(900, None, "aa"), (901, make("aa"), None), (902, "", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs, per_language=20)
    assert set(model) == {"aa", "bb"}
    asked = spark.createDataFrame(
        [(1, make("aa")), (2, make("bb") * 300), (3, None), (4, ""), (5, "12 34 !!"), (1, make("aa"))], "doc_id long, text string"
    )
    out = language_id.predict(asked, model).collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in out] == [(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (1, "aa")]
    assert all(0 <= r["score"] <= 1 for r in out)
    assert [r["rejected"] for r in out] == [False, False, True, True, True, False]
    # Both dictionaries alike: nothing to tell them apart.
    tied = language_id.predict(asked, {"aa": b"same text", "bb": b"same text"}).first()
    assert tied["lang_pred"] == "aa" and tied["rejected"]
    assert language_id.learn(docs.limit(0)) == {}
    assert {r["lang_pred"] for r in language_id.predict(asked, {}).collect()} == {"und"}


def test_a_common_opening_fills_no_dictionary(spark):
    rng = random.Random(15)
    header = "all rights reserved " * 60
    rows = [(i, header + " ".join(rng.choices(stock, k=900)), lang) for i in range(60)
            for lang, stock in (("aa", ["lormip", "sudtek"]), ("bb", ["quazei", "xonvir"]))]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), slice_chars=1024)
    for lang, own, other in (("aa", b"lormip", b"quazei"), ("bb", b"quazei", b"lormip")):
        assert model[lang].count(own) > 1000 > model[lang].count(b"reserved") and other not in model[lang]


# -- 2: quality by co-training ----------------------------------------------------------------


def test_co_training_separates_and_calibrates(spark):
    rng = random.Random(6)
    good = [words(rng, 120) + ". " + words(rng, 80) for _ in range(120)]
    bad = [" ".join([f"w{i}!!"] * 150).upper() for i in range(120)]
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    docs = frame(spark, [*texts, None, "", words(rng, 30_000)])
    labels = [(i, 1 - i % 2, 0) for i in range(160)] + [(0, 1, 0), (None, 1, 0), (5000, 0, 0), (3, None, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = cotraining.fit(docs, table)
    out = {r["doc_id"]: r for r in cotraining.score(docs, model).collect()}
    assert len(out) == 243
    assert all(out[i]["keep"] == (i % 2 == 0) for i in range(160, 240))
    assert not out[240]["keep"] and not out[241]["keep"] and out[241]["score"] == 0
    kept = cotraining.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["keep"]}
    # One class only: nothing can be learned, nothing but empty texts goes.
    one = cotraining.fit(docs, table.filter("quality = 1"))
    assert one is None and cotraining.score(docs, one).filter("keep").count() == 241
    assert cotraining.score(docs.limit(0), model).count() == 0


# -- 3: near-duplicates -----------------------------------------------------------------------


def test_sampling_agrees_with_weighted_jaccard():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 900, np.uint64)
    idf = near_dedup.Idf({})
    sets = []
    for low, high in ((0, 700), (150, 900)):
        mine = np.sort(keys[low:high])
        weight = np.where(mine % np.uint64(3) == 0, 2.0, 1.0) * idf.usual
        sets.append((mine, weight))
    shared = np.intersect1d(sets[0][0], sets[1][0])
    size = lambda k: np.where(k % np.uint64(3) == 0, 2.0, 1.0).sum()
    truth = size(shared) / (size(sets[0][0]) + size(sets[1][0]) - size(shared))
    drawn = []
    for salt in range(12):  # other elements, same shape
        mixed = [(near_dedup.mix(k + np.uint64(salt)), w) for k, w in sets]
        pair = [near_dedup.samples(np.zeros(len(k), np.int64), k[o := np.argsort(k)], w[o], idf.usual)[1][0] for k, w in mixed]
        drawn.append((pair[0] == pair[1]).mean())
    assert abs(np.mean(drawn) - truth) < 0.05


def jaccard(a, b):
    def bag(t):
        w = t.lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    a, b = bag(a), bag(b)
    weight = lambda counts: sum(1 + np.log(n) for n in counts.values())
    return weight(a & b) / max(1, weight(a | b))


def test_near_classes_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [words(rng, 150) for _ in range(30)]
    for i in range(12):  # a few changed words at the end: near; at many places: far
        w = texts[i].split()
        texts.append(" ".join([*w[:-3], "p", "q", f"r{i}"]))
        texts.append(" ".join(x if n % 6 else f"z{n}" for n, x in enumerate(w)))
    texts += [texts[0], texts[0], texts[3], "one two three", "One  two three", "", "", None, None, "solo"]
    # Long runs of one phrase do not make different texts alike.
    texts += [words(rng, 60) + " same two" * 400 for _ in range(5)]
    family = words(rng, 200).split()
    texts += [" ".join([*family[:-2], f"f{i}", f"g{i}"]) for i in range(60)]
    docs = frame(spark, texts)
    docs = docs.union(docs.filter("doc_id = 2")).union(docs.filter("doc_id = 5"))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    assert len(got) == len(texts)
    parent = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if texts[a] is not None and texts[b] is not None and (texts[a] == texts[b] or jaccard(texts[a], texts[b]) >= 0.8):
                low, high = sorted((parent[a], parent[b]))
                parent = [low if p == high else p for p in parent]
    assert got == dict(enumerate(parent))
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(parent)
    assert near_dedup.near_classes(docs.limit(0)).count() == 0


def test_near_classes_of_repeated_and_null_ids(spark):
    rng = random.Random(31)
    a, b, c, d = (words(rng, 100) for _ in range(4))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (5, c), (5, c), (None, c), (None, d), (None, d), (9, None), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "q", t) for i, t in rows], "doc_id long, text string, node string, digest string").repartition(4)
    got = [(r["doc_id"] or 0, r["class_id"]) for r in near_dedup.near_classes(docs).collect()]
    # Texts of one id are one document; a NULL id takes the id of its class, if there is one.
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (3, 1), (5, 5), (9, 9), (0, 5), (0, None)], key=str)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    rest = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert [i for i, _ in rest] == [0, 0, 1, 5, 9, 9] and rest[0] == (0, "") and rest[1] == (0, d) and rest[2][1] in (a, b)


@pytest.mark.parametrize("similarity", [0.5, 0.8])
def test_prefixes_lose_no_pair(similarity):
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 63, 60, np.uint64)
    sets = [np.sort(rng.choice(pool, rng.integers(1, 40), replace=False)) for _ in range(60)]
    sets += [np.sort(np.append(s[:-1], rng.integers(0, 1 << 63, 1, np.uint64))) for s in sets[:30]] + sets[:3]
    weight = {k: 1 + i % 5 / 2 for i, k in enumerate(sorted({k for s in sets for k in s.tolist()}))}
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes = np.concatenate(sets)
    prefixes = near_dedup.Prefixes(owner, hashes, np.array([weight[k] for k in hashes.tolist()]), len(sets), similarity)
    got = {(min(i, j), max(i, j)) for i in range(len(sets)) for j in prefixes.reaching(i, prefixes.candidates(i)).tolist()}
    bags = [set(s.tolist()) for s in sets]
    total = lambda keys: sum(weight[k] for k in keys)
    near = lambda x, y: total(x & y) >= similarity * total(x | y) - 1e-9
    assert got == {(i, j) for j in range(len(sets)) for i in range(j) if near(bags[i], bags[j])}


@pytest.mark.parametrize("block", [64, 20])
def test_near_classes_of_large_mixed_buckets(spark, monkeypatch, block):
    """A star of 500 copies of one text, and a family just under the limit that hides pairs above it."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(21)

    def edited(text, n):
        w = text.split()
        for at in rng.sample(range(0, len(w), 10), n):
            w[at + rng.randrange(5)] = f"e{rng.randrange(10**9)}"
        return " ".join(w)

    base, template = words(rng, 300, 10**6), words(rng, 300, 10**6)
    texts = [base] + [edited(base, 5) for _ in range(500)]
    for _ in range(80):
        one = edited(template, 5)
        texts += [one, edited(one, 6)]
    rng.shuffle(texts)
    held = {}
    for i, text in enumerate(texts):
        w = text.split()
        for n in range(len(w) - 4):
            held.setdefault(tuple(w[n : n + 5]), []).append(i)
    share = np.zeros((len(texts), len(texts)))
    for who in held.values():
        share[np.ix_(who, who)] += 1
    alike = share / (share.diagonal()[:, None] + share.diagonal() - share) >= 0.8
    root = np.arange(len(texts))
    while (low := np.where(alike, root, len(texts)).min(axis=1)).tolist() != root.tolist():
        root = low
    # Short texts beside them keep every shingle below a tenth of all documents.
    docs = frame(spark, [*texts, *(f"alone{i}" for i in range(6000))])
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect() if r["doc_id"] < len(texts)}
    assert got == dict(enumerate(root.tolist()))


def test_frequent_shingles_are_counted_exactly(spark):
    rng = random.Random(9)
    common = "this very line stands everywhere you look"
    docs = frame(spark, [words(rng, 40) + (" " + common if i % 3 == 0 else "") for i in range(90)])
    idf = near_dedup.frequent_shingles(docs)
    assert len(idf.keys) == 3 and np.allclose(idf.values, np.log1p(90 / 30))


# -- 4: permutation index ---------------------------------------------------------------------


def brute_neighbours(ids, x, query, k=5):
    n = np.sqrt((x * x).sum(axis=1))
    at = ids.index(query)
    scores = (x * x[at]).sum(axis=1) / (n * n[at])
    order = sorted((-round(s, 12), i) for s, i in zip(scores, ids, strict=True) if i != query)
    return [i for _, i in order[:k]]


def test_permutation_index_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 1200)] + 0.4 * rng.normal(size=(1200, 16))
    x[100:160] = x[7]  # a group of copies
    x[200] = 3 * x[201]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, [1.0] * 3), (5005, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    out = permutation_index.nearest(vectors, vectors.filter("vec_id % 50 = 0").select("vec_id"))
    got = {}
    for r in out.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert set(got) == set(range(0, 1200, 50)) and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(len(set(g.values()) & set(brute_neighbours(list(range(1200)), x, q))) for q, g in got.items())
    assert hits >= 0.9 * 5 * len(got)
    assert [got[150][r] for r in range(1, 6)] == [7, 100, 101, 102, 103]
    assert got[200][1] == 201


def test_permutation_index_of_few_rows(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (50, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, vector array<float>")
    rows = permutation_index.nearest(vectors, vectors.select("vec_id")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in rows) == [(0, 1, 50), (0, 2, 3), (3, 1, 50), (3, 2, 0), (50, 1, 0), (50, 2, 3)]
    assert permutation_index.nearest(vectors.limit(0), vectors.limit(0).select("vec_id")).count() == 0


def answers(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    return got


def test_permutation_index_of_repeated_ids(spark):
    same, near, far = [1.0, 0.0], [1.0, 0.1], [0.0, 1.0]
    rows = [(1, same)] * 7 + [(9, same), (10, near), (11, far), (12, far), (12, far)]
    got = answers(permutation_index.nearest(vectors := spark.createDataFrame(rows, "vec_id long, vector array<double>"), vectors.select("vec_id")))
    assert got[1] == [9, 10, 11, 12, 12]
    assert got[9] == [1] * 5 and got[10] == [1] * 5
    assert got[11] == [12, 12, 10, 1, 1] and got[12] == [11, 10, 1, 1, 1]


def test_permutation_index_of_an_id_with_many_vectors(spark):
    # Eight vectors of id 1 lie nearest to each other and must not use up its places.
    rows = [(1, [1.0, 0.001 * i]) for i in range(8)] + [(2, [1.0, 0.5]), (3, [1.0, 0.6]), (4, [0.0, 1.0]), (4, [1.0, 0.0035])]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = answers(permutation_index.nearest(vectors, vectors.select("vec_id")))
    assert got[1] == [4, 2, 3, 4] and got[2] == [3, 1, 1, 1, 1]


def test_permutation_index_in_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "FILE_ROWS", 300)
    x = np.random.default_rng(5).normal(size=(6000, 12))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    got = answers(permutation_index.nearest(vectors, vectors.filter("vec_id % 50 = 0").select("vec_id")))
    assert set(got) == set(range(0, 6000, 50)) and all(len(set(g)) == 5 for g in got.values())
    hits = sum(len(set(g) & set(brute_neighbours(list(range(6000)), x, q))) for q, g in got.items())
    assert hits >= 0.9 * 5 * len(got)


# -- 5: token counts --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", None, "a", "hello world's  \n\n x", " " * 700 + "z", "naïve ✓ 日本語 𝒳" * 5, "ab" * 257, "<|endoftext|>", "x" * 511, "x" * 513, "'s 't re",
    "don't we'll I'd 'tis ''s a  'm", "\n\n", "   x", "1¹ⅷ2", "y" * 40_000,
]


@pytest.mark.parametrize("block_ids", [3, 64, 1 << 17])
def test_token_counts_over_blocks(spark, encoder, block_ids):
    rng = random.Random(block_ids)
    texts = [*TEXTS[:-1], *(words(rng, rng.randrange(60)) for _ in range(40))]
    docs = frame(spark, texts).repartition(3)
    blocks = token_scan.settle(
        token_scan.tokenize(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, END_OF_DOCUMENT, block_ids=block_ids)
    )
    rows = token_scan.count_tokens(blocks, END_OF_DOCUMENT).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(encoder.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert len(rows) == len(texts) and all(r["closed"] for r in rows)


def test_token_counts_of_flat_files(spark, tmp_path):
    ids = np.array([1, 2, 9, 9, 3, 4, 5, 6, 7, 8, 9, 1, 1], "<u2")
    ids.tofile(tmp_path / "a.bin")
    np.array([9], "<u2").tofile(tmp_path / "b.bin")
    (tmp_path / "c.bin").touch()
    rows = token_scan.count_tokens(token_scan.read_flat_files(spark, str(tmp_path), block_ids=2), 9).collect()
    files = {}
    for r in rows:
        files.setdefault(r["file_id"], []).append((r["ordinal"], r["n_tokens"], r["closed"]))
    assert sorted(sorted(f) for f in files.values()) == [[(0, 0, True)], [(0, 2, True), (1, 0, True), (2, 6, True), (3, 2, False)]]


def test_token_scan_carries_over_many_spans(spark):
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 5000, 3 * token_scan.SPAN * 4)
    ids[[5, 2000, 2001]] = 7000
    ids[ids == 7] = 8
    ids[[5, 2000, 2001]] = 7
    rows = [(1, i, ids[4 * i : 4 * i + 4].astype("<u2").tobytes(), None) for i in range(len(ids) // 4)]
    out = token_scan.count_tokens(spark.createDataFrame(rows, token_scan.BLOCKS), 7).orderBy("ordinal").collect()
    assert [(r["n_tokens"], r["closed"]) for r in out] == [(5, True), (1994, True), (0, True), (len(ids) - 2002, False)]


# -- 6: byte-level BPE ------------------------------------------------------------------------


def test_bpe_equals_the_library_and_decodes(spark, encoder):
    rng = random.Random(7)
    mixed = ["".join(rng.choice("abc é\n1!'st") for _ in range(rng.randint(1, 300))) for _ in range(80)]
    texts = [*TEXTS, *mixed]
    docs = frame(spark, texts)
    docs = docs.union(docs.filter("doc_id = 3"))
    rows = bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep_ids=True).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = np.array(encoder.encode_ordinary(text), "<u4").tobytes()
        assert bytes(r["ids"]) == ids and r["n_tokens"] == len(ids) // 4 and r["decoded"] == text
        assert r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_decode(docs.limit(0), public_tokenizers.path(RANKS), public_tokenizers.PATTERN).count() == 0


def test_bpe_forgets_without_changing(monkeypatch, encoder):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 20)
    codec = bpe.BytePairCodec(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    rng = random.Random(1)
    for _ in range(30):
        text = words(rng, 30, 60)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == encoder.encode_ordinary(text)


def test_very_long_texts_go_through_in_stretches(monkeypatch, encoder):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    codec = bpe.BytePairCodec(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    text = "  it's 12 o'clock \n\n and  all's well! é" * 40 + "x" * 300 + " end"
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == encoder.encode_ordinary(text)
    whole = near_dedup.shingles(pa.array([text * 30]))
    monkeypatch.setattr(near_dedup, "CHUNK_BYTES", 64)
    assert all((a == b).all() for a, b in zip(whole, near_dedup.shingles(pa.array([text * 30])), strict=True))


def test_bpe_of_pieces_with_one_hash(encoder):
    """Long Thue-Morse words and their complements collide in every polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    codec = bpe.BytePairCodec(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    for texts in ([one, other], [other], [one], [f"x {one} {other} x {one}", "", other]):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in codec.encode_all(texts)]
        assert got == [encoder.encode_ordinary(t) for t in texts]


def test_bpe_takes_other_patterns():
    codec = bpe.BytePairCodec(bpe.read_ranks(public_tokenizers.path(RANKS)), r"\w+|\W+")
    assert codec.decode(codec.encode("one two, thrée")) == "one two, thrée".encode()


# -- 7: quotes --------------------------------------------------------------------------------


def test_quotes_link_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nIt is slow."),
        (1, 1, "assistant", "> how do I SORT\nUse an index."),
        (1, 2, "user", "Unrelated: what is Spark?"),
        (1, 3, "user", ">> It is slow!\n> Use an index.\nThanks."),
        (1, 4, "assistant", "> Unrelated: what is Spark?\nAn engine."),
        (1, 5, "user", "> never said\nok"),
        (2, 0, "user", "> Use an index.\nOther conversation."),
        (3, 0, None, None),
        (3, 1, "user", ""),
        (3, None, "user", "no turn"),
        (None, 0, "user", "no conversation"),
        (4, 0, "user", "same"),
        (4, 0, "user", "same"),
        (4, 1, "user", "> same"),
    ]
    for limit in (1_000_000, 2):
        messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as linked", "2 as position")
        out = quotes.reply_order(messages, max_group_rows=limit)
        assert out.count() == len(rows)
        one = out.filter("conv_id = 1").orderBy("position").collect()
        assert [(r["turn"], r["parent"], r["thread"], r["text"]) for r in one] == [
            (0, None, 0, "How do I sort?\nIt is slow."),
            (1, 0, 0, "Use an index."),
            (3, 1, 0, "Thanks."),
            (2, None, 2, "Unrelated: what is Spark?"),
            (4, 2, 2, "An engine."),
            (5, None, 5, "ok"),
        ]
        assert [r["position"] for r in one] == [1, 2, 3, 4, 5, 6]
        assert one[2]["formatted"] == "<|user|>\nThanks.\n<|end|>\n"
        assert out.filter("conv_id = 2").first()["parent"] is None
        assert [r["parent"] for r in out.filter("conv_id = 4").orderBy("position").collect()] == [None, None, 0]
    assert quotes.reply_order(messages.limit(0)).count() == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert differences(out, con, ORACLE["op7_chat_formatting"]) == []


def test_long_quote_prefixes(spark):
    signs = ">" * 100_000
    rows = [(1, 1, "u", "first words"), (1, 2, "a", f"{signs} first words\n{' >' * 50_000} first words\nown"), (1, 3, "u", f"{signs[:-1]}x{signs}")]
    out = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("turn").collect()
    assert [(r["parent"], r["linked"], r["text"]) for r in out] == [(None, 0, "first words"), (1, 4, "own"), (None, 0, "")]


def test_quotes_stay_in_the_jvm(spark):
    messages = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = quotes.reply_order(messages)._jdf.queryExecution().toString()
    assert not any(sign in plan for sign in ("Python", "Arrow", "Pandas"))


# -- 8: Hilbert shards ------------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3)])
def test_curve_visits_neighbours(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), axis=-1).reshape(-1, dims)
    index = hilbert.curve_index(cells, bits)
    assert sorted(index) == list(range(side**dims))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards_have_equal_rows_and_gapless_slots(spark):
    rng = random.Random(2)
    texts = [words(rng, rng.randrange(50)) for _ in range(150)] + ["copy"] * 60 + [None, "", "é" * 5000]
    docs = frame(spark, texts)
    rows = hilbert.shard_rows(docs, shards=7).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(7):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert all(sizes[i] == len((t or "").encode()) + 16 for i, t in enumerate(texts))
    few = hilbert.shard_rows(docs.limit(3), shards=40).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert hilbert.shard_rows(docs.limit(0)).count() == 0


def test_written_shards_are_narrow(spark, tmp_path):
    rows = [(i, f"s{i % 16:02d}", (i * 7919) % 1000, "t" * (i % 5)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, score long, text string")
    hilbert.write_shards(df, str(tmp_path / "out"), ["source", "score"], 16, ["doc_id"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4000
    bounds = back.groupBy("shard").agg({"score": "min"}).collect()
    spans = back.groupBy("shard").agg(
        hilbert.F.expr("max(score) - min(score)").alias("w"), hilbert.F.countDistinct("source").alias("n")
    ).collect()
    assert len(bounds) == 16 and all(r["w"] < 600 and r["n"] <= 10 for r in spans)


def test_text_dimensions_are_cut_by_whole_values(spark):
    names = [f"https://a.very.long.common.head/{i:02d}" for i in range(12)]
    rows = [(n, names[n % 12] if n % 5 else names[0]) for n in range(600)] + [(n, None) for n in range(600, 620)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    assert hilbert.text_fences(df, "source", 1 << 8) == names
    counts = Counter(s for _, s in rows if s)
    for cells in (2, 4, 8):
        want, upto = [], 0
        for name in names:
            low, upto = upto, upto + counts[name]
            want += [name] if upto * cells // 600 > low * cells // 600 else []
        assert hilbert.text_fences(df, "source", cells) == want[: cells - 1]
    curve = {(r["source"], r["curve"]) for r in hilbert.hilbert_order(df, ["source"]).collect()}
    assert len(curve) == 13 and [s for s, _ in sorted(curve, key=lambda c: c[1])] == [None, *names]
    assert hilbert.text_fences(df.filter("source is null"), "source", 8) == []


# -- 9: decontamination -----------------------------------------------------------------------


def edit_distance_inside(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for sign in text:
        last, row[0] = row[0], 0
        for i, c in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (c != sign))
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance_equals_dynamic_programming():
    rng = random.Random(11)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60))) + item[: rng.randint(0, len(item))]
        got = decontaminate.best_distance(item, text, len(item))
        want = edit_distance_inside(item, text)
        assert (got[0] if got else len(item)) == want


def test_items_are_found_with_edits(spark):
    rng = random.Random(12)
    items = [" ".join(f"word{rng.randrange(900)}" for _ in range(20)) for _ in range(12)]
    texts = []
    for item in items:
        edited = list(item)
        for at in rng.sample(range(len(edited)), 4):
            edited[at] = "#" if edited[at] == " " else "z"
        texts += [words(rng, 50) + " " + item.upper() + "!", words(rng, 30) + "".join(edited), words(rng, 60), item[: len(item) // 2]]
    texts += [None, "", words(rng, 40_000), items[0] + " " + items[5]]
    docs = frame(spark, texts)
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "short"), (None, items[1]), (92, items[3])], "item_id long, text string")
    want = {}
    for i, text in enumerate(texts):
        plain = decontaminate.normalise(text)
        near = lambda t: edit_distance_inside(t, plain) <= int(len(t) * decontaminate.EDIT_SHARE)  # noqa: B023, E731
        want[i] = sorted([n for n, t in enumerate(items) if len(plain) < 9000 and near(decontaminate.normalise(t))])
        want[i] += [92] if 3 in want[i] else []
        want[i] += [91] if " short " in f" {plain} " else []
    for size in (decontaminate.BLOCK_BYTES, 900):  # in one block, and in several
        out = {r["doc_id"]: r for r in decontaminate.find_items(docs, bench, block_bytes=size).collect()}
        assert {i: sorted(r["item_ids"]) for i, r in out.items()} == want
        assert all(r["contaminated"] == bool(want[i]) and r["n_items"] == len(want[i]) for i, r in out.items())
        kept = decontaminate.drop_contaminated(docs, bench, block_bytes=size)
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if not w}
    assert decontaminate.find_items(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.find_items(docs.limit(0), bench).count() == 0


def test_null_ids_short_items_and_fewest_edits(spark):
    rng = random.Random(13)
    items = [" ".join(f"word{rng.randrange(900)}" for _ in range(12)) for _ in range(6)]
    edited = items[0].replace("word", "wurd", 2)
    rows = [(None, f"see {item} there") for item in items] + [(7, f"{edited} and then {items[0]}"), (7, edited), (7, "nothing here")]
    rows += [(8, "So, what is 2+2?"), (9, "so what is 2 22"), (10, "What is 2+2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([*enumerate(items), (50, "what is 2+2?")], "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 200):
        out = decontaminate.find_items(docs, bench, block_bytes=size).collect()
        assert len(out) == len(rows)
        assert sorted(r["item_ids"] for r in out if r["doc_id"] is None) == [[i] for i in range(6)]
        assert sorted((r["item_ids"], r["min_edits"]) for r in out if r["doc_id"] == 7 and r["contaminated"]) == [([0], 0), ([0], 2)]
        assert sorted(r["doc_id"] for r in out if r["item_ids"] == [50]) == [8, 10]
        kept = sorted((r["doc_id"], r["text"]) for r in decontaminate.drop_contaminated(docs, bench, block_bytes=size).collect())
        assert kept == [(7, "nothing here"), (9, "so what is 2 22")]


# -- 10: repeated strings ---------------------------------------------------------------------


def brute_removal(texts):
    """Per document: bytes, and a mask of what goes."""
    seen, masks = set(), []
    for text in texts:
        raw = (text or "").encode()
        mask = np.zeros(len(raw), bool)
        for at in range(len(raw) - repeats.SPAN + 1):
            piece = raw[at : at + repeats.SPAN]
            if piece in seen:
                mask[at : at + repeats.SPAN] = True
            seen.add(piece)
        masks.append((raw, mask))
    return masks


def repeat_texts(rng):
    passage = words(rng, 40)
    line = words(rng, 20)
    texts = [words(rng, rng.randrange(5, 120), 500) for _ in range(40)]
    for i in range(0, 40, 3):
        w = texts[i].split()
        w.insert(rng.randrange(len(w)), passage)
        texts[i] = " ".join(w)
    for i in range(0, 40, 2):
        texts[i] += line[: rng.randrange(90, len(line))] + words(rng, 3)
    texts += [texts[3], texts[3], None, "", "a" * 99, "a" * 100, "a" * 101, "b" * 1000, "ab" * 400, "é" * 130, passage, passage[:120]]
    texts += [passage[i : i + 110] + "x" + passage[i + 20 :] for i in range(0, 60, 7)]
    return texts


def check_removal(spark, texts, docs):
    want = brute_removal(texts)
    rows = {r["doc_id"]: r for r in repeats.removal_digests(docs).collect()}
    assert set(rows) == set(range(len(texts)))
    for i, (raw, mask) in enumerate(want):
        r = rows[i]
        runs = int(((np.diff(mask.astype(np.int8), prepend=0)) == 1).sum())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), int(mask.sum()), runs), (i, texts[i])
        assert r["kept_sha256"] == hashlib.sha256(np.frombuffer(raw, np.uint8)[~mask].tobytes()).hexdigest()
    return want


def test_removal_equals_brute_force(spark):
    texts = repeat_texts(random.Random(13))
    docs = frame(spark, texts)
    want = check_removal(spark, texts, docs)
    cut = repeats.cut_repeats(docs)
    assert cut.columns == docs.columns
    for r in cut.collect():
        raw, mask = want[r["doc_id"]]
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes().decode(errors="ignore")
        assert (r["text"] or "") == kept
    assert repeats.removal_digests(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [2, 5])
def test_removal_with_hot_grams_cut(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_ROWS", hot)
    monkeypatch.setattr(repeats, "PART_ROWS", 7)
    texts = repeat_texts(random.Random(14))
    check_removal(spark, texts, frame(spark, texts))


def test_removal_of_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 700)
    rng = random.Random(15)
    long = words(rng, 900, 60)
    texts = [long, words(rng, 100), long[500:2500] + words(rng, 300, 60), long[::-1]]
    docs = frame(spark, texts).repartition(4, "doc_id")
    check_removal(spark, texts, docs)


def test_repeated_rows_do_not_erase_each_other(spark):
    docs = frame(spark, [words(random.Random(1), 100), "x"])
    out = repeats.removal_digests(docs.union(docs)).collect()
    assert len(out) == 4 and all(r["n_removed"] == 0 for r in out)


def test_texts_that_share_an_id_or_have_none_are_documents_of_their_own(spark):
    rng = random.Random(16)
    passage = words(rng, 30)
    # No id: a passage within one text twice, and another text that it does not touch.
    twice, other = f"{passage} and {passage}", words(rng, 120)
    # An id with a copy and with a longer and a shorter other text; the passage stands in the longer one.
    source, mixed = words(rng, 60), words(rng, 50) + " " + passage + words(rng, 400)
    rows = [(None, twice), (None, other), (None, other), (3, source), (9, source), (9, mixed), (9, "short " + words(rng, 16)), (9, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in repeats.removal_digests(docs).collect())
    gone = {}
    for (_, text), (raw, mask) in zip(rows, brute_removal([t for _, t in rows]), strict=True):
        gone.setdefault(text, []).append((raw, mask))
    want = Counter()
    for i, (doc_id, text) in enumerate(rows):
        raw, mask = gone[text][1 if i == 4 else 0]  # of equal rows without an id none erases the other
        want[doc_id, len(raw), int(mask.sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~mask].tobytes()).hexdigest()] += 1
    assert got == want and sum(n for (_, _, removed, _), n in got.items() if removed) == 3


def test_suffix_ranks_are_byte_order():
    rng = np.random.default_rng(3)
    entries = rng.integers(97, 99, (40, repeats.WIDTH)).astype(np.uint8)
    entries[20:] = entries[:20]
    ranks = repeats.suffix_ranks(entries)
    strings = [[bytes(e[s : s + repeats.SPAN]) for s in range(repeats.REACH + 1)] for e in entries]
    order = {s: i for i, s in enumerate(sorted({s for row in strings for s in row}))}
    assert ranks.tolist() == [[order[s] for s in row] for row in strings]


def test_flat_bytes_of_slices():
    from tallyreel.llm.common import flat_bytes

    data, offsets = flat_bytes(pa.array(["ab", None, "", "cde"]).slice(1))
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 0, 3]
