"""The registered corpus queries and the pipeline on the smallest driver tables, against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_operators_llm import brute_neighbours, brute_removal, edit_distance_inside, jaccard

import corpus_pipeline
from tallyreel.llm import bpe, decontaminate, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    return {doc_id: (text, lang) for doc_id, text, lang in rows}


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def near_roots(texts):
    parent = {i: i for i in texts}
    ids = list(texts)
    for n, b in enumerate(ids):
        for a in ids[:n]:
            if texts[a] == texts[b] or (min(len(texts[a]), len(texts[b])) > 0.7 * max(len(texts[a]), len(texts[b])) and jaccard(texts[a], texts[b]) >= 0.8):
                low, high = sorted((parent[a], parent[b]))
                parent = {k: low if p == high else p for k, p in parent.items()}
    return parent


def test_op1_held_out_accuracy(spark, docs):
    rows = rows_of(spark, "op1_language_id")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    asked = [r for r in rows if r["held_out"] and docs[r["doc_id"]][1]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]][1] for r in asked]) > 0.85


def test_op2_keeps_good_documents(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, min(quality) FROM '{SF_DIR}/labels.parquet' GROUP BY 1").fetchall())
    rows = rows_of(spark, "op2_quality_classifier")
    known = [r for r in rows if r["doc_id"] in labels]
    assert np.mean([r["keep"] == bool(labels[r["doc_id"]]) for r in known]) > 0.95


def test_op3_classes(spark, docs):
    got = {r["doc_id"]: r["class_id"] for r in rows_of(spark, "op3_minhash_near_dedup")}
    assert got == near_roots({i: t for i, (t, _) in docs.items()})


def test_op4_recall(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in rows_of(spark, "op4_permutation_index"):
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == {i for i in ids if i % 50 == 0}
    assert sum(len(g & set(brute_neighbours(ids, x, q))) for q, g in got.items()) >= 0.9 * 5 * len(got)


def test_op5_and_op6_equal_the_library(spark, docs, encoder):
    want = {i: np.array(encoder.encode_ordinary(t or ""), "<u4") for i, (t, _) in docs.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows_of(spark, "op5_token_counts")} == {i: len(w) for i, w in want.items()}
    for r in rows_of(spark, "op6_byte_bpe"):
        assert r["ids_sha256"] == hashlib.sha256(want[r["doc_id"]].tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]][0] or "").encode()).hexdigest()


def test_op7_keeps_every_message(spark):
    rows = rows_of(spark, "op7_chat_formatting")
    said = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_DIR}/conversations.parquet'").fetchall()
    assert sorted((r["conv_id"], r["turn"], r["role"]) for r in rows) == sorted(s[:3] for s in said)
    # No message quotes here, so every conversation stays in the order of its turns.
    assert not any(">" in s[3] for s in said) and all(r["parent"] is None and r["quoted"] == 0 for r in rows)
    for a, b in zip(ordered := sorted(rows, key=lambda r: (r["conv_id"], r["position"])), ordered[1:], strict=False):
        assert a["conv_id"] != b["conv_id"] or (a["turn"] <= b["turn"] and a["position"] + 1 == b["position"])


def test_op8_obeys_its_law(spark, docs):
    rows = rows_of(spark, "op8_hilbert_shards")
    shards = {}
    for r in rows:
        raw = (docs[r["doc_id"]][0] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert set(shards) == set(range(40)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def items_in(text, items):
    plain = decontaminate.normalise(text)
    grams = {plain[i : i + 12] for i in range(len(plain))}
    # A match with few edits shares a long exact string; only then the slow distance is worth it.
    return [i for i, t in items if any(t[k : k + 12] in grams for k in range(0, len(t) - 11, 3)) and edit_distance_inside(t, plain) <= int(len(t) * 0.05)]


def test_op9_finds_the_items(spark, docs):
    items = [(i, decontaminate.normalise(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    rows = {r["doc_id"]: r for r in rows_of(spark, "op9_benchmark_decontamination")}
    assert set(rows) == set(docs)
    exact = {i: sorted(n for n, t in items if t in decontaminate.normalise(text)) for i, (text, _) in docs.items()}
    assert all(set(exact[i]) <= set(r["item_ids"]) for i, r in rows.items())
    for i in [i for i, r in rows.items() if r["contaminated"]] + sorted(docs)[:6]:
        assert sorted(rows[i]["item_ids"]) == sorted(items_in(docs[i][0][:4000], items)) or len(docs[i][0]) > 4000


def test_op10_equals_brute_force(spark, docs):
    order = sorted(docs)
    want = dict(zip(order, brute_removal([docs[i][0] for i in order]), strict=True))
    for r in rows_of(spark, "op10_suffix_array_dedup"):
        raw, mask = want[r["doc_id"]]
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        assert (r["n_removed"], r["kept_sha256"]) == (int(mask.sum()), hashlib.sha256(kept).hexdigest())


def test_pipeline_equals_its_stages_by_brute_force(spark, docs, encoder):
    kept = {r["doc_id"] for r in rows_of(spark, "op2_quality_classifier") if r["keep"]}
    texts = {i: docs[i][0] for i in sorted(kept)}
    roots = near_roots(texts)
    texts = {i: t for i, t in texts.items() if roots[i] == i}
    masks = brute_removal(texts.values())
    texts = {
        i: np.frombuffer(raw, np.uint8)[~mask].tobytes().decode(errors="ignore") for i, (raw, mask) in zip(texts, masks, strict=True)
    }
    items = [decontaminate.normalise(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    exact = {i for i, t in texts.items() if any(item in decontaminate.normalise(t) for item in items)}
    assert set(got) <= set(texts) - exact and len(set(texts) - exact - set(got)) <= 2  # the rest hold an item with edits
    for i, r in got.items():
        ids = encoder.encode_ordinary(texts[i])
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


def test_stages_take_rows_with_nulls_and_nothing_at_all(spark):
    some = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "text without an id " * 20, "en", "s", 1), (3, "a b c", "en", None, None)]
    frame = spark.createDataFrame([*some, some[3]], "doc_id long, text string, lang string, source string, n_chars long")
    for table in (frame, frame.limit(0)):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == frame.columns
                docs = out
        assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
        out.collect()
