"""License scans: the token automaton against regular expressions over the words, text by text."""

import random
import re

import duckdb
import numpy as np
import pytest

from tallyreel.llm import license_scan as L
from tallyreel.llm import queries

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def pattern(parts):
    out = ""
    for p in parts:
        if isinstance(p, L.Optional):
            out += f"(?:{pattern(p.parts)})?"
        elif isinstance(p, L.Gap):
            out += f"(?:[^ ]+ ){{{p.least},{p.most}}}"
        else:
            out += re.escape(p) + " "
    return out


def brute(text, templates):
    """(template, first, last) with the last of several ends, by trying every stretch of words."""
    w, out = words(text), set()
    for number, (_, _, wording) in enumerate(templates):
        rule = re.compile(pattern(L.parse(wording)))
        for i in range(len(w)):
            ends = [j for j in range(i, len(w)) if rule.fullmatch(" ".join(w[i : j + 1]) + " ")]
            out |= {(number, i, max(ends))} if ends else set()
    return out


def scanned(texts, templates):
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    counts, spans = L.Scanner(templates).scan(data, offsets)
    by_text = [set() for _ in texts]
    for text, *span in spans.T.tolist():
        by_text[text].add(tuple(span))
    return counts.tolist(), by_text


SMALL = (
    ("a", True, "x y"),
    ("b", False, "x [y [z]] {0,2} w"),
    ("c", False, "[x] {1,3} y"),
    ("d", False, "y {2,2} y"),
    ("e", False, "é日本 y"),
)


def test_automaton_against_expressions():
    draw = random.Random(11)
    texts = ["", None, "x y", "X-Y", "x y x y", "é日本 y"]
    texts += ["".join(draw.choice(["x", "Y", "z", "w", "v1", "é日本"]) + draw.choice([" ", ".", "\n"]) for _ in range(draw.randrange(25))) for _ in range(120)]
    counts, spans = scanned(texts, SMALL)
    assert counts == [len(words(t)) for t in texts]
    for text, mine in zip(texts, spans, strict=True):
        assert mine == brute(text, SMALL), text


def test_slices_hand_on_their_starts(monkeypatch):
    draw = random.Random(12)
    text = " ".join(draw.choice(["x", "y", "z", "w", "vvvvvvvvv"]) for _ in range(300))
    whole = scanned([text], SMALL)
    for size in (1, 3, 16):
        monkeypatch.setattr(L, "CHUNK_BYTES", size)
        assert scanned([text], SMALL) == whole


def license_text(label):
    wording = max((w for name, w in L.TEMPLATES if name == label), key=len)
    text = re.sub(r"\[[^\]]*\{[^\]]*\]|\{0,\d+\}", "", wording)
    return re.sub(r"[\[\]]", "", re.sub(r"\{\d+,\d+\}", "Some Holder", text))


@pytest.mark.parametrize("label", ["mit", "isc", "bsd-2-clause", "bsd-3-clause", "apache-2.0"])
def test_mandatory_wording_must_match(label):
    templates = L.all_templates()
    number = max((n for n, t in enumerate(templates) if t[0] == label), key=lambda n: len(templates[n][2]))
    text = "Code follows. " + license_text(label).upper() + " End."
    _, (found,) = scanned([text], templates)
    assert number in {t for t, _, _ in found}
    # One mandatory word less, or another one, and it is not accepted.
    for wrong in (re.sub(r"(?i)warranties", "", text, count=1), re.sub(r"(?i)warranties", "guarantees", text)):
        _, (found,) = scanned([wrong], templates)
        assert wrong == text or number not in {t for t, _, _ in found}


def test_rows_of_every_kind(spark):
    long = "the mit license " * 60_000
    rows = [(1, "MIT License"), (1, "MIT License"), (None, "GNU General Public License, version 3"), (3, None), (4, ""), (5, "--- ?"), (6, long)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, labels string, n_words string").repartition(2)
    out = L.license_labels(L.find_licenses(docs)).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert by_id[1] == [(2, 1, 0, 0, "mit", "mit", 1.0)] * 2
    assert by_id[None] == [(6, 1, 1, 1, "gpl", "gpl,gpl-3.0", 1.0)]
    assert by_id[3] == by_id[4] == by_id[5] == [(0, 0, None, None, "", "", 0.0)]
    assert by_id[6][0][:6] == (180_000, 60_000, 1, 179_998, "mit", "mit")
    assert L.license_labels(L.find_licenses(docs.limit(0))).count() == 0


def test_op11_against_sql_and_brute_force(spark):
    rows = {r["doc_id"]: r.asDict() for r in queries.op11_license_scan(spark, SF_DIR).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    wanted = con.execute(queries.ORACLE["op11_license_scan"]).df().astype(object)
    wanted = wanted.where(wanted.notna(), None).to_dict("records")
    assert len(wanted) == len(rows) and all(rows[w["doc_id"]] == w for w in wanted)
    assert sum(r["n_base"] for r in rows.values()) > 0 and any(r["labels"] != r["base_labels"] for r in rows.values())
    for doc_id, text in con.execute("SELECT doc_id, text FROM documents").fetchall():
        w = words(text)
        places = [i for _, phrase in L.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        r = rows[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == (min(places, default=None), max(places, default=None))
