"""Language identification by compression.

Every learned language has a raw-content zstandard dictionary made of its own text. A text is
compressed against each of them; the language whose dictionary leaves the fewest bytes wins. Where
the runner-up is almost as short, the answer is marked as rejected.

Training takes a bounded sample of labelled rows: per language the ``per_language`` distinct texts with the
smallest hash. Each gives ``slice_chars`` characters from a place that its hash picks anywhere in the
whole text, so that no common opening of texts fills a dictionary. Prediction reads whole texts,
in blocks of ``BLOCK`` bytes that are compressed one by one and summed, so that a long text keeps
meeting the dictionary and memory stays flat. On both sides case is lowered, and whatever stands between
letters becomes one space: signs and digits tell nothing of the language.

Rows: a NULL text, and one without any letter, gives ``und`` with score 0, rejected. Equal sizes go
to the language that sorts first. With no labelled row at all every text gives ``und``. Rows with a
NULL text or language teach nothing. Repeated rows are predicted alike, each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
BLOCK = 16 << 10
SLOTS = 64
LEVEL = 8
# Bytes by which a runner-up must be longer to be e times less likely.
TEMPERATURE = 8.0

LETTER = regex.compile(r"\p{L}")
GAPS = regex.compile(r"[^\p{L}]+")


def plain(text: str) -> bytes:
    return GAPS.sub(" ", text.lower()).encode()


def learn(labelled: DataFrame, per_language: int = 512, slice_chars: int = 1024) -> dict[str, bytes]:
    """Dictionaries by language from rows (text, lang): at most per_language x slice_chars characters each."""
    rows = labelled.filter("text is not null and lang is not null").withColumn("_h", F.xxhash64("text"))
    chosen = rows.groupBy("lang", "_h").count().withColumn("_slot", F.pmod("_h", F.lit(SLOTS)))
    # First within slots of a language, so that its last choice is among a bounded number, whatever its rows.
    for keys in (["lang", "_slot"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("_h")
        chosen = chosen.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language)
    chosen = chosen.select("lang", "_h")
    slices = F.ceil(F.length("text") / slice_chars)
    start = F.pmod(F.shiftright("_h", 7), F.greatest(slices, F.lit(1))) * slice_chars + 1
    # At most per_language rows a language; copies of one text come once.
    part = F.substring(F.col("text"), start.cast("int"), F.lit(slice_chars))
    picked = rows.join(F.broadcast(chosen), ["lang", "_h"]).select("lang", "_h", part.alias("part"))
    picked = picked.groupBy("lang", "_h").agg(F.min("part").alias("part"))
    texts: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "_h").collect():
        texts.setdefault(row["lang"], []).append(row["part"])
    return {lang: b"\n".join(map(plain, parts)) for lang, parts in texts.items()}


class CompressionClassifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.packers = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False))

    def sizes(self, raw: bytes) -> np.ndarray:
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return np.array([sum(len(p.compress(b)) for b in blocks) for p in self.packers], np.float64)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): margin is the share by which the runner-up is longer."""
        if not self.names or not text or not LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(plain(text))
        best = int(sizes.argmin())
        score = 1.0 / np.exp(-(sizes - sizes[best]) / TEMPERATURE).sum()
        others = np.delete(sizes, best)
        margin = float(others.min() - sizes[best]) / float(others.min()) if len(others) else 1.0
        return self.names[best], float(score), margin


def predict(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for every row of ``docs``; only its text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = CompressionClassifier(dictionaries)
        for batch in batches:
            out = [classify(text.as_py()) for text in batch.column("text")]
            margins = [o[2] for o in out]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([o[0] for o in out], pa.string()),
                    pa.array([o[1] for o in out], pa.float64()),
                    pa.array(margins, pa.float64()),
                    pa.array([m < min_margin for m in margins], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    schema = "doc_id long, lang_pred string, score double, margin double, rejected boolean"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """The fold that is kept out of training: crc32 of the id as text leaves remainder 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
