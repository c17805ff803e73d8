"""Quality classifier by co-training on two views of a document.

The text view sees only what the text looks like (sign classes, word repetition, line repetition,
word lengths); the metadata view sees only source, language and length columns. Each view has its
own logistic model. In each round both label a pool of unlabelled documents; what one is most
confident of becomes training material of the other. After the rounds each view is calibrated on
labelled rows that were kept out of training, and a combination of both calibrated views, fitted on
the same rows, scores every document.

Fitting reads a bounded sample: at most ``PER_CLASS`` labelled rows of each class and ``POOL``
unlabelled rows, those with the smallest hash of the id; only their feature vectors reach the driver.
Scoring reads every whole text.

Rows: NULL or empty texts have no good sign and are rejected with score 0. A document labelled more
than once counts with its lowest label. NULL metadata is a value of its own. Without labels of both
classes nothing can be learned, and every non-empty document is kept with score 1. Labels of unknown
documents are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import RangeHash, flat_bytes, text_chunks

PER_CLASS = 6_000
POOL = 8_000
ROUNDS = 4
PER_ROUND = 400
CONFIDENT = 3.0  # log-odds of a pseudo-label
META_SLOTS = 32
THRESHOLD = 0.5

LOWER, UPPER, DIGIT, SPACE, PUNCT, HIGH = range(6)
_CLASS = np.full(256, PUNCT, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = LOWER, UPPER, DIGIT, HIGH
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_MARKS = np.frombuffer(b"!|.,;:?-_/<>{}[]()\"'#*=@", np.uint8)


def _share_of_distinct(keys: np.ndarray) -> tuple[float, float]:
    """Distinct values per value, and the share of the most frequent one."""
    if not len(keys):
        return 1.0, 0.0
    _, counts = np.unique(keys, return_counts=True)
    return len(counts) / len(keys), counts.max() / len(keys)


def text_features(column: pa.Array) -> np.ndarray:
    """One row of features a text; only the text is looked at."""
    data, offsets = flat_bytes(column)
    kinds = _CLASS[data]
    hashes = RangeHash(data)
    out = np.zeros((len(column), 14 + len(_MARKS)))
    edge = np.flatnonzero(np.diff((kinds != SPACE).astype(np.int8), prepend=0, append=0))
    breaks = np.flatnonzero(data == 10)
    for i in range(len(column)):
        a, b = int(offsets[i]), int(offsets[i + 1])
        size = b - a
        if not size:
            continue
        classes = np.bincount(kinds[a:b], minlength=6) / size
        mine = np.concatenate([[a], edge[np.searchsorted(edge, a, "right") : np.searchsorted(edge, b, "left")], [b]])
        words = np.stack([mine[:-1], mine[1:]], axis=1)
        words = words[kinds[words[:, 0]] != SPACE]
        lengths = words[:, 1] - words[:, 0]
        distinct, top = _share_of_distinct(hashes(words[:, 0], words[:, 1])) if len(words) else (1.0, 0.0)
        lines = np.concatenate([[a], breaks[np.searchsorted(breaks, a) : np.searchsorted(breaks, b)] + 1, [b]])
        line_distinct, _ = _share_of_distinct(hashes(lines[:-1], np.maximum(lines[1:], lines[:-1])))
        n = max(len(words), 1)
        marks = np.bincount(data[a:b], minlength=256)[_MARKS] / n
        out[i, :14] = [
            *classes,
            np.log1p(size),
            distinct,
            # A long text repeats words anyway: set distinct words against what their root predicts.
            np.log1p(distinct * n) - 0.5 * np.log1p(n),
            top,
            line_distinct,
            lengths.mean() if len(words) else 0.0,
            np.log1p(lengths.max()) if len(words) else 0.0,
            np.log1p(n / len(lines)),
        ]
        out[i, 14:] = np.minimum(marks, 3.0)
    return out


def metadata_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Hashed source and language, and the declared length; the text is not looked at."""
    out = np.zeros((len(source), 2 * META_SLOTS + 3))
    rows = np.arange(len(source))
    for at, column in ((0, source), (META_SLOTS, lang)):
        data, offsets = flat_bytes(pc.fill_null(column.cast(pa.string()), "\0"))
        slots = RangeHash(data)(offsets[:-1], offsets[1:]) % np.uint64(META_SLOTS)
        out[rows, at + slots.astype(np.int64)] = 1.0
    length = pc.fill_null(n_chars.cast(pa.float64()), -1.0).to_numpy(zero_copy_only=False)
    out[:, -3] = length < 0
    out[:, -2] = np.log1p(np.maximum(length, 0))
    out[:, -1] = out[:, -2] ** 2
    return out


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, fitted by Newton steps."""

    ridge: float = 1.0
    mean: np.ndarray = field(default=None)
    scale: np.ndarray = field(default=None)
    weights: np.ndarray = field(default=None)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(self.scale < 1e-9, 1.0, self.scale)
        z = self._z(x)
        # Both classes weigh the same, however rare one is.
        weight = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], self.ridge)
        penalty[-1] = 1e-6
        for _ in range(30):
            p = sigmoid(z @ w)
            gradient = z.T @ (weight * (p - y)) + penalty * w
            curve = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, gradient)
            w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        return self

    def _z(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._z(x) @ self.weights


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    combine: np.ndarray  # slope and intercept of each view's calibration, then the mix of both

    def views(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probability of good quality, by each view."""
        a, b, c, d = self.combine[:4]
        return sigmoid(a * self.text.logit(text) + b), sigmoid(c * self.meta.logit(meta) + d)

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        p, q = (np.clip(v, 1e-9, 1 - 1e-9) for v in self.views(text, meta))
        u, v, w = self.combine[4:]
        return sigmoid(u * np.log(p / (1 - p)) + v * np.log(q / (1 - q)) + w)


def _plain_fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Unweighted logistic fit of a few columns, for calibration: coefficients, then the intercept."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = sigmoid(z @ w)
        curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + 1e-3 * np.eye(z.shape[1])
        step = np.linalg.solve(curve, z.T @ (p - y) + 1e-3 * w)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    return w


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, fold: np.ndarray) -> CoTrained:
    """``fold`` marks the labelled rows that only calibrate."""
    fit = ~fold
    sets = {  # each view's own training set
        "text": (text[fit], y[fit]),
        "meta": (meta[fit], y[fit]),
    }
    held = fold if fold.any() and 0 < y[fold].mean() < 1 else np.ones(len(y), bool)

    def confidence(model: Logistic, labelled: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Calibrated on rows kept out of training, so that a view without a clue is never confident."""
        slope, intercept = _plain_fit(model.logit(labelled[held])[:, None], y[held])
        return slope * model.logit(x) + intercept

    left = np.arange(len(pool_text))
    by_text, by_meta = Logistic().fit(*sets["text"]), Logistic().fit(*sets["meta"])
    for _ in range(ROUNDS):
        if not len(left):
            break
        taken: set[int] = set()
        for sure, pupil, shown in (
            (confidence(by_text, text, pool_text[left]), "meta", pool_meta),
            (confidence(by_meta, meta, pool_meta[left]), "text", pool_text),
        ):
            order = np.argsort(sure, kind="stable")
            good = [i for i in order[::-1][:PER_ROUND] if sure[i] > CONFIDENT]
            bad = [i for i in order[:PER_ROUND] if sure[i] < -CONFIDENT]
            chosen = np.array(good + bad, np.int64)
            if len(chosen):
                x, labels = sets[pupil]
                sets[pupil] = (
                    np.concatenate([x, shown[left[chosen]]]),
                    np.concatenate([labels, np.repeat([1.0, 0.0], [len(good), len(bad)])]),
                )
                taken.update(chosen.tolist())
        by_text, by_meta = Logistic().fit(*sets["text"]), Logistic().fit(*sets["meta"])
        left = np.delete(left, sorted(taken))
    a, b = _plain_fit(by_text.logit(text[held])[:, None], y[held])
    c, d = _plain_fit(by_meta.logit(meta[held])[:, None], y[held])
    mixed = np.stack([a * by_text.logit(text[held]) + b, c * by_meta.logit(meta[held]) + d], axis=1)
    return CoTrained(by_text, by_meta, np.array([a, b, c, d, *_plain_fit(mixed, y[held])]))


FEATURES = "doc_id long, x array<double>, z array<double>"


def _inputs(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("double").alias("n_chars"),
        *more,
    )


def _features_of(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            x = text_features(part.column("text"))
            z = metadata_features(part.column("source"), part.column("lang"), part.column("n_chars"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(list(x), pa.list_(pa.float64())), pa.array(list(z), pa.list_(pa.float64()))],
                names=["doc_id", "x", "z"],
            )

    return docs.mapInArrow(run, FEATURES)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, pool: int = POOL) -> CoTrained | None:
    """Trains on a bounded sample; None when the labels hold fewer than two classes."""
    known = labels.filter("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("_h", F.xxhash64("doc_id"))
    rows = _inputs(docs)
    # Labels of unknown documents must not use up the sample, and ids come before texts: no text is shuffled.
    ids = rows.filter("doc_id is not null").select("doc_id").distinct()
    known = known.join(ids, "doc_id", "left_semi")
    samples = [known.filter(F.col("quality") == q).orderBy("_h", "doc_id").limit(per_class) for q in (0, 1)]
    chosen = samples[0].unionByName(samples[1]).select("doc_id", "quality")
    free = ids.join(known.select("doc_id"), "doc_id", "left_anti").withColumn("_h", F.xxhash64("doc_id"))
    free = free.orderBy("_h", "doc_id").limit(pool).select("doc_id", F.lit(None).cast("int").alias("quality"))
    wanted = {r["doc_id"]: r["quality"] for r in chosen.unionByName(free).collect()}  # at most 2 x per_class + pool
    if {q for q in wanted.values() if q is not None} != {0, 1}:
        return None
    spark = docs.sparkSession
    picked = spark.createDataFrame([(d,) for d in wanted], "doc_id long")
    sample = _features_of(rows.join(F.broadcast(picked), "doc_id")).dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    label = np.array([-1 if wanted[r["doc_id"]] is None else wanted[r["doc_id"]] for r in sample], np.float64)
    x, z = np.array([r["x"] for r in sample]), np.array([r["z"] for r in sample])
    known_rows = label >= 0
    fold = np.arange(known_rows.sum()) % 4 == 0
    return co_train(x[known_rows], z[known_rows], label[known_rows], x[~known_rows], z[~known_rows], fold)


def score(docs: DataFrame, model: CoTrained | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, text_score, meta_score, keep) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            s, p, q = _judge(model, part)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(s), pa.array(p), pa.array(q), pa.array(s >= threshold)],
                names=["doc_id", "score", "text_score", "meta_score", "keep"],
            )

    return _inputs(docs).mapInArrow(run, "doc_id long, score double, text_score double, meta_score double, keep boolean")


def _judge(model: CoTrained | None, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some = pc.fill_null(pc.greater(pc.binary_length(part.column("text")), 0), False).to_numpy(zero_copy_only=False)
    if model is None:
        return some.astype(float), some.astype(float), some.astype(float)
    x = text_features(part.column("text"))
    z = metadata_features(part.column("source"), part.column("lang"), part.column("n_chars"))
    p, q = model.views(x, z)
    return np.where(some, model.score(x, z), 0.0), np.where(some, p, 0.0), q


def keep_good(docs: DataFrame, model: CoTrained | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns kept."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_chunks(batches, "text"):
            seen = pa.RecordBatch.from_arrays(
                [
                    part.column("text"),
                    part.column("source").cast(pa.string()),
                    part.column("lang").cast(pa.string()),
                    part.column("n_chars").cast(pa.float64()),
                ],
                names=["text", "source", "lang", "n_chars"],
            )
            yield part.filter(pa.array(_judge(model, seen)[0] >= threshold)).select(names)

    return docs.mapInArrow(run, docs.schema)
