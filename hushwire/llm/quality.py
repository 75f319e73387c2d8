"""Quality classifier by positive-unlabelled learning.

Trusted positives are the labelled-good documents of the learning folds; the unlabelled web text is a
share of all documents of those folds.  A linear scorer over the whole text's byte-class statistics
minimises the non-negative unbiased risk  pi * R_p+ + max(0, R_u- - pi * R_p-)  under logistic loss.  The class
prior pi is estimated from positives and unlabelled rows alone, by comparing their mean scores under a
positive-against-unlabelled scorer.  Labels of bad documents are never read.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.llm.common import map_arrow, share, table, text_fold

#: Bound of the sample of trusted positives and of the unlabelled sample, in expectation.
SAMPLE = 12_000
HOLD_OUT = 5
THRESHOLD = 0.3

#: Byte classes: one list of bytes each; bytes not listed are class 0.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t\x0b\x0c", b".", b",;:", b"!?", b"\"'`", b"|", b"()[]{}<>", b"#$%&*@^~=+", b"-_/\\", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))]
N = len(CLASSES) + 1
EXTRA = 8
WIDTH = N * N + EXTRA
BYTE_CLASS = np.zeros(256, np.uint16)
for _i, _c in enumerate(CLASSES):
    BYTE_CLASS[list(_c)] = _i + 1


def features(text: str | None) -> np.ndarray:
    """Of a whole text: rates of byte-class pairs (as roots), and length, word and repetition figures."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(WIDTH, np.float32)
    if not raw:
        return out
    c = BYTE_CLASS[np.frombuffer(raw, np.uint8)]
    pairs = np.bincount(c[:-1] * np.uint16(N) + c[1:], minlength=N * N)
    out[: N * N] = np.sqrt(pairs / max(1, len(raw) - 1))
    words = raw.split()
    lines = raw.split(b"\n")
    n = max(1, len(words))
    out[N * N :] = (
        np.log1p(len(words)) / 5,
        len(set(words)) / n,
        len(set(map(bytes.lower, words))) / n,
        len(raw) / n / 10,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)) / 5,
        min(1.0, 4 * sum(map(eq, words, words[1:])) / n),
        sum(map(eq, words, words[1:])) / n,
    )
    return out


class Model:
    def __init__(self, mean, scale, weights, bias, prior):
        self.mean, self.scale, self.weights, self.bias, self.prior = mean, scale, weights, bias, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _softplus(z):
    return np.logaddexp(0, z)


def fit(pos: np.ndarray, unl: np.ndarray, prior: float, rounds: int = 600, rate: float = 0.03, decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk by Adam on whole-sample gradients; where the negative part falls
    below zero, its gradient is reversed (the risk estimator's own correction)."""
    mean, scale = unl.mean(0), unl.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (pos, unl))
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        gap = _softplus(zu).mean() - prior * _softplus(zp).mean()
        g_neg = np.append(u.T @ su / len(u) - prior * (p.T @ sp) / len(p), su.mean() - prior * sp.mean())
        if gap >= 0:
            g_pos = np.append(p.T @ (sp - 1) / len(p), (sp - 1).mean())
            g = prior * g_pos + g_neg
        else:
            g = -g_neg
        g[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, b, prior)


def mixture_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Prior from a positive-against-unlabelled scorer g: mean of g over unlabelled / over positives odds."""
    model = fit(pos, np.concatenate([unl, pos]), len(pos) / (len(pos) + len(unl)), rounds=200)
    g, h = model.score(pos).mean(), model.score(unl).mean()
    return float(np.clip(h / max(g, 1e-6), 0.05, 0.95))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on a bounded sample; None where there is no trusted positive.  Labels are read only from the
    learning folds; of several labels of one document any good one counts."""
    spark = docs.sparkSession
    known = labels.where((text_fold("doc_id", HOLD_OUT) != 0) & (F.col("quality") == 1)).select("doc_id").distinct()
    good, total = known.count(), docs.count()
    if not good or not total:
        return None
    trusted = known.where(share("doc_id", 11, sample / good))
    # bounded by `sample` rows in expectation, whatever the size of the tables
    ids = [r[0] for r in trusted.collect()]
    small = spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("pos", F.lit(True))
    picked = (
        docs.select("doc_id", "text")
        .where(text_fold("doc_id", HOLD_OUT) != 0)
        .join(F.broadcast(small), "doc_id", "left")
        .withColumn("unl", share("doc_id", 12, sample / total))
        .where(F.col("pos") | F.col("unl"))
        .select(F.coalesce("pos", F.lit(False)).alias("pos"), "unl", "text")
    )

    def make():
        def run(c):
            f = [features(t).tobytes() for t in c["text"].to_pylist()]
            return {"pos": c["pos"], "unl": c["unl"], "f": f}

        return run

    rows = map_arrow(picked, make, "pos boolean, unl boolean, f binary", "text").toArrow()
    x = np.frombuffer(b"".join(rows["f"].to_pylist()), np.float32).reshape(-1, WIDTH)
    p, u = (rows[k].to_numpy().astype(bool) for k in ("pos", "unl"))
    if not p.any() or not u.any():
        return None
    return fit(x[p], x[u], mixture_prior(x[p], x[u]))


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """A score for every row from its text alone (null counts as empty).  Empty texts get the score of
    the zero vector; without a model every score is 0.5.  Repeated rows are each scored; an empty table gives
    an empty result; extra columns are ignored; long texts are read whole."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (text_fold("doc_id", HOLD_OUT) == 0).alias("held_out"), "text")

    def make():
        def run(c):
            texts = c["text"].to_pylist()
            x = np.stack([features(t) for t in texts])
            s = model.score(x) if model is not None else np.full(len(texts), 0.5)
            return {"doc_id": c["doc_id"], "held_out": c["held_out"], "score": s, "predicted": (s >= THRESHOLD).astype(np.int32)}

        return run

    return map_arrow(rows, make, SCHEMA, "text")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; see score_quality for nulls, repeats and empty tables."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, learn(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, all columns, whose score reaches the threshold; all rows without a model.  Null
    texts count as empty ones, whose score decides; repeated rows stay or go together; an empty table gives
    an empty result; extra columns keep their names and values."""
    if model is None:
        return docs

    def make():
        def run(c):
            x = np.stack([features(t) for t in c["text"].to_pylist()])
            good = np.flatnonzero(model.score(x) >= THRESHOLD)
            return {k: v.take(good) for k, v in c.items()}

        return run

    return map_arrow(docs, make, docs.schema, "text")
