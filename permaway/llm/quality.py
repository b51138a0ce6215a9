"""Quality classifier by positive-unlabelled learning with a non-negative risk."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.llm.batches import text_batches

#: Training rows of a kind, drawn by hash; the one bound on what the driver holds.
SAMPLE = 20_000
N_FEATURES = 24

#: 0 space and line ends, 1 a-z, 2 A-Z, 3 digits, 4 .,;:'"()- marks of prose, 5 ! and ?, 6 other ASCII marks, 7 bytes of other characters.
KIND = np.full(256, 7, np.int64)
KIND[:128] = 6
KIND[[32, *range(9, 14)]] = 0
KIND[97:123], KIND[65:91], KIND[48:58] = 1, 2, 3
KIND[[ord(c) for c in ".,;:'\"()-"]], KIND[[33, 63]] = 4, 5


def text_features(text: bytes | None) -> np.ndarray:
    """Shape of a whole text: shares of character kinds, word statistics and repetition.

    Null and empty texts give zeros but for the last feature, which says so."""
    x = np.zeros(N_FEATURES)
    words = (text or b"").split()
    if not words:
        x[-1] = 1
        return x
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(KIND, weights=count, minlength=8)
    solid = len(text) - kinds[0]
    letters = max(kinds[1] + kinds[2] + kinds[7], 1.0)
    x[:6] = kinds[1] / solid, kinds[2] / solid, kinds[3] / solid, kinds[4] / solid, kinds[5] / solid, kinds[6] / solid
    x[6], x[7] = kinds[2] / letters, kinds[7] / solid
    p = count[count > 0] / len(text)
    x[8] = -(p * np.log2(p)).sum() / 5
    n = len(words)
    unique = set(words)
    x[9] = np.log1p(n) / 8
    x[10] = solid / n / 8
    x[11] = len(unique) / n
    x[12] = len(unique) / n**0.8
    lines = text.split(b"\n")
    x[13] = len(set(lines)) / len(lines)
    x[14] = np.log1p(len(lines)) / 6
    x[15] = np.log1p(n / len(lines)) / 6
    pairs = set(zip(words, words[1:], strict=False))
    x[16] = len(pairs) / max(1, n - 1)
    x[17] = len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n - 2)
    x[18] = sum(w[-1] < 48 and w[-1] not in b".,;:'\")-" for w in unique) / len(unique)
    x[19] = max(map(len, unique)) > 40
    x[20] = text.count(b"http") / n
    x[21] = min(text.count(b"{") + text.count(b"<") + text.count(b"|"), n) / n
    x[22] = sum(text.count(m) for m in (b"!!", b"??", b"...", b"***")) / n
    return x


def fold_of(key) -> F.Column:
    """crc32 of the id as text, as a number; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


class Scorer:
    """One hidden layer over scaled features; weights are plain arrays."""

    def __init__(self, mean, scale, w1, b1, w2, b2):
        self.parts = mean, scale, w1, b1, w2, b2

    def logits(self, x: np.ndarray) -> np.ndarray:
        mean, scale, w1, b1, w2, b2 = self.parts
        return np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def nn_pu_fit(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 12, steps: int = 1500, batch: int = 1024, seed: int = 7) -> Scorer:
    """Minimise prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]) by Adam.

    l is the logistic loss. Where the second term is negative the step climbs out of it
    (its gradient is taken with the sign turned), as the non-negative estimator asks."""
    rng = np.random.default_rng(seed)
    both = np.vstack([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    d = both.shape[1]
    theta = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        p = (pos[rng.integers(0, len(pos), min(batch, len(pos)))] - mean) / scale
        u = (unl[rng.integers(0, len(unl), min(batch, len(unl)))] - mean) / scale
        x = np.vstack([p, u])
        h = np.tanh(x @ theta[0] + theta[1])
        z = h @ theta[2] + theta[3]
        zp, zu = z[: len(p)], z[len(p) :]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gz = np.zeros_like(z)
        if negative >= 0:
            gz[: len(p)] = prior * (sig(zp) - 1 - sig(zp)) / len(p)
            gz[len(p) :] = sig(zu) / len(u)
        else:
            gz[: len(p)] = prior * sig(zp) / len(p)
            gz[len(p) :] = -sig(zu) / len(u)
        gh = np.outer(gz, theta[2]) * (1 - h * h)
        grads = [x.T @ gh + 1e-4 * theta[0], gh.sum(0), h.T @ gz + 1e-4 * theta[2], gz.sum(keepdims=True)]
        rate = 0.01 * (1 - 0.9 * step / steps)
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            theta[i] = theta[i] - rate * m[i] / (1 - 0.9**step) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Scorer(mean, scale, *theta)


def train_quality(docs: DataFrame, labels: DataFrame, fold: int = 3, held: int = 1, sample: int = SAMPLE) -> Scorer:
    """Fit on trusted positives (label 1) and on unlabelled text, both of training ids only.

    The class prior is the share of label 1 among the training labels, counted over all
    of them. Of each kind at most about `sample` rows, those with the smallest hashes of
    the id, are featurised. Labels of several rows of one id: any 1 makes it positive.
    """
    kept = F.pmod(fold_of(F.col("doc_id")), F.lit(fold)) != held
    lab = labels.where(kept & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    total, good = lab.agg(F.count("*"), F.sum((F.col("_quality") == 1).cast("int"))).first()
    prior = min(max((good or 0) / total, 0.02), 0.98) if total else 0.5
    text = docs.where(kept & F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = text.select("doc_id").count()

    def drawn(df: DataFrame, n: int, salt: str) -> np.ndarray:
        share = sample / max(n, 1)
        if share < 1:
            df = df.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 20)) < int(share * (1 << 20)))
        got = featurised(df.select("doc_id", "text"), None).select("x").toPandas().x
        return np.array(got.tolist()).reshape(-1, N_FEATURES)

    positives = text.join(lab.where("_quality = 1").select("doc_id"), "doc_id", "left_semi")
    pos = drawn(positives, good or 0, "p")
    unl = drawn(text, rows, "u")
    if len(pos) == 0 or len(unl) == 0:
        zero = np.zeros(N_FEATURES)
        level = np.log(prior / (1 - prior))
        return Scorer(zero, zero + 1, np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), np.array([level]))
    return nn_pu_fit(pos, unl, prior)


def featurised(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """(doc_id, x) or, with a scorer, (doc_id, score): a narrow pass over whole texts."""
    docs = text_batches(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = None if scorer is None else scorer.parts

    def run(batches):
        model = None if parts is None else Scorer(*parts)
        for batch in batches:
            x = np.array([text_features(t.as_py()) for t in batch.column(1)]).reshape(-1, N_FEATURES)
            if model is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, " + ("x array<double>" if scorer is None else "score double"))


def score_quality(docs: DataFrame, labels: DataFrame, fold: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts are scored too."""
    scored = featurised(docs, train_quality(docs, labels, fold, held))
    return scored.select("doc_id", (F.pmod(fold_of(F.col("doc_id")), F.lit(fold)) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def fold_number(doc_id, fold: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % fold


def op2_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
