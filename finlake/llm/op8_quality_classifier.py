"""Compression classifier: which dictionary compresses a text better, good or bad?

Two zstandard dictionaries are trained, one on text labelled good and one on
text labelled bad. A text is compressed with either; the difference of the
two sizes over the text's size, with the better size over the text's size, go
through a logistic curve fitted on labelled rows that the dictionaries have
not seen. Its value is the score, the probability of label 1.

The fit uses a bounded sample: for each label, the ``SAMPLE`` labelled rows
with the smallest hash of their id, at most the first ``SAMPLE_CHARS`` characters of
each (half for the dictionaries, half for the curve). Every text is scored
whole. Labels are learnt from rows whose ``crc32(doc_id as text) mod 5`` is
not 0 only.

Defined results: a NULL or empty text gets the curve's value at no difference;
without both labels every score is the share of label 1 (1/2 without any); if
an id has several labels, the smallest counts; a NULL ``doc_id`` is never
learnt from, and is not held out; of several texts of one id the smallest is learnt from; repeated rows give repeated results; only
``doc_id`` and ``text`` are read, and ``quality`` of the labels; an empty table
gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import by_batch

SAMPLE = 1500
SAMPLE_CHARS = 50_000
DICT_BYTES = 64 * 1024
LEVEL = 1
FOLDS = 5


def fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, quality of the rows that may be learnt from."""
    usable = F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0)
    return labels.where(usable).groupBy("doc_id").agg(F.min("quality").alias("quality"))


def training_rows(docs: DataFrame, labels: DataFrame) -> list[tuple[int, int, str]]:
    """(quality, half, text) of the bounded sample."""
    known = known_labels(labels).withColumn("at", F.xxhash64("doc_id"))
    texts = docs.select("doc_id", "text").where(F.length("text") > 0)
    rows: list[tuple[int, int, str]] = []
    for quality in (0, 1):
        picked = known.where(F.col("quality") == quality).orderBy("at", "doc_id").limit(SAMPLE)
        joined = texts.join(F.broadcast(picked), "doc_id")  # at most SAMPLE rows
        part = F.substring("text", 1, SAMPLE_CHARS).alias("text")
        found = joined.select("quality", F.pmod("at", F.lit(2)).alias("half"), part, "at", "doc_id")
        found = found.groupBy("quality", "half", "at", "doc_id").agg(F.min("text").alias("text")).collect()
        rows += [(r.quality, int(r.half), r.text) for r in sorted(found, key=lambda r: (r["at"], r.doc_id))]
    return rows


def dictionary(texts: list[str]) -> bytes:
    """A zstandard dictionary of the texts, an eighth of their size at most (a larger one
    would hold what is special to a text); their own bytes where there are too few to train on."""
    raw = [t.encode() for t in texts]
    pieces = [r[i : i + 2048] for r in raw for i in range(0, len(r), 2048)]
    size = min(DICT_BYTES, max(4096, sum(map(len, raw)) // 8))
    try:
        return zstandard.train_dictionary(size, pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(raw)[-DICT_BYTES:]


def compressor(data: bytes) -> zstandard.ZstdCompressor:
    kept = zstandard.ZstdCompressionDict(data)
    kept.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=kept, write_content_size=False, write_dict_id=False)


def features(texts: list[str], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """Per text: the normalised difference, the better rate, and their products."""
    rows = []
    for text in texts:
        raw = text.encode()
        n = max(1, len(raw))
        g, b = (len(c.compress(raw)) if raw else 0 for c in (good, bad))
        rows.append(((b - g) / n, min(g, b) / n if raw else 0.0, 1 / (1 + n / 200)))
    d, r, s = np.array(rows, float).reshape(-1, 3).T
    return np.stack([np.ones_like(d), d, r, s, d * r, r * r, d * d, d * s, r * s], 1)


def fit(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton's method, on centred and scaled columns."""
    w = np.zeros(x.shape[1])
    ridge = max(1e-3, 0.3 / len(y))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * len(y) * np.r_[0, w[1:]]
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """What scoring needs: two dictionaries and the curve, or a constant."""
    rows = training_rows(docs, labels)
    if len({q for q, _, _ in rows}) < 2:
        return {"constant": 0.5}  # nothing to tell good from bad by
    parts = {(q, h): [t for a, b, t in rows if (a, b) == (q, h)] for q in (0, 1) for h in (0, 1)}
    good, bad = (dictionary(parts[q, 0] or parts[q, 1]) for q in (1, 0))
    seen = [(q, t) for q in (0, 1) for t in parts[q, 1] or parts[q, 0]]
    x = features([t for _, t in seen], compressor(good), compressor(bad))
    y = np.array([q for q, _ in seen], float)
    middle, scale = x.mean(0), x.std(0) + 1e-9
    middle[0], scale[0] = 0.0, 1.0
    weights = fit((x - middle) / scale, y)
    # the sample holds the labels in other shares than all labelled rows do
    n = {r.quality: r["count"] for r in known_labels(labels).groupBy("quality").count().collect()}
    weights[0] += np.log(n[1] / n[0]) - np.log(y.sum() / (len(y) - y.sum()))
    # texts unlike any seen are taken as the most extreme one seen
    curve = {"middle": middle, "scale": scale, "weights": weights, "least": x.min(0), "most": x.max(0)}
    return {"good": good, "bad": bad} | curve


def curve(model: dict, x: np.ndarray) -> np.ndarray:
    x = np.clip(x, model["least"], model["most"])
    z = ((x - model["middle"]) / model["scale"]) @ model["weights"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def text_scores(model: dict, batch: pa.RecordBatch) -> np.ndarray:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    return curve(model, features(texts, compressor(model["good"]), compressor(model["bad"])))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if the score reaches ``threshold``)."""
    model = train(docs, labels)
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        score = pa.array(text_scores(model, batch))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], ["doc_id", "score"])

    scored = by_batch(docs.select("doc_id", "text"), work, f"doc_id {key}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``; all of them where the labels train no classifier."""
    model = train(docs, labels)
    if "constant" in model:
        return docs

    def work(batch: pa.RecordBatch):
        yield batch.filter(pa.array(text_scores(model, batch) >= threshold))

    return by_batch(docs, work, docs.schema)
