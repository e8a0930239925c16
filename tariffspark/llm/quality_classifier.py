"""Quality by compression: one zstandard dictionary of good and one of bad labelled text.

A text is compressed with either in blocks of BLOCK bytes, so that the dictionaries matter in long texts as
in short ones; the difference of the summed sizes, divided by the text's bytes, goes through a fitted
sigmoid. The dictionaries come from one half of the sampled labelled texts, the sigmoid from the other,
weighted by the labels' frequencies. Samples are at most `limit` texts of each label. Null and empty texts
get the score of difference 0 (compressed alike by both). Without labelled rows of both kinds every text scores 0.5. Repeated rows score
alike; labels and further columns are never inputs of a score. Texts of any length are compressed whole, a block at a
time. A score of exactly the bar counts as label 1. Labelled texts over a million characters are not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_texts, text_slices, typed
from .labelled import sample

LIMIT = 2000
DICTIONARY_BYTES = 112_640
LEVEL = 3
BLOCK = 1000


def dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of too little text, the text itself."""
    raw = [t.encode() for t in texts if t]
    try:
        return zstandard.train_dictionary(size, raw).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(raw)[:size]


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(raw)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)


def differences(texts: list[str], good: bytes, bad: bytes) -> np.ndarray:
    a, b = _compressor(good), _compressor(bad)
    raw = [t.encode() for t in texts]
    size = lambda c, x: sum([len(c.compress(x[k : k + BLOCK])) for k in range(0, len(x), BLOCK)])
    return np.array([(size(b, x) - size(a, x)) / max(len(x), 1) for x in raw])


def sigmoid_fit(x: np.ndarray, y: np.ndarray, prior: float = 0.5, rounds: int = 50) -> tuple[float, float, float]:
    """(centre, slope, intercept) of a logistic curve by Newton steps; label 1 has the weight `prior` in all."""
    centre, spread = float(np.median(x)), float(x.std()) or 1.0
    z = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    weight = np.where(y == 1, prior / max(y.sum(), 1), (1 - prior) / max((1 - y).sum(), 1))
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + 1e-4 * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(2)
        w -= np.linalg.solve(curve, slope)
    return centre, float(w[0] / spread), float(w[1])


def score(docs: DataFrame, good: list[str], bad: list[str], prior: float = 0.5, threshold: float = 0.7, key: str = "doc_id") -> DataFrame:
    """(key, score, predicted) for each row of docs(key, text)."""
    if good and bad:
        ga, gb = dictionary(good[::2]), dictionary(bad[::2])
        fit = good[1::2] or good, bad[1::2] or bad
        x = differences([*fit[0], *fit[1]], ga, gb)
        y = np.repeat([1.0, 0.0], [len(fit[0]), len(fit[1])])
        centre, slope, intercept = sigmoid_fit(x, y, prior)
        slope = max(slope, 0.0)  # a higher difference never speaks against a text
    else:
        ga = gb = b"\x00" * 8
        centre = slope = intercept = 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                x = differences(texts, ga, gb)
                p = 1 / (1 + np.exp(-np.clip(slope * (x - centre) + intercept, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p)], names=[key, "score"])

    scored = document_texts(docs, key).mapInArrow(run, typed(docs, key, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, threshold: float = 0.7, key: str = "doc_id") -> DataFrame:
    """(key, held_out, score, predicted); rows whose crc32(key) mod 4 is 2 are held out of the fitting."""
    held_out = F.crc32(F.col(key).cast("string")) % 4 == 2
    good, bad = (sample(docs, labels, "quality", v, limit, ~held_out, key) for v in (1, 0))
    known = labels.where(~held_out).agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    return score(docs, good, bad, 0.5 if known is None else min(max(known, 0.01), 0.99), threshold, key).select(key, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")
