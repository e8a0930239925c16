"""Toxicity by a classifier chain.

Labels say only whether a text is toxic, so the categories are found: toxic texts are parted by the
toxic vocabulary they share (k-means over the selected features), one category a part; the chain's last
link is toxicity as a whole. Link j is a linear model over the features and the probabilities of links
0..j-1. In fitting, these earlier probabilities are out of fold: a fold's rows are scored by links whose
vocabulary, categories and weights all come from the other folds alone. A fold's categories take the numbers
of the final ones that they share most training texts with.

Features: presence of a word, and of its first 4 to 8 bytes; those are kept that are far more frequent in
toxic texts, the `most_features` that tell most apart. Either label has half the weight in a fit. Fitted on at
most `limit` texts of either label. Null and empty texts have no feature and are clean; without toxic or
without clean labelled rows nothing is toxic. Repeated rows score alike; very long texts are read whole, and a
word however long is one feature. Columns other than the key and text are not read.
Ties between features go to the one of the lesser hash; a probability of exactly the bar counts as toxic. Labelled texts
over a million characters are not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_texts, sliced, text_slices, typed
from .labelled import sample
from .wordarrays import Words, mix64

LIMIT = 3000
CATEGORIES = 3
FOLDS = 3
MOST_FEATURES = 4096
LEAST_TEXTS = 4
#: Bytes of a word's beginnings that are features.
PREFIXES = (4, 5, 6, 7, 8)
LOG_ODDS = 2.5


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of each distinct feature of each text."""
    words = Words(texts, lower=True, bare=True)
    docs, value = [words.doc], [mix64(words.hashes())]
    for k in PREFIXES:
        long = words.length > k
        docs.append(words.doc[long])
        value.append(mix64(words.hashes(k) + np.uint64(k))[long])
    docs, value = np.concatenate(docs), np.concatenate(value)
    order = np.lexsort((value, docs))
    docs, value = docs[order], value[order]
    fresh = np.append(True, (docs[1:] != docs[:-1]) | (value[1:] != value[:-1])) if len(docs) else np.zeros(0, bool)
    return docs[fresh], value[fresh]


def _candidates(toxic: list[str], clean: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, docs, cols): sorted hashes of the features of LEAST_TEXTS toxic texts or more, and which text has which of them.

    Texts are taken in slices; rarer features, most of all, are never held together.
    """
    own = [features(toxic[a:b])[1] for a, b in sliced(toxic)]
    known = []
    for part in range(16):  # sorting a part at a time takes a fraction of the memory
        value, times = np.unique(np.concatenate([v[v >> np.uint64(60) == part] for v in own]), return_counts=True)
        known.append(value[times >= LEAST_TEXTS])
    known = np.concatenate(known)
    del own
    docs, cols = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    texts = [*toxic, *clean]
    for a, b in sliced(texts):
        d, at = _select(*features(texts[a:b]), known)
        docs.append((a + d).astype(np.int32))
        cols.append(at.astype(np.int32))
    return known, np.concatenate(docs), np.concatenate(cols)


def _logistic(rows: np.ndarray, cols: np.ndarray, n: int, width: int, extra: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of features, then of extra columns, then the intercept: accelerated gradient steps with a ridge."""
    w, velocity = np.zeros(width + extra.shape[1] + 1), np.zeros(width + extra.shape[1] + 1)
    weight = np.where(y > 0.5, 0.5 / max(y.sum(), 1), 0.5 / max(n - y.sum(), 1))
    per_row = max(1.0, np.bincount(rows, minlength=n).mean() + extra.shape[1] + 1)
    rate = 4.0 / per_row
    for k in range(rounds):
        at = w + 0.9 * velocity
        p = _probability(rows, cols, n, at, width, extra)
        off = (p - y) * weight
        slope = np.concatenate([np.bincount(cols, off[rows], width), extra.T @ off, [off.sum()]])
        slope[:-1] += 1e-4 * at[:-1]
        velocity = 0.9 * velocity - rate * slope
        w = w + velocity
    return w


def _probability(rows: np.ndarray, cols: np.ndarray, n: int, w: np.ndarray, width: int, extra: np.ndarray) -> np.ndarray:
    z = np.bincount(rows, w[cols], n) + extra @ w[width:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    """vocabulary: sorted hashes; links: one weight vector a link, the last for toxicity as a whole."""

    vocabulary: np.ndarray
    links: list[np.ndarray]

    def predict(self, texts: list[str]) -> np.ndarray:
        n, width = len(texts), len(self.vocabulary)
        rows, cols = _select(*features(texts), self.vocabulary)
        seen = np.zeros((n, 0))
        for w in self.links:
            seen = np.column_stack([seen, _probability(rows, cols, n, w, width, seen)])
        return seen


def _select(docs: np.ndarray, values: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
    hit = vocabulary[at] == values
    return docs[hit], at[hit]


def _parts(rows: np.ndarray, cols: np.ndarray, members: np.ndarray, width: int, k: int) -> np.ndarray:
    """k-means by cosine over the members' features; starts are the member with most features, then the farthest each."""
    x = np.zeros((len(members), width), np.float32)
    place = np.full(int(members.max()) + 1, -1)
    place[members] = np.arange(len(members))
    inside = (rows <= members.max()) & (place[np.minimum(rows, members.max())] >= 0)
    x[place[rows[inside]], cols[inside]] = 1
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1)
    centres = x[[int((x > 0).sum(axis=1).argmax())]]
    while len(centres) < k:
        centres = np.vstack([centres, x[(x @ centres.T).max(axis=1).argmin()]])
    for _ in range(20):
        own = (x @ centres.T).argmax(axis=1)
        centres = np.vstack([x[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(k)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return own


def _telling(docs: np.ndarray, cols: np.ndarray, width: int, toxic: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """The columns, in order, that part the toxic from the clean ones of the rows (flags, as toxic)."""
    seen = lambda flag: np.bincount(cols[(rows & flag)[docs]], minlength=width)
    n_bad, n_good = seen(toxic), seen(~toxic)
    odds = np.log((n_bad + 0.5) / ((toxic & rows).sum() + 1)) - np.log((n_good + 0.5) / ((~toxic & rows).sum() + 1))
    good = np.flatnonzero((n_bad >= LEAST_TEXTS) & (odds >= LOG_ODDS))
    return np.sort(good[np.argsort(-odds[good] * np.sqrt(n_bad[good]), kind="stable")][:most])


def _among(docs: np.ndarray, cols: np.ndarray, width: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose column is chosen, with its place among the chosen."""
    place = np.full(width, -1)
    place[chosen] = np.arange(len(chosen))
    hit = place[cols] >= 0
    return docs[hit].astype(np.int64), place[cols[hit]]


def _link(rows: np.ndarray, cols: np.ndarray, width: int, y: np.ndarray, own: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Weights of one link, fitted on the rows `own` (places) with the earlier probabilities `held` of all rows."""
    inside = np.isin(rows, own)
    return _logistic(np.searchsorted(own, rows[inside]), cols[inside], len(own), width, held[own], y[own])


def _categories(rows: np.ndarray, cols: np.ndarray, width: int, toxic: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The category of each toxic one of the rows among; -1 elsewhere."""
    out = np.full(len(toxic), -1)
    members = np.flatnonzero(toxic & among)
    if len(members) and width:
        out[members] = _parts(rows, cols, members, width, min(k, len(members)))
    return out


def _renamed(own: np.ndarray, final: np.ndarray, k: int) -> np.ndarray:
    """own with its categories numbered as those of final that they share most texts with, the largest overlap first."""
    known = own >= 0
    overlap = np.bincount(own[known] * k + final[known], minlength=k * k).reshape(k, k).astype(float)
    name = np.zeros(k, int)
    for _ in range(k):
        i, j = np.unravel_index(overlap.argmax(), overlap.shape)
        name[i] = j
        overlap[i, :], overlap[:, j] = -1, -1
    return np.where(known, name[own], -1)


def fit(toxic: list[str], clean: list[str], categories: int = CATEGORIES, folds: int = FOLDS, most_features: int = MOST_FEATURES) -> Chain:
    n = len(toxic) + len(clean)
    if not toxic or not clean:
        return Chain(np.zeros(0, np.uint64), [np.append(np.zeros(j), -30.0) for j in range(categories + 1)])
    known, docs, cols = _candidates(toxic, clean)
    bad, fold = np.arange(n) < len(toxic), np.arange(n) % folds

    def learn(among: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(columns, and the pairs in them, categories) from the rows among alone."""
        chosen = _telling(docs, cols, len(known), bad, among, most_features)
        own = _among(docs, cols, len(known), chosen)
        return chosen, *own, _categories(*own, len(chosen), bad, among, categories)

    chosen, rows, places, final = learn(np.ones(n, bool))
    inner = [learn(fold != f) for f in range(folds)]
    target = lambda of, j: (bad if j == categories else of == j).astype(float)
    links, held = [], np.zeros((n, 0))
    for j in range(categories + 1):
        out = np.zeros(n)
        for f, (words, r, c, of) in enumerate(inner):
            own, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            w = _link(r, c, len(words), target(_renamed(of, final, categories), j), own, held)
            there = fold[r] == f
            out[rest] = _probability(np.searchsorted(rest, r[there]), c[there], len(rest), w, len(words), held[rest])
        links.append(_link(rows, places, len(chosen), target(final, j), np.arange(n), held))
        held = np.column_stack([held, out])
    return Chain(known[chosen], links)


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """(key, p_category_1.., p_toxic, toxic) for each row of docs(key, text)."""
    names = [*(f"p_category_{j + 1}" for j in range(len(chain.links) - 1)), "p_toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                p = chain.predict(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *[pa.array(p[:, j]) for j in range(p.shape[1])]], names=[key, *names])

    return document_texts(docs, key).mapInArrow(run, typed(docs, key, ", ".join(f"{c} double" for c in names))).withColumn("toxic", F.col("p_toxic") >= threshold)


def learned(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, key: str = "doc_id") -> Chain:
    """The chain fitted on the labelled documents among docs."""
    return fit(*(sample(docs, labels, "toxic", v, limit, None, key) for v in (1, 0)))


def classify(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    return score(docs, learned(docs, labels, limit, key), threshold, key)
