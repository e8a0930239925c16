"""Quality rules and line labels: a linear-chain conditional random field marks content or boilerplate.

Fixed rules count words, symbols, repeated lines and repeated three-word windows. The field labels the
lines of a text (split at line feeds, lines without a word left out): Viterbi decoding of per-line
features and a 2 x 2 transition. A text is kept if it passes the fixed rules and the share of its words'
code points in content lines is at least `share`.

Lines have labels of their own in fitting, over at most `limit` texts of either quality label. Boilerplate
is a line that stands in several texts after different lines and before different lines (copies of one text,
whose lines have the same neighbours, don't make their lines boilerplate). Other lines start with their text's
label. Then the field is fitted by gradient steps on the exact log-likelihood, and decodes the texts; decoded
labels are taken where a text's share still agrees with its label, and the field is fitted again (EM_ROUNDS).

Null and empty texts have no words: base_failed, not kept. A text that is one long line is one label; lines
and texts of any length are read whole. Without labelled rows of both kinds all lines are content. Repeated
rows are judged alike. Columns other than the key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import document_texts, sliced, text_slices, typed
from .labelled import sample
from .wordarrays import Words, mix64

LIMIT = 1500
SHARE = 0.5
EM_ROUNDS = 2
#: A line of SHARED_WORDS words or more is shared if it has so many different neighbours on either side.
SHARED, SHARED_WORDS = 4, 3
FEATURES = 15
_IS = {name: np.array([chr(b) in chars and b < 0x80 for b in range(256)]) for name, chars in {"symbol": "#*$%&|<>", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "stop": ".", "shout": "!", "pipe": "|<>"}.items()}
_FIRST_BYTE = np.array([b & 0xC0 != 0x80 for b in range(256)])


@dataclass
class Lines:
    """The lines with a word: doc, code points in words, features, words, hash of the words; and the counts of the texts."""

    doc: np.ndarray
    size: np.ndarray
    x: np.ndarray
    words: np.ndarray
    hash: np.ndarray
    counts: dict[str, np.ndarray]


def measure(texts: list[str]) -> Lines:
    words, n = Words(texts), len(texts)
    raw = words.raw
    summed = lambda flag: np.concatenate([[0], np.cumsum(flag)])
    points = summed(_FIRST_BYTE[raw] & words.solid)
    word_points = points[words.end] - points[words.start]
    hashes = words.hashes()
    _, shingles = words.shingles(3, hashes)
    # windows of three words inside one text
    at = np.flatnonzero(words.doc[:-2] == words.doc[2:]) if len(hashes) > 2 else np.zeros(0, np.int64)
    long = words.counts[words.doc[at]] >= 3
    at = at[long]
    window = shingles if len(shingles) == len(at) else _windows(words, hashes, at)
    again = _repeated(words.doc[at], window)
    covered = np.zeros(len(hashes) + 2, bool)
    for k in range(3):
        covered[at[again] + k] = True
    per_doc = lambda value: np.bincount(words.doc, value, n).astype(np.int64)

    breaks = np.flatnonzero(raw == 0x0A)  # the last byte of every text's share is one
    line_start = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else np.zeros(0, np.int64)
    line_of = np.searchsorted(breaks, words.start)
    full, first_word, n_words = np.unique(line_of, return_index=True, return_counts=True)
    start, end = line_start[full], breaks[full]
    doc = words.doc[first_word] if len(full) else np.zeros(0, np.int64)
    seen: list[set] = [set() for _ in range(n)]
    data = raw.tobytes()
    dup = np.zeros(len(full), bool)
    for i, (d, a, b) in enumerate(zip(doc.tolist(), start.tolist(), end.tolist(), strict=True)):
        line = data[a:b]
        dup[i] = line in seen[d]
        seen[d].add(line)
    size = np.add.reduceat(word_points, first_word) if len(full) else np.zeros(0, np.int64)
    share = lambda flag: (summed(flag[raw])[end] - summed(flag[raw])[start]) / np.maximum(size, 1)
    spread = lambda value: np.add.reduceat(value, first_word) / np.maximum(n_words, 1) if len(full) else np.zeros(0)
    same = np.append(False, (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])) if len(hashes) else np.zeros(0, bool)
    last = raw[words.end[first_word + n_words - 1] - 1] if len(full) else np.zeros(0, np.uint8)
    x = np.column_stack([
        np.ones(len(full)), np.minimum(np.log1p(n_words) / 4, 2), n_words < 5, np.minimum(size / np.maximum(n_words, 1) / 10, 2),
        share(_IS["symbol"]), share(_IS["symbol"]) > 0.05, share(_IS["upper"]) > 0.5, np.minimum(share(_IS["shout"]) * 5, 2), share(_IS["digit"]),
        share(_IS["pipe"]) > 0.02, _IS["stop"][last], dup, spread(same.astype(float)), spread(covered[: len(hashes)].astype(float)), np.zeros(len(full)),
    ]).astype(float).reshape(len(full), FEATURES)
    symbols = summed(_IS["symbol"][raw])
    counts = {
        "n_words": words.counts.astype(np.int64), "word_chars": per_doc(word_points), "n_symbols": symbols[words.doc_end] - symbols[words.doc_start],
        "n_dup_lines": np.bincount(doc, dup, n).astype(np.int64), "n_repeat_words": per_doc(covered[: len(hashes)]),
    }
    place = np.arange(len(hashes)) - np.repeat(first_word, n_words) if len(full) else np.zeros(0, np.int64)
    line_hash = np.add.reduceat(mix64(hashes + mix64(place.astype(np.uint64))), first_word) if len(full) else np.zeros(0, np.uint64)
    return Lines(doc, size, x, n_words, line_hash, counts)


def shared_lines(doc: np.ndarray, words: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Sorted hashes of the lines with SHARED different neighbours or more on either side."""
    edge = doc[1:] != doc[:-1]
    before, after = np.append(np.uint64(0), np.where(edge, np.uint64(0), line[:-1])), np.append(np.where(edge, np.uint64(0), line[1:]), np.uint64(0))
    found = None
    for near in (before, after):
        pairs = np.unique(np.column_stack([line, near])[words >= SHARED_WORDS], axis=0)
        value, times = np.unique(pairs[:, 0], return_counts=True)
        often = value[times >= SHARED]
        found = often if found is None else np.intersect1d(found, often)
    return found


def _windows(words: Words, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    keep = words.counts >= 3
    docs, found = words.shingles(3, hashes)
    return found[keep[docs]]


def _repeated(docs: np.ndarray, value: np.ndarray) -> np.ndarray:
    order = np.lexsort((value, docs))
    same = (docs[order][1:] == docs[order][:-1]) & (value[order][1:] == value[order][:-1]) if len(order) else np.zeros(0, bool)
    out = np.zeros(len(docs), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


@dataclass
class Field:
    """emit[label, feature] and move[label, next label]; label 1 is content. shared: sorted hashes of the shared lines."""

    emit: np.ndarray
    move: np.ndarray
    shared: np.ndarray

    def features(self, lines: Lines) -> np.ndarray:
        x = lines.x.copy()
        x[:, -1] = np.isin(lines.hash, self.shared)
        return x

    def decode(self, doc: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The best label sequence of each text, all texts advancing line by line together."""
        score = x @ self.emit.T
        labels = np.zeros(len(doc), np.int8)
        if not len(doc):
            return labels
        place, start, lengths = _places(doc)
        best, back = score.copy(), np.zeros((len(doc), 2), np.int8)
        for step in _steps(place):
            came = best[step - 1][:, :, None] + self.move[None]
            back[step] = came.argmax(axis=1)
            best[step] += came.max(axis=1)
        tail = start + lengths - 1
        labels[tail] = best[tail].argmax(axis=1)
        for step in reversed(_steps(place)):
            labels[step - 1] = back[step, labels[step]]
        return labels


def _places(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    lengths = np.diff(np.append(start, len(doc)))
    return np.arange(len(doc)) - np.repeat(start, lengths), start, lengths


def _steps(place: np.ndarray) -> list[np.ndarray]:
    """The lines of place 1, of place 2, and so on."""
    order = np.argsort(place, kind="stable")
    cuts = np.cumsum(np.bincount(place))
    return np.split(order, cuts[:-1])[1:]


def fit(good: list[str], bad: list[str], share: float = SHARE, rounds: int = 100, em_rounds: int = EM_ROUNDS) -> Field:
    """The field of texts of either label; see labelled_lines for what its lines are taken to be."""
    return labelled_lines(good, bad, share, rounds, em_rounds)[0]


def labelled_lines(good: list[str], bad: list[str], share: float = SHARE, rounds: int = 100, em_rounds: int = EM_ROUNDS) -> tuple[Field, np.ndarray, np.ndarray]:
    """(field, doc, label) of the lines of good and bad texts as the last round has them."""
    if not good or not bad:
        emit = np.zeros((2, FEATURES))
        emit[1, 0] = 1
        return Field(emit, np.zeros((2, 2)), np.zeros(0, np.uint64)), np.zeros(0, int), np.zeros(0, int)
    parts = [(a, measure([*good, *bad][a:b])) for a, b in sliced([*good, *bad])]
    joined = lambda get: np.concatenate([get(a, m) for a, m in parts])
    doc, size, line = joined(lambda a, m: a + m.doc), joined(lambda a, m: m.size), joined(lambda a, m: m.hash)
    shared = shared_lines(doc, joined(lambda a, m: m.words), line)
    common = np.isin(line, shared)
    x = joined(lambda a, m: m.x)
    x[:, -1] = common
    fine, n = np.arange(len(good) + len(bad)) < len(good), len(good) + len(bad)

    def agreeing(labels: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """labels in the texts whose share of content agrees with their own label, elsewhere the others."""
        part = np.bincount(doc, size * labels, n) / np.maximum(np.bincount(doc, size, n), 1)
        return np.where(((part >= share) == fine)[doc], labels, otherwise)

    whole = fine[doc].astype(int)
    y = agreeing(np.where(common, 0, whole), whole)
    field = _fitted(doc, x, y, shared, rounds)
    for _ in range(em_rounds):
        y = agreeing(np.where(common, 0, field.decode(doc, x).astype(int)), y)
        field = _fitted(doc, x, y, shared, rounds)
    return field, doc, y


def _fitted(doc: np.ndarray, x: np.ndarray, y: np.ndarray, shared: np.ndarray, rounds: int) -> Field:
    place, start, lengths = _places(doc)
    steps = _steps(place)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    emit, move = np.zeros((2, FEATURES)), np.zeros((2, 2))
    m = [np.zeros_like(emit), np.zeros_like(move)]
    v = [np.zeros_like(emit), np.zeros_like(move)]
    for k in range(1, rounds + 1):
        score = x @ emit.T
        ahead, behind = score.copy(), np.zeros_like(score)
        for s in steps:
            ahead[s] += np.logaddexp.reduce(ahead[s - 1][:, :, None] + move, axis=1)
        for s in reversed(steps):
            behind[s - 1] = np.logaddexp.reduce(move + (score[s] + behind[s])[:, None, :], axis=2)
        total = np.logaddexp.reduce(ahead + behind, axis=1)
        node = np.exp(ahead + behind - total[:, None])
        off = (node - np.eye(2)[y]) * weight[:, None]
        d_move = np.zeros((2, 2))
        for s in steps:
            pair = np.exp(ahead[s - 1][:, :, None] + move + (score[s] + behind[s])[:, None, :] - total[s][:, None, None])
            pair[np.arange(len(s)), y[s - 1], y[s]] -= 1
            d_move += (pair * weight[s][:, None, None]).sum(axis=0)
        for i, (value, slope) in enumerate(((emit, off.T @ x + 1e-4 * emit), (move, d_move + 1e-4 * move))):
            m[i], v[i] = 0.9 * m[i] + 0.1 * slope, 0.99 * v[i] + 0.01 * slope**2
            value -= 0.1 * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)
    return Field(emit, move, shared)


def fails(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The base rules: fewer than 50 words, or more than half of the words in repeated windows."""
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def judge(texts: list[str], field: Field, share: float = SHARE) -> dict[str, np.ndarray]:
    lines = measure(texts)
    labels = field.decode(lines.doc, field.features(lines))
    n = len(texts)
    content, size = np.bincount(lines.doc, lines.size * labels, n), np.bincount(lines.doc, lines.size, n)
    c = lines.counts
    failed = fails(c)
    part = content / np.maximum(size, 1)
    return c | {"base_failed": failed, "kept": ~failed & (part >= share), "content_share": part}


def base_counts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, counts, base_failed) for each row of docs(key, text): what needs no labels."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                found = measure(texts).counts
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *[pa.array(found[c]) for c in names], pa.array(fails(found))], names=[key, *names, "base_failed"])

    fields = ", ".join(f"{c} long" for c in names) + ", base_failed boolean"
    return document_texts(docs, key).mapInArrow(run, typed(docs, key, fields))


def assess(docs: DataFrame, field: Field, share: float = SHARE, key: str = "doc_id") -> DataFrame:
    """(key, counts, base_failed, kept, content_share) for each row of docs(key, text)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                found = judge(texts, field, share)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *[pa.array(found[c]) for c in names]], names=[key, *names])

    fields = ", ".join(f"{c} long" for c in names[:5]) + ", base_failed boolean, kept boolean, content_share double"
    return document_texts(docs, key).mapInArrow(run, typed(docs, key, fields))


def filter_quality(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, share: float = SHARE, key: str = "doc_id") -> DataFrame:
    good, bad = (sample(docs, labels, "quality", v, limit, None, key) for v in (1, 0))
    return assess(docs, fit(good, bad, share), share, key)
