"""Token counts of a sentence-piece BPE model by rank-synchronous merging of ragged arrays.

Pre-tokens (a run of blanks and the letters after it) of a batch lie one after another in one
integer array. In each round every sequence finds its pair of lowest rank, all sequences merge
together, and the round repeats until no pair of any sequence has a rank; the surviving symbols
are counted, a character outside the vocabulary as its UTF-8 bytes.

A sequence merges several occurrences of its lowest pair in one round only up to the first one
whose merge opens a pair of the same or a lower rank, which equals merging one after another.
Counts of short pre-tokens stay in a bounded cache. Null and empty texts have no tokens; texts of
any length are processed whole; rows that repeat are counted each for itself; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, document_texts, held, text_slices, typed

CACHE_BYTES = 96 << 20
KEPT_LENGTH = 64
#: The longest run of blanks that is one piece; longer runs are cut into such pieces from the left.
BLANK_RUN = 16
_NONE = np.int64(1) << 40
_OTHER = 1 << 21  # symbols of characters outside the vocabulary


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback and without text normalisation are counted")
        pieces = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type in (1, 4, 5)}
        if any(p.type in (4, 5) for p in model.pieces) or any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces that cross blanks, are unused or user-defined are not supported")
        rank = {s: r for r, s in enumerate(sorted({s for _, s in pieces.values()}, reverse=True))}
        self.id = {p: i for p, (i, _) in pieces.items()}
        keys, ranks, merged = [], [], []
        for p, (i, score) in pieces.items():
            for cut in range(1, len(p)):
                a, b = self.id.get(p[:cut]), self.id.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a << 22 | b)
                    ranks.append(rank[score])
                    merged.append(i)
        order = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(1) << 62)
        self.ranks, self.merged = np.append(np.array(ranks, np.int64)[order], _NONE), np.append(np.array(merged, np.int64)[order], -1)
        side = {self.id[x] << 22 | self.id[y] for p in pieces for x, y in zip(p, p[1:]) if x in self.id and y in self.id}
        self.meet = np.append(np.array(sorted(side), np.int64), np.int64(1) << 62)  # characters that some piece holds side by side
        self.cache = TwoGenerations(CACHE_BYTES, KEPT_LENGTH)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 22 | right
        at = np.searchsorted(self.keys, key)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], -1)

    def merge(self, pretokens: list[str]) -> np.ndarray:
        """The number of surviving symbols (bytes for unknown characters) of each pre-token.

        Pre-tokens are cut where two characters meet that no piece holds side by side: nothing is ever merged across.
        """
        text = "".join(pretokens)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        distinct, back = np.unique(codes, return_inverse=True)
        symbols = np.array([self.id.get(chr(c), _OTHER + c) for c in distinct], np.int64)
        weight = np.array([1 if chr(c) in self.id else len(chr(c).encode()) for c in distinct], np.int64)
        lengths = np.array([len(p) for p in pretokens], np.int64)
        owner, sym = np.repeat(np.arange(len(pretokens)), lengths), symbols[back]
        unknown = np.bincount(owner, weight[back] - 1, len(pretokens)).astype(np.int64)
        pairs = sym[:-1] << 22 | sym[1:]
        opens = np.append(True, (owner[1:] != owner[:-1]) | (self.meet[np.searchsorted(self.meet, pairs)] != pairs)) if len(sym) else np.zeros(0, bool)
        seq, owner = np.cumsum(opens) - 1, owner[opens]
        count = np.bincount(seq, minlength=len(owner))
        while len(sym):
            joined = np.append(seq[1:] == seq[:-1], False)
            rank, new = self._look(sym, np.where(joined, np.append(sym[1:], -1), -1))
            heads = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            low = np.minimum.reduceat(rank, heads)
            live = low < _NONE
            size = np.diff(np.append(heads, len(seq)))
            count[seq[heads]] = size
            if not live.any():
                break
            keep = np.repeat(live, size)
            sym, seq, rank, new, joined = sym[keep], seq[keep], rank[keep], new[keep], joined[keep]
            low_at = np.repeat(low[live], size[live])
            pick = np.flatnonzero(rank == low_at)
            opens = np.append(True, np.diff(pick) != 1)
            first = np.maximum.accumulate(np.where(opens, np.arange(len(pick)), 0))
            pick = pick[(np.arange(len(pick)) - first) % 2 == 0]
            made, own = new[pick], seq[pick]
            inside = lambda at: (at >= 0) & (at < len(seq)) & (seq[np.clip(at, 0, len(seq) - 1)] == own)
            near = lambda at: np.where(inside(at), sym[np.clip(at, 0, len(seq) - 1)], -1)
            opened = np.minimum(self._look(near(pick - 1), made)[0], self._look(made, near(pick + 2))[0])
            opened = np.minimum(opened, np.where(np.append(np.diff(pick) == 2, False), self._look(made, np.append(made[1:], -1))[0], _NONE))
            stops = opened <= rank[pick]
            before = np.cumsum(stops) - stops
            base = np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1]), before, 0))
            pick, made = pick[before == base], made[before == base]
            sym[pick] = made
            stay = np.ones(len(sym), bool)
            stay[pick + 1] = False
            sym, seq = sym[stay], seq[stay]
        return np.bincount(owner, count, len(pretokens)).astype(np.int64) + unknown

    def _count_new(self, pretokens: list[str]) -> dict[str, int]:
        """Runs of blanks: BLANK_RUN make one piece, and the last one may merge with what follows."""
        plain, runs = [], []
        for p in pretokens:
            blanks = len(p) - len(p.lstrip(" "))
            cut = 0 if blanks <= 2 * BLANK_RUN else (blanks - 1 - BLANK_RUN) // BLANK_RUN * BLANK_RUN
            plain.append("▁" * (blanks - cut) + p[blanks:])
            runs.append(cut // BLANK_RUN)
        counts = np.zeros(len(plain), np.int64)
        start = size = 0
        for i, p in enumerate([*plain, ""]):
            if size > 400_000 or i == len(plain):
                counts[start:i] = self.merge(plain[start:i])
                start, size = i, 0
            size += len(p)
        return dict(zip(pretokens, (counts + runs).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        return [sum(x) for x in self.cache.resolve([self._pretokens(t) for t in texts], self._count_new)]

    @staticmethod
    def _pretokens(text: str) -> list[str]:
        """Blanks belong to what follows them; the model puts one blank before the text."""
        if not text:
            return []
        words = text.replace("▁", " ").split(" ")
        if "" not in words:
            return [" " + w for w in words]
        out, blanks = [], 0
        for w in words:
            blanks += 1
            if w:
                out.append(" " * blanks + w)
                blanks = 0
        return [*out, " " * blanks] if blanks else out


def count_tokens(docs: DataFrame, path: str, limit: int, key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit: n_tokens > limit) for each row of docs(key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with held((path,), lambda: PieceModel(path)) as own:
            for batch in batches:
                for a, b, texts in text_slices(batch.column(2), 4 << 20):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(own.count(texts), pa.int64())], names=[key, "n_bytes", "n_tokens"])

    sized = document_texts(docs, key).select(key, F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = sized.mapInArrow(run, typed(docs, key, "n_bytes long, n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
