"""SentencePiece encoding and decoding by a table of prefixes for models of the merge type (BPE).

Merging always ends in the same pieces, so each prefix of a text has one last piece. An automaton of all pieces
names those that end at a place; of these the last piece of the prefix is the one that is compatible with the last
piece of the prefix before it: merging the two side by side changes neither. Places are filled from left to right
and the ids read off backwards, in time linear in the text, however long a word is.

Two pieces are incompatible if, while each is built up, the parts that meet at the border would be merged: if the
piece they make comes before the next step of either part. Of merges of one score the left one comes first.
Results on short pre-tokens (a run of blanks and what follows up to the next blank) stay in a cache bounded by bytes.

Nulls and empty texts have no ids and decode to nothing. Long texts are taken whole, in memory of some dozens
of bytes a character. A character outside the vocabulary is its UTF-8 bytes. Repeated rows are coded each for itself; other
columns, whatever their names, are not read. Ties do not occur beyond those between merges.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, document_texts, held, sliced, text_slices, typed

CACHE_BYTES = 64 << 20
SLICE = 1 << 19
LONGEST_KEPT = 64
#: Words that are longer are filled one by one.
LONG = 256
PAIR_SLOTS = 1 << 20
_SPREAD = np.int64(0x1E3779B97F4A7C15)
BLANK = "▁"
#: Stands between pre-tokens; no character of a text, so no piece reaches across.
_BETWEEN = "￿"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_NEVER = float("inf")


class PieceCodec:
    """One model; kept by each Python worker between its tasks."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback and without text normalisation are supported")
        kinds = [p.type for p in model.pieces]
        self.piece = [p.piece for p in model.pieces]
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.piece, kinds, strict=True)) if k == _NORMAL}
        if _USER in kinds or _UNUSED in kinds or any(BLANK in p.lstrip(BLANK) or _BETWEEN in p for p in self.ids):
            raise ValueError("pieces that cross blanks, are unused or user-defined are not supported")
        if not {c for p in self.ids for c in p} <= self.ids.keys():
            raise ValueError("every character of a piece must be a piece")
        self.order = [-p.score for p in model.pieces]  # merges of a lesser one come first
        self.byte = [kinds.index(_BYTE)] * 256
        for i, (p, k) in enumerate(zip(self.piece, kinds, strict=True)):
            if k == _BYTE:
                self.byte[int(p[1:-1], 16)] = i
        self.surface = [self._bytes(p, k, trainer.unk_surface) for p, k in zip(self.piece, kinds, strict=True)]
        self.silent = {i for i, k in enumerate(kinds) if k == _CONTROL}
        self.bytes_of = {i: b for b, i in enumerate(self.byte)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.pairs = np.full(PAIR_SLOTS, -1, np.int64)
        self.automaton = ahocorasick.Automaton()
        for p in sorted(self.ids, key=lambda p: (self.order[self.ids[p]], len(p))):
            i = self.ids[p]
            if len(p) == 1 or self._derived(p, i):
                self.automaton.add_word(p, i << 8 | len(p))
        self.automaton.make_automaton()
        self.length = np.array([len(p) for p in self.piece], np.int64)
        self.chunks = TwoGenerations(CACHE_BYTES, LONGEST_KEPT)

    @staticmethod
    def _bytes(piece: str, kind: int, unknown: str) -> bytes:
        return {_BYTE: lambda: bytes([int(piece[1:-1], 16)]), _CONTROL: lambda: b"", _UNKNOWN: unknown.encode}.get(kind, lambda: piece.replace(BLANK, " ").encode())()

    def _derived(self, piece: str, i: int) -> bool:
        """Whether merging the piece's characters ends in the piece itself; if so, its last merge is noted. Others never occur."""
        own = [self.ids[c] for c in piece]
        while len(own) > 1:
            made = [(self.order[m], k, m) for k in range(len(own) - 1) if (m := self.ids.get(self.piece[own[k]] + self.piece[own[k + 1]])) is not None]
            if not made:
                return False
            order, k, m = min(made)
            if len(own) == 2:
                if order < max(self.order[x] if x in self.parts else -_NEVER for x in own):
                    raise ValueError("a piece comes before one of its parts")
                self.parts[i] = own[0], own[1]
            own[k : k + 2] = [m]
        return True

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging leaves the two pieces as they are, side by side. x and y are the parts that meet at the border,
        latest first; each is there until its merge into the next later one."""
        x, x_goes = left, _NEVER
        ids, order, piece, parts = self.ids, self.order, self.piece, self.parts
        while True:
            y, y_goes = right, _NEVER
            while True:
                met = ids.get(piece[x] + piece[y])
                if met is not None and order[met] < x_goes and (order[met] <= y_goes or y_goes == _NEVER):
                    return False
                if y not in parts:
                    break
                y_goes, y = order[y], parts[y][0]
            if x not in parts:
                return True
            x_goes, x = order[x], parts[x][1]

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """_fit for many pairs. What was found stays in a table that holds one pair in each of its slots."""
        key = left.astype(np.int64) << 32 | right
        slot = (key * _SPREAD >> 40) & (PAIR_SLOTS - 1)
        held = self.pairs[slot]
        unknown = np.flatnonzero(held >> 1 != key)
        if len(unknown):
            fresh, back = np.unique(key[unknown], return_inverse=True)
            found = np.array([self._fit(k >> 32, k & 0xFFFFFFFF) for k in fresh.tolist()], np.int64)
            held[unknown] = (fresh << 1 | found)[back]
            self.pairs[slot[unknown]] = held[unknown]
        return (held & 1).astype(bool)

    def _last_pieces(self, text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The last piece of each prefix of the words text[start:end], at the place behind it; -1 at the start and after characters
        that are no piece. All words are filled together, place by place; words of over LONG characters one by one."""
        last = np.full(len(text) + 1, -1, np.int32)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        upto, piece = found[:, 0] + 1, (found[:, 1] >> 8).astype(np.int32)
        before, word = upto - (found[:, 1] & 255), np.searchsorted(start, found[:, 0], side="right") - 1
        long = (end - start > LONG)[word]
        for a, b, i in zip(before[long].tolist(), upto[long].tolist(), piece[long].tolist(), strict=True):
            if last[b] < 0 and (last[a] < 0 or self._fits(last[a : a + 1], np.array([i]))[0]):
                last[b] = i
        short = np.flatnonzero(~long)
        place = (upto - start[word])[short]
        order = np.argsort(place, kind="stable")
        cuts, order = np.searchsorted(place[order], np.arange(1, LONG + 2)), short[order]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = order[a:b]
            left, right = last[before[own]], piece[own]
            fits = left < 0
            rest = np.flatnonzero(~fits)
            fits[rest] = self._fits(left[rest], right[rest])
            last[upto[own[fits]]] = right[fits]  # exactly one of the pieces that end at a place fits
        return last

    def _encode_new(self, pretokens: list[str]) -> dict[str, bytes]:
        """pre-token -> its ids as little-endian int32, about SLICE characters of them in one run of the automaton."""
        out = {_BETWEEN: array("i", [self.byte[b] for b in _BETWEEN.encode()]).tobytes()}
        pretokens = [p for p in pretokens if p != _BETWEEN]
        for a, b in sliced(pretokens, SLICE):
            own = pretokens[a:b]
            text = _BETWEEN.join(own).replace(" ", BLANK)
            size = np.array([len(p) for p in own], np.int64)
            end = np.cumsum(size + 1) - 1
            packed, upto = self._backwards(text, self._last_pieces(text, end - size, end), end - size, end)
            out.update((p, packed[x:y]) for p, x, y in zip(own, upto, upto[1:], strict=False))
        return out

    def _backwards(self, text: str, last: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, list[int]]:
        """The ids of all words, packed, and where each word's begin; every word is read from its end, a piece of each at a time."""
        at, live, words, found = end.copy(), np.arange(len(end)), [], []
        while len(live):
            own = last[at[live]]
            strange = np.flatnonzero(own < 0)
            step = self.length[own]
            step[strange] = 1
            at[live] -= step
            own[strange] = [-1 - ord(text[k]) for k in at[live[strange]].tolist()]
            words.append(live)
            found.append(own)
            live = live[at[live] > start[live]]
        word, value = np.concatenate(words[::-1]), np.concatenate(found[::-1])
        order = np.argsort(word, kind="stable")
        word, value = word[order], value[order]
        strange = np.flatnonzero(value < 0)
        raw = [chr(-1 - v).encode() for v in value[strange].tolist()]
        times = np.ones(len(value), np.int64)
        times[strange] = [len(r) for r in raw]
        ids = np.repeat(value, times)
        ids[np.repeat(value < 0, times)] = [self.byte[b] for r in raw for b in r]
        return ids.astype("<i4").tobytes(), [0, *(4 * np.cumsum(np.bincount(word, times, len(end)).astype(np.int64))).tolist()]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        return [b"".join(x) for x in self.chunks.resolve([pretokens(t) for t in texts], self._encode_new)]

    def decode(self, ids: list[int]) -> str:
        """As the library's: of the blanks at the start one goes, bytes that are no UTF-8 become U+FFFD each, control ids say nothing."""
        surface = [self.surface[i] for i in ids]
        head = next((k for k, i in enumerate(ids) if i not in self.silent), None)
        if head is not None and self.piece[ids[head]].startswith(BLANK):
            surface[head] = surface[head][1:]
        if self.silent.isdisjoint(ids):  # these end a run of bytes
            try:
                return b"".join(surface).decode()
            except UnicodeDecodeError:
                pass
        return "".join(self._mended(ids, surface))

    def _mended(self, ids: list[int], surface: list[bytes]) -> Iterator[str]:
        run = b""
        for i, s in zip([*ids, None], [*surface, b""], strict=True):
            if i in self.bytes_of:
                run += s
                continue
            while run:
                good = next((n for n in (1, 2, 3, 4) if n <= len(run) and _whole(run[:n])), 0)
                yield run[:good].decode() if good else "�"
                run = run[max(good, 1) :]
            yield s.decode()


def _whole(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def pretokens(text: str) -> list[str]:
    """Blanks belong to what follows them; one blank is put before the text. No piece holds a blank after anything else."""
    if not text:
        return []
    if _BETWEEN in text:
        parts = text.split(_BETWEEN)  # the character is none of the vocabulary; it is coded by itself
        return [p for k, x in enumerate(parts) for p in ([_BETWEEN] if k else []) + _spaced(x, k == 0)]
    return _spaced(text, True)


def _spaced(text: str, first: bool) -> list[str]:
    words = text.replace(BLANK, " ").split(" ")
    head = [" " + words[0]] if first else [words[0]]
    if "" not in words:
        return head + [" " + w for w in words[1:]]
    out, blanks = [], int(first)
    for k, w in enumerate(words):
        blanks += k > 0
        if w:
            out.append(" " * blanks + w)
            blanks = 0
    return [*out, " " * blanks] if blanks else out


def codec(path: str):
    """The worker's codec, for the duration of a task."""
    return held(("pieces", path), lambda: PieceCodec(path))


def encode(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids: array of int) for each row of docs(key, text)."""
    return _coded(docs, path, key, "n_tokens long, ids array<int>", lambda _, i: (len(i), i))


def round_trip(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): digests of the decimal ids joined by commas and of the text decoded from them."""

    def row(own: PieceCodec, ids: list[int]) -> tuple:
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest()

    return _coded(docs, path, key, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)


def _coded(docs: DataFrame, path: str, key: str, fields: str, row) -> DataFrame:
    schema = typed(docs, key, fields)
    names, types = schema.names, [pa.int64(), *([pa.list_(pa.int32())] if "array" in fields else [pa.string()] * 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path) as own:
            for batch in batches:
                for a, b, texts in text_slices(batch.column(1), SLICE):
                    rows = [row(own, np.frombuffer(x, "<i4").tolist()) for x in own.encode(texts)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]], names=names)

    return document_texts(docs, key).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded: string) of rows (key, ids: array of int); null ids decode to nothing, an id outside the model is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path) as own:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=[key, "decoded"])

    return coded.select(F.col(key), F.col("ids")).mapInArrow(run, typed(coded, key, "decoded string"))
