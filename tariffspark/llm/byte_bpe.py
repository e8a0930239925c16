"""Byte-level BPE encoding and decoding with DuckDB recursive queries in each partition.

Each partition holds one in-memory DuckDB with the merge table. Token-position rows of the words that a
batch needs join that table; a recursive query contracts in every word the leftmost pair of minimum rank
until nothing changes; an ordered aggregation over the resulting ids gives back bytes. The recursion holds
one row for each word (USING KEY), so its memory does not grow with the number of steps.

A step takes further occurrences of the leftmost pair along, left to right. That equals one step for each,
unless contracting makes a pair of the same or a lower rank: the next step sees such a pair and then redoes
the step for the leftmost occurrence alone. Words are cut beforehand where two bytes meet that no token
holds side by side, since nothing is ever merged across. Results per space-delimited chunk, for a round trip the ids
and the bytes decoded from them, stay in a cache bounded by bytes, which idle workers drop.

Nulls and empty texts: no tokens, empty bytes. Long words take the same query; it steps once for each pair
that occurs, not for each occurrence. Repeated rows are encoded each for itself; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, document_texts, held, sliced, text_slices, typed

QUERY_BYTES = 250_000
#: Slices, queries and the two generations of the cache bound a worker's memory.
CACHE_BYTES = 192 << 20
SLICE = 1 << 19
LONGEST_KEPT = 192
#: Ids are private-use characters while words are contracted, so that a word's tokens are one string.
BASE = 0xF0000
#: A blank that follows white space: there the text can't be cut before the blank.
_UNSAFE_CUT = regex.compile(r"\s\x20|^\x20")

#: Every way to part a token into two. chains: the token followed by its left part is no pair of this or a lower rank.
_MERGES = f"""
CREATE TABLE merges AS
SELECT chr({BASE} + a.id) AS left_tok, chr({BASE} + b.id) AS right_tok, t.id AS rank, coalesce(longer.id, t.id + 1) > t.id AS chains
FROM (SELECT id, bytes, unnest(range(1, length(bytes))) AS cut FROM vocabulary WHERE id >= 0) t
JOIN vocabulary a ON a.bytes = left(t.bytes, cut)
JOIN vocabulary b ON b.bytes = substr(t.bytes, cut + 1)
LEFT JOIN vocabulary longer ON longer.bytes = t.bytes || left(t.bytes, cut)
"""

#: rank <= low: the last step of the word made such a pair, and is redone for one occurrence.
_CONTRACT = f"""
WITH RECURSIVE state(word, toks, earlier, pair, low) USING KEY (word) AS (
  SELECT word, toks, '', '', -1 FROM fresh
  UNION
  (WITH spots AS (
     SELECT word, unnest(parts) AS tok, unnest(parts[2:]) AS next_tok, generate_subscripts(parts, 1) AS pos
     FROM (SELECT word, string_split(toks, '') AS parts FROM state)),
   best AS (
     SELECT word, min((rank::BIGINT << 33) | (pos::BIGINT << 1) | chains::BIGINT) AS k
     FROM spots JOIN merges ON tok = left_tok AND next_tok = right_tok GROUP BY word),
   found AS (
     SELECT word, toks, earlier, pair, low, (k >> 33)::INTEGER AS rank, ((k >> 1) & 4294967295) AS pos, (k & 1) = 1 AS chains
     FROM state JOIN best USING (word))
   SELECT word,
     CASE WHEN rank <= low THEN left(earlier, strpos(earlier, pair) - 1) || chr({BASE} + low) || substr(earlier, strpos(earlier, pair) + 2)
          WHEN chains THEN replace(toks, substr(toks, pos, 2), chr({BASE} + rank))
          ELSE left(toks, pos - 1) || chr({BASE} + rank) || substr(toks, pos + 2) END,
     CASE WHEN rank <= low OR NOT chains THEN '' ELSE toks END,
     CASE WHEN rank <= low OR NOT chains THEN '' ELSE substr(toks, pos, 2) END,
     CASE WHEN rank <= low OR NOT chains THEN -1 ELSE rank END
   FROM found)
)
SELECT toks FROM state ORDER BY word
"""

#: One ordered aggregation over the ids of many texts; the row of id -1 stands between texts.
_DECODE = "SELECT string_agg(bytes, '' ORDER BY pos), count(*) FROM given JOIN vocabulary USING (id)"
#: Bytes are held as characters of the same code; this one is none of them.
_BETWEEN = chr(256)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """One vocabulary in one DuckDB; kept by each Python worker between its tasks."""

    def __init__(self, path: str, pattern: str, decoded: bool = False, cache: int = CACHE_BYTES):
        """decoded: what is kept of a chunk is its ids and the bytes decoded from them."""
        ranks = read_ranks(path)
        if max(ranks.values()) >= 0x110000 - BASE:
            raise ValueError("ids must fit the private-use planes")
        self.words_of = regex.compile(pattern).findall
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        # No temp_directory: batches fit into memory, and nothing is left on a machine's own disk.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "allocator_flush_threshold": "1MB", "allocator_bulk_deallocation_flush_threshold": "1MB"})
        self.db.register("loading", pa.table({"id": pa.array([-1, *ranks.values()], pa.int32()), "bytes": pa.array([_BETWEEN, *(t.decode("latin-1") for t in ranks)])}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM loading")
        self.db.unregister("loading")
        self.db.execute(_MERGES)
        raw, last = np.frombuffer(b"".join(ranks), np.uint8), np.cumsum([len(t) for t in ranks]) - 1
        inside = np.ones(len(raw), bool)
        inside[last] = False
        self.meet = np.zeros((256, 256), bool)  # bytes that some token holds side by side
        self.meet[raw[:-1][inside[:-1]], raw[1:][inside[:-1]]] = True
        self.decoded = decoded
        self.chunks = TwoGenerations(cache, LONGEST_KEPT)

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """word -> its ids as little-endian uint32. A word that was a chunk by itself before is not contracted again."""
        out: dict[str, bytes] = {}
        batch, size = [], 0
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[word] = rank.to_bytes(4, "little")
                continue
            known = self.chunks.get(word)
            if known is not None and self.words_of(word) == [word]:
                out[word] = known[0] if self.decoded else known
                continue
            batch.append((word, raw))
            size += len(raw)
            if size >= QUERY_BYTES:
                out.update(self._contract(*zip(*batch, strict=True)))
                batch, size = [], 0
        if batch:
            out.update(self._contract(*zip(*batch, strict=True)))
        return out

    def _contract(self, words: Sequence[str], raws: Sequence[bytes]) -> dict[str, bytes]:
        flat, ends = np.frombuffer(b"".join(raws), np.uint8), np.cumsum([len(x) for x in raws])
        cut = np.append(~self.meet[flat[:-1], flat[1:]], True)
        cut[ends - 1] = True
        piece_ends = np.flatnonzero(cut) + 1
        toks = (self.single[flat] + np.uint32(BASE)).astype("<u4").tobytes().decode("utf-32-le").encode()
        offsets = (4 * np.append(0, piece_ends)).astype(np.int64)  # such a character takes four bytes
        given = pa.LargeStringArray.from_buffers(len(piece_ends), pa.py_buffer(offsets), pa.py_buffer(toks))
        self.db.register("fresh", pa.table({"word": np.arange(len(piece_ends), dtype=np.int32), "toks": given}))
        found = self.db.execute(_CONTRACT).fetchnumpy()["toks"].tolist()
        self.db.unregister("fresh")
        ids = (np.frombuffer("".join(found).encode("utf-32-le"), "<u4") - np.uint32(BASE)).astype("<u4").tobytes()
        upto = 4 * np.cumsum([0, *map(len, found)])
        at = upto[np.append(0, np.searchsorted(piece_ends, ends) + 1)].tolist()
        return {w: ids[a:b] for w, a, b in zip(words, at, at[1:], strict=False)}

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each text's packed ids; an id outside the vocabulary is an error."""
        ids = np.frombuffer((_SEPARATOR).join(packed), "<i4")
        self.db.register("given", pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        text, known = self.db.execute(_DECODE).fetchall()[0]
        self.db.unregister("given")
        if known < len(ids):
            raise ValueError("an id is not in the vocabulary")
        return [x.encode("latin-1") for x in (text or "").split(_BETWEEN)] if packed else []

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text.

        A text is cut before every blank that follows something other than white space;
        the pattern never matches across such a cut, so chunks can be encoded once each.
        """
        return [x for x, _ in self.round_trip(texts)] if self.decoded else [b"".join(x) for x in self._resolved(texts)]

    def round_trip(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """The packed ids of each text and the bytes decoded from them, chunk by chunk: a text's ids are its chunks' in order."""
        return [(b"".join([i for i, _ in x]), b"".join([d for _, d in x])) for x in self._resolved(texts)]

    def _resolved(self, texts: list[str]) -> list[list]:
        return self.chunks.resolve([self._chunks(t) for t in texts], self._encode_chunks)

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes] | dict[str, tuple[bytes, bytes]]:
        parts = {c: self.words_of(c) for c in chunks}
        words = self.encode_words(sorted({w for p in parts.values() for w in p}))
        found = {c: b"".join([words[w] for w in p]) for c, p in parts.items()}
        if not self.decoded:
            return found
        packed = list(found.values())
        back = [d for a, b in sliced(packed, SLICE) for d in self.decode(packed[a:b])]
        return dict(zip(found, zip(packed, back, strict=True), strict=True))

    @staticmethod
    def _chunks(text: str) -> list[str]:
        if not text:
            return []
        if _UNSAFE_CUT.search(text) is None:
            head, *rest = text.split(" ")
            return [head, *[" " + x for x in rest]]
        return regex.split(r"(?V1)(?<=\S)(?=\x20)", text)


_SEPARATOR = (-1).to_bytes(4, "little", signed=True)


def codec(path: str, pattern: str, decoded: bool = False, cache: int = CACHE_BYTES):
    """The worker's codec, for the duration of a task."""
    return held((path, pattern, decoded, cache), lambda: Codec(path, pattern, decoded, cache))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids: binary of little-endian uint32, n_tokens) for each row of docs(key, text)."""
    return _coded(docs, path, pattern, key, "n_tokens long, ids binary", lambda i: (len(i) // 4, i), decoded=False)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", cache: int = CACHE_BYTES) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the bytes decoded from them.

    cache: bytes of a generation of a worker's cache. A larger one saves time, a smaller one memory.
    """
    digest = lambda x: hashlib.sha256(x).hexdigest()
    return _coded(docs, path, pattern, key, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda i, d: (len(i) // 4, digest(i), digest(d)), cache=cache)


def _coded(docs: DataFrame, path: str, pattern: str, key: str, fields: str, row, decoded: bool = True, cache: int = CACHE_BYTES) -> DataFrame:
    schema = typed(docs, key, fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path, pattern, decoded, cache) as own:
            for batch in batches:
                for a, b, texts in text_slices(batch.column(1), SLICE):
                    rows = [row(*x) for x in own.round_trip(texts)] if decoded else [row(i) for i in own.encode(texts)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, zip(*rows, strict=True))], names=names)

    return document_texts(docs, key).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded: binary) of rows (key, ids: binary of little-endian uint32); null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path, pattern) as own:
            for batch in batches:
                packed = [x or b"" for x in batch.column(1).to_pylist()]
                for a, b in sliced(packed, SLICE):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(own.decode(packed[a:b]), pa.binary())], names=[key, "decoded"])

    return coded.select(F.col(key), F.col("ids")).mapInArrow(run, typed(coded, key, "decoded binary"))
