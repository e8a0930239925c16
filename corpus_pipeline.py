"""A training corpus from raw documents: toxicity, near-duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
documents, further ones as well, whatever their names. run() writes each stage's result to the shared folder
and rereads it as the next one's input. Decisions are made row by row, so null and repeated ids are nothing
special: of rows that repeat in every column one stays after near-duplicates, like of any copies.
Nulls: a null text is clean, has no duplicates, no spans, no words and no tokens; without words a row takes no
part in the mix but for the copies its source's rate gives it. Very long texts are taken whole by every stage.
Ties: near-duplicates keep the least doc_id, nulls first. An empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffspark.llm import byte_bpe, minhash_dedup, mixing, pii, toxicity
from tariffspark.llm.common import materialise, table

#: Bytes of a generation of a BPE worker's cache: small, as executors still hold what earlier stages needed.
BPE_CACHE = 32 << 20
#: Toxicity and near-duplicates cannot be said in SQL.
ORACLE_SQL = None


def _columns(docs: DataFrame, of: DataFrame) -> DataFrame:
    """The columns of `of`, unpacked from the struct `doc`."""
    return docs.select(*[F.col("doc").getField(c).alias(c) for c in of.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier chain rejects go; the verdict is the row's own, and rows travel with it, so nothing is joined."""
    chain = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.score(docs.select(F.struct(*docs.columns).alias("doc"), "text"), chain, key="doc")
    return _columns(judged.where(~F.col("toxic")), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows (five-word shingles, Jaccard of 0.8) the one of the least doc_id stays."""
    rows = materialise(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")))
    keyed = rows.select(F.struct(F.col("doc.doc_id").alias("id"), "row").alias("own"), F.col("doc.text").alias("text"))
    gone = minhash_dedup.near_duplicates(keyed, key="own", size=5, percent=80).where(~F.col("kept")).select("own.row")
    return _columns(rows.join(gone, "row", "left_anti"), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans become the name of their kind; n_chars follows the text."""
    done = pii.redact(docs, pii.find(docs))
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return done.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's rate and its id's draw say; copies are rows alike."""
    return mixing.emit(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them, one row for each row of docs."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, cache=BPE_CACHE)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
