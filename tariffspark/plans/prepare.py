"""Data preparation from settings to written splits: ingest, normalise, build, split, format, audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffspark.functions import text
from tariffspark.operators import audit, build, chat, dictionary, normalize
from tariffspark.session import scratch
from tariffspark.sources import files, sinks

#: Columns that formatting reads; a source may lack any of them.
_FIELDS = ("materials", "product_use", "country", "chapter_description", "heading_description", "tariff_description", "reasoning", "hts_text", "ruling_number")


def ingested(spark: SparkSession, settings: files.DataSettings) -> DataFrame:
    """All sources with `seq`, the place in the order of reading. Written once, so that the places stay."""
    rows = None
    for s in settings.sources:
        own = files.load(spark, s.path, s.text_field, s.code_field)
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        raise ValueError("the settings name no source")
    path = scratch(spark)
    rows.withColumn("seq", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def normalized(items: DataFrame, settings: files.NormalizationSettings, checkpoint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Valid codes, the length band, the first of equal rows, the first of similar ones."""
    out = normalize.exact_dedup(normalize.length_band(normalize.valid_codes(items), settings.min_description_length, settings.max_description_length))
    return normalize.near_dedup(out, settings.dedup_minhash_threshold, checkpoint) if settings.dedup_minhash_threshold else out


def built(items: DataFrame, settings: files.DataSettings, glossary: DataFrame | None = None) -> DataFrame:
    """Training examples: variants and their terms, a share turned into abstentions, the cap a code."""
    own = items.withColumns({c: F.lit(None).cast("string") for c in _FIELDS if c not in items.columns})
    made_of = text.present(F.col("materials")) | text.present(F.col("product_use"))
    own = own.withColumn("input_variant", build.variant(F.col("seq"), made_of, F.lit(glossary is not None)))
    if glossary is None:
        own = own.withColumn("terms", F.array().cast("array<struct<term:string,definition:string>>"))
    else:
        asks = F.col("input_variant") == "glossary_enriched"
        own = dictionary.glossary_defined(own.where(asks), glossary).unionByName(own.where(~asks), allowMissingColumns=True)
    chosen = build.abstain_rows(own.select("seq"), settings.abstention.rate).select("seq", F.lit(True).alias("_chosen"))
    own = own.join(chosen, "seq", "left").withColumn("abstain", F.coalesce("_chosen", F.lit(False))).withColumn("_bad", build.corrupted(F.col("description"), F.col("seq")))
    turned = lambda yes, no: F.when(F.col("abstain"), yes).otherwise(no)
    out = own.withColumns({
        "description": turned(F.col("_bad.description"), F.col("description")), "abstain_category": turned(F.col("_bad.category"), F.lit(None)),
        "task_type": turned(F.lit("abstention"), F.lit("hierarchical_classify")), "hts_code": turned(F.lit(settings.abstention.label), F.col("hts_code")),
    }).drop("_chosen", "_bad")
    return build.cap_per_code(out, settings.frequency_cap.max_per_code) if settings.frequency_cap.enabled else out


def split(examples: DataFrame, settings: files.SplitSettings) -> DataFrame:
    """examples with `split`, by ruling or by row."""
    return (build.assigned if settings.split_by == "ruling" else build.split_rows)(examples, settings.val, settings.test)


def formatted(rows: DataFrame) -> DataFrame:
    """Chat records with what the evaluation needs of the row."""
    return rows.select(chat.example(F.struct(*rows.columns), F.col("terms")).alias("messages"), "task_type", "hts_code", "abstain", "input_variant", "ruling_number", "split")


def run(spark: SparkSession, settings: files.DataSettings, checkpoint: Callable[[DataFrame], DataFrame]) -> dict:
    """The whole preparation: splits as JSON lines under formatted_dir/split=.., audit.json under output_dir; returns the audit."""
    words = files.glossary(spark.read.json(settings.glossary_path).withColumn("line", F.monotonically_increasing_id())) if settings.glossary_path else None
    rows = checkpoint(split(built(checkpoint(normalized(ingested(spark, settings), settings.normalization, checkpoint)), settings, words), settings.split))
    sinks.jsonl(formatted(build.shuffled(rows)), settings.formatted_dir, by="split")
    found = {"splits": audit.split_summary(rows).first().asDict(), "abstentions": audit.abstentions(rows).first().asDict(), "leaking_rulings": build.leaking_groups(rows).count()}
    sinks.small(spark, found, f"{settings.output_dir}/audit.json")
    return found
