"""Ruling tables: work queue, progress, samples, enrichment, valid codes, upserts (JN1-JN5, AG9, AG17, AG19, AG22, FL3-FL8, FL10, SK4-SK6, SC9, ST4, ST12, ST13, WN5-WN7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffspark.functions import codes, text

FAILED = "__EXTRACTION_FAILED__"


def eligible(rulings: DataFrame, texts: DataFrame) -> DataFrame:
    """JN2, FL5: classification rulings that stand, have tariffs and more than 100 characters of text."""
    own = rulings.where(F.col("categories").ilike("%classification%") & ~F.coalesce("is_revoked", F.lit(False)) & (F.size("tariffs") > 0))
    return own.join(texts, "ruling_number").where(F.length("ruling_text") > 100)


def work_queue(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """JN4: what has no extraction yet."""
    return candidates.join(done.select("ruling_number"), "ruling_number", "left_anti")


def page(rows: DataFrame, order: list, offset: int, n: int) -> DataFrame:
    """SC9, WN6: a page in a total order; whole scans should not page."""
    return rows.orderBy(*order).offset(offset).limit(n)


def progress(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """AG9: one row of totals."""
    state = done.agg(F.countDistinct(F.when(F.col("description") != FAILED, F.col("ruling_number"))).alias("extracted"), F.countDistinct(F.when(F.col("description") == FAILED, F.col("ruling_number"))).alias("failed"))
    return candidates.agg(F.count("*").alias("total")).join(state).select("total", "extracted", "failed", (F.col("total") - F.col("extracted") - F.col("failed")).alias("remaining"))


def random_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """WN7: the rows of the least hashes, a distributed top-k."""
    return rows.orderBy(text.order_hash(F.col(key), seed), key).limit(n)


def enriched(items: DataFrame, chapters: DataFrame, headings: DataFrame, tariffs: DataFrame) -> DataFrame:
    """JN1, JN3: left joins on prefixes computed before. The dimensions are small or not: the planner broadcasts by their size."""
    d = codes.digits(F.col("hts_code"))
    keyed = items.withColumns({"chapter": F.lpad(F.substring(d, 1, 2), 2, "0"), "hts4": F.substring(d, 1, 4), "hts8": F.substring(d, 1, 8)})
    return keyed.join(chapters, "chapter", "left").join(headings, "hts4", "left").join(tariffs, "hts8", "left")


def valid_sets(tariffs: DataFrame) -> DataFrame:
    """AG22: distinct codes at 8, 6 and 4 digits."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("digits"), F.substring("hts8", 1, k).alias("code")) for k in (8, 6, 4)])).alias("x")
    return tariffs.select(each).select("x.*").distinct()


def current_valid(items: DataFrame, tariffs: DataFrame, digits: int = 8) -> DataFrame:
    """JN5: items with `is_valid`; one join gives kept and excluded rows."""
    known = tariffs.select(F.substring("hts8", 1, digits).alias("level_code")).distinct().withColumn("found", F.lit(True))
    return items.withColumn("level_code", codes.digit_prefix(F.col("hts_code"), digits)).join(known, "level_code", "left").withColumn("is_valid", F.coalesce("found", F.lit(False))).drop("found")


def export_filter(rows: DataFrame, low: int, high: int) -> DataFrame:
    """FL3, FL4."""
    n = F.length(F.coalesce("reasoning", F.lit("")))
    return rows.where((F.col("description") != FAILED) & n.between(low, high) & (F.length(codes.digits(F.col("hts_code"))) >= 4))


def flat_glossary(glossary: DataFrame) -> DataFrame:
    """ST13, FL7: one row a sense."""
    return glossary.where(F.size("senses") >= 1).select(
        "term", F.explode("senses").alias("s"), F.size("senses").alias("senses"), F.format_string("hts_glossary (source_count=%d)", "source_count").alias("source")
    ).select("term", F.col("s.definition").alias("definition"), F.col("s.category").alias("category"), "source", "senses")


def decoded_list(column: str):
    """ST12."""
    return F.coalesce(F.from_json(column, "array<string>"), F.array().cast("array<string>"))


def upserted(old: DataFrame, new: DataFrame, keys: list[str], stamp: str | None = None) -> DataFrame:
    """SK4: new rows replace old ones of their key; `stamp` names a column that bears the time of the run in new rows."""
    if stamp:
        new = new.withColumn(stamp, F.current_timestamp())
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=bool(stamp))


def extractions(extracted: DataFrame, rulings: DataFrame) -> DataFrame:
    """JN1: extracted products with their ruling's subject, date and tariffs; products without a ruling go."""
    return extracted.join(rulings.select("ruling_number", "subject", "ruling_date", "tariffs"), "ruling_number")


def with_subjects(rulings: DataFrame, longer_than: int = 20) -> DataFrame:
    """FL6."""
    return rulings.where(F.length("subject") > longer_than)


def described(enrichments: DataFrame, least: int = 30) -> DataFrame:
    """FL8."""
    return enrichments.where(F.length("enriched_description") >= least)


def exported(rulings: DataFrame, body: str | None = None) -> DataFrame:
    """ST4, FL10: the description is taken from the ruling's text if it has one, else from its subject, and `description_source` says which;
    the first tariff is the code. Rulings without a tariff or with a description of under 10 characters go."""
    product = text.product_description(F.col(body)) if body else F.lit(None).cast("string")
    code = F.get("tariffs", F.lit(0))
    out = rulings.withColumn("_product", product).withColumns({
        "description": F.coalesce("_product", text.clean_subject(F.col("subject"))), "hts_code": code, "description_source": F.when(F.col("_product").isNotNull(), "ruling_text").otherwise("subject"),
    })
    return out.where(text.present(F.col("hts_code")) & (F.length("description") >= 10)).drop("_product")


def export_stats(judged: DataFrame) -> DataFrame:
    """AG17: kept and excluded rows of current_valid, and the share that was kept, in percent."""
    kept = F.count_if("is_valid")
    return judged.agg(F.count("*").alias("total"), kept.alias("kept"), (F.count("*") - kept).alias("excluded"), (100 * kept / F.greatest(F.count("*"), F.lit(1))).alias("pct_kept"))


def sample_summary(rows: DataFrame, fields: list[str]) -> DataFrame:
    """AG19: of a validation sample: lengths of the descriptions (here the median interpolates), codes there are and codes that agree with
    the ruling's tariffs, products beyond one a ruling, and fields that are not empty."""
    n = F.length("description")
    coded = text.present(F.col("hts_code"))
    return rows.agg(
        F.count("*").alias("total"), F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.avg(n).alias("mean_len"), F.median(n).alias("median_len"),
        F.count_if(coded).alias("with_code"), F.count_if(coded & codes.agrees_with_any(codes.cleaned(F.col("hts_code")), F.transform("tariffs", codes.cleaned))).alias("agreeing"),
        (F.count("*") - F.countDistinct("ruling_number")).alias("extra_products"), *[F.count_if(text.present(F.col(f))).alias(f"with_{f}") for f in fields],
    )


#: The columns of the table of extracted products, whose key is (ruling_number, product_idx).
EXTRACTIONS = "ruling_number string not null, product_idx int not null, description string, hts_code string, product_use string, materials string, reasoning string, hts_text string, country string, extraction_model string, tokens_used int, extracted_at timestamp, raw_response string"


def ensured(spark: SparkSession, path: str, schema: str = EXTRACTIONS) -> DataFrame:
    """SK6: the table at the path, written empty if it is not there yet."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)


def failure_rows(rulings: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """SK5, ST10: a sentinel row for each ruling, or for each that gave no product."""
    if products is not None:
        rulings = rulings.join(products.select("ruling_number"), "ruling_number", "left_anti")
    return rulings.select("ruling_number", F.lit(0).alias("product_idx"), F.lit(FAILED).alias("description"))
