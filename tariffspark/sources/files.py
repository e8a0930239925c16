"""Record files, settings and databases as sources (SC1-SC8, SC10, SC11)."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tariffspark.functions import text

try:
    import yaml
except ImportError:  # only YAML files need it
    yaml = None

#: The fields of a record beside text, code and source.
ENRICHMENT = ("ruling_number", "reasoning", "hts_text", "materials", "product_use", "country", "chapter_code", "chapter_description", "heading_code", "heading_description", "tariff_description", "subject", "ruling_date")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, escape='"', multiLine=True)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def _jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The schema is inferred from all rows, as any may bring a new field; pass `load` a schema to read a large file once."""
    return spark.read.option("mode", "FAILFAST").json(path)


def _json(spark: SparkSession, path: str) -> DataFrame:
    """A list of records, or an object that wraps it as data, records or items (the first there is)."""
    df = spark.read.json(path, multiLine=True)
    wrapper = next((c for c in ("data", "records", "items") if c in df.columns and df.schema[c].dataType.typeName() == "array"), None)
    return df.select(F.explode(wrapper).alias("r")).select("r.*") if wrapper else df


def _yaml(spark: SparkSession, path: str) -> DataFrame:
    """SC7: a small YAML file, a list of records or an object that wraps one; read as one text through Spark's file systems."""
    if yaml is None:
        raise ImportError("reading YAML needs PyYAML")
    found = yaml.safe_load("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    if isinstance(found, dict):
        found = next((found[c] for c in ("data", "records", "items") if isinstance(found.get(c), list)), [found])
    if not found:
        return spark.createDataFrame([], "description string")
    body = F.lit(json.dumps(found, default=str))
    return spark.range(1).select(F.explode(F.from_json(body, F.schema_of_json(body))).alias("r")).select("r.*")


READERS = {"csv": _csv, "jsonl": _jsonl, "json": _json, "yaml": _yaml, "yml": _yaml}


#: The names and defaults of all settings below.
@dataclass(frozen=True)
class ExportSettings:
    """SC10: what an export keeps, with defaults."""

    min_description_length: int = 30
    min_reasoning_length: int = 20
    max_reasoning_length: int = 500
    match_level: str = "hts8"
    min_senses: int = 1
    base_dir: str = "data/raw"
    versioned: bool = True


@dataclass(frozen=True)
class SplitSettings:
    train: float = 0.8
    val: float = 0.1
    test: float = 0.1
    seed: int = 42
    split_by: str = "ruling"
    stratify_by: str = "chapter"


@dataclass(frozen=True)
class SourceSettings:
    path: str = ""
    format: str = "jsonl"
    text_field: str = "description"
    code_field: str = "hts_code"


@dataclass(frozen=True)
class NormalizationSettings:
    """A threshold of 0 leaves near-duplicates in; the number of permutations has no meaning where similarity is exact."""

    min_description_length: int = 10
    max_description_length: int = 2048
    dedup_minhash_threshold: float = 0.8
    dedup_minhash_num_perm: int = 128


@dataclass(frozen=True)
class TaskWeights:
    """Read and, as the rate of abstentions is their own setting, not used."""

    hierarchical_classify: float = 0.9
    abstention: float = 0.1


@dataclass(frozen=True)
class AbstentionSettings:
    rate: float = 0.1
    label: str = "__ABSTAIN__"
    categories: tuple = ("vague_description", "missing_materials", "ambiguous_use")


@dataclass(frozen=True)
class CapSettings:
    """apply_to is read and not used: the cap comes before the split, so it holds for all."""

    enabled: bool = True
    max_per_code: int = 100
    apply_to: str = "train"


@dataclass(frozen=True)
class DataSettings:
    """SC10: data preparation from the sources to the written splits."""

    sources: tuple = ()
    normalization: NormalizationSettings = NormalizationSettings()
    task_weights: TaskWeights = TaskWeights()
    abstention: AbstentionSettings = AbstentionSettings()
    frequency_cap: CapSettings = CapSettings()
    split: SplitSettings = SplitSettings()
    glossary_path: str = ""
    output_dir: str = "data/processed"
    formatted_dir: str = "data/formatted"


#: What the items of a list are, by its name; others are texts.
_ITEMS = {"sources": SourceSettings}


def filled(kind: type, found: dict):
    """A settings object of the kind: what is not found has its default, an unknown name or a wrong type is an error, in groups as well."""
    own, out = kind(), {}
    for name, value in found.items():
        if not hasattr(own, name):
            raise ValueError(f"{kind.__name__} has no {name}")
        default = getattr(own, name)
        if is_dataclass(default):
            if not isinstance(value, dict):
                raise ValueError(f"{name} must be a group of settings")
            value = filled(type(default), value)
        elif isinstance(default, tuple):
            if not isinstance(value, list):
                raise ValueError(f"{name} must be a list")
            value = tuple(filled(_ITEMS[name], x) if name in _ITEMS else str(x) for x in value)
        elif not isinstance(value, type(default)) and not (isinstance(default, float) and isinstance(value, int)):
            raise ValueError(f"{name} must be of type {type(default).__name__}")
        out[name] = value
    return kind(**out)


def settings(spark: SparkSession, path: str, kind: type, section: str | None = None):
    """SC10: a settings object of the kind, from a YAML or JSON file or a section of it."""
    body = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    if not path.endswith(".json") and yaml is None:
        raise ImportError("reading YAML needs PyYAML")
    found = (json.loads(body) if path.endswith(".json") else yaml.safe_load(body)) or {}
    return filled(kind, (found.get(section) or {}) if section else found)


def database_url(default: str | None = None) -> str:
    """SC8: the address of the database, from the environment."""
    found = os.environ.get("DATABASE_URL", default)
    if not found:
        raise ValueError("set DATABASE_URL")
    return found


def load(spark: SparkSession, path: str, text_field: str = "description", code_field: str = "hts_code", schema: str | None = None) -> DataFrame:
    """SC4, SC5: rows with text and code; enrichment fields as columns, everything else in a JSON `metadata`. A missing file is an empty table.

    schema: of a JSONL file, which is then read once; fields outside it are not kept.
    """
    empty = "description string, hts_code string, source string, metadata string, " + ", ".join(f"{c} string" for c in ENRICHMENT)
    try:
        kind = path.rsplit(".", 1)[-1].lower()
        df = spark.read.schema(schema).option("mode", "FAILFAST").json(path) if schema and kind == "jsonl" else READERS[kind](spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], empty)
    rest = [c for c in df.columns if c not in (*ENRICHMENT, text_field, code_field, "description", "hts_code")]
    field = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    out = df.select(
        text.stripped(field(text_field)).alias("description"), text.stripped(field(code_field)).alias("hts_code"), F.lit(path.rsplit("/", 1)[-1]).alias("source"),
        (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("metadata"), *[field(c).alias(c) for c in ENRICHMENT],
    )
    return out.where(text.present(F.col("description")) & text.present(F.col("hts_code")))


def ingest(spark: SparkSession, paths: list[str], **fields) -> DataFrame:
    """SC6."""
    first, *more = [load(spark, p, **fields) for p in paths]
    for df in more:
        first = first.unionByName(df)
    return first


def glossary(rows: DataFrame, order: str = "line") -> DataFrame:
    """SC11: terms in lower case; the last definition wins; blanks go."""
    term = text.stripped(F.lower("term"))
    return rows.where(text.present(term) & text.present(F.col("definition"))).groupBy(term.alias("term")).agg(F.max_by("definition", order).alias("definition"))


def jdbc(spark: SparkSession, url: str, query: str, partition: str, low: int, high: int, n: int) -> DataFrame:
    """SC8: a table read in n ranges of a numeric column instead of pages."""
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", partitionColumn=partition, lowerBound=low, upperBound=high, numPartitions=n).load()
