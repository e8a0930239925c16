"""Sinks (SK1-SK3, SK7-SK9, SK11, ST31)."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    import yaml
except ImportError:  # only YAML files need it
    yaml = None


def jsonl(df: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> None:
    """SK1, SK2 (mode append), SK9 (by='split'): one JSON object a line, nulls written."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """SK11: whether a finished output is there, on whatever store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def lines(spark: SparkSession, path: str) -> int | None:
    """SK11: the number of lines of a finished text output; null if it is not finished, so that its step runs."""
    return spark.read.text(path).count() if exists(spark, path) else None


def small(spark: SparkSession, value, path: str, rows: int = 10_000) -> None:
    """SK3: a small result as one JSON or YAML file, by the path's ending. A DataFrame of more than `rows` rows is refused."""
    if isinstance(value, DataFrame):
        found = [r.asDict(recursive=True) for r in value.limit(rows + 1).collect()]
        if len(found) > rows:
            raise ValueError(f"more than {rows} rows; write them with jsonl")
        value = found
    body = yaml.safe_dump(value, sort_keys=False, allow_unicode=True) if path.endswith((".yaml", ".yml")) else json.dumps(value, indent=2, ensure_ascii=False, default=str)
    _put(spark, path, body)


def _put(spark: SparkSession, path: str, body: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()


def run_dir(spark: SparkSession, base: str, settings: dict | None = None, prefix: str = "run", now: datetime | None = None) -> str:
    """SK7: a new folder named by the time, with a snapshot of the settings; a file `latest` beside it names it, since stores have no links."""
    name = f"{prefix}_{(now or datetime.now(UTC)).strftime('%Y%m%d_%H%M%S')}"
    path = f"{base.rstrip('/')}/{name}"
    small(spark, settings or {}, f"{path}/config_snapshot.json")
    _put(spark, f"{base.rstrip('/')}/latest", name)
    return path


def latest(spark: SparkSession, base: str) -> str:
    """The folder that run_dir made last."""
    return f"{base.rstrip('/')}/{spark.read.text(base.rstrip('/') + '/latest').first()['value']}"


def report(metrics: DataFrame, buckets: DataFrame, chapters: DataFrame) -> str:
    """SK8: Markdown of one metrics row, the error buckets and the ten largest chapters."""
    m = metrics.first().asDict()
    lines = ["# Evaluation", "", "| metric | value |", "|---|---|", *[f"| {k} | {v:.3f} |" if isinstance(v, float) else f"| {k} | {v:,} |" for k, v in m.items()], "", "| error | rows |", "|---|---|"]
    lines += [f"| {r['bucket']} | {r['n']:,} |" for r in buckets.orderBy(F.desc("n"), "bucket").collect()]
    lines += ["", "| chapter | rows | exact |", "|---|---|---|", *[f"| {r['chapter']} | {r['total']:,} | {r['exact_match']:.1%} |" for r in chapters.orderBy(F.desc("total"), "chapter").limit(10).collect()]]
    return "\n".join(lines) + "\n"
