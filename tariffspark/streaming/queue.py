"""The incremental work queue as a stream: what arrives is processed once; stopping and resuming is the checkpoint's job."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that were seen are state on the executors' disks and in the checkpoint, not in memory.
_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def _state_store(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def once(rows: DataFrame, keys: list[str], ts: str | None = None, within: str | None = None) -> DataFrame:
    """Each key once over the whole stream. The keys seen are keyed state, so that a batch costs its own rows and not those before it;
    with a time column, state is dropped `within` an interval after a key's time, and later repeats count as new."""
    if ts and within:
        return rows.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)
    return rows.dropDuplicates(keys)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def process_new(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], keys: list[str], work: list[str] | None = None, ts: str | None = None, within: str | None = None) -> None:
    """Run `step` over the files that came since the last call and append its rows, each key once.

    work: the key of a piece of work in the source; what came before under it is not handed to `step` again, which may be dear.
    Each batch has a folder of its own, batch=<id>, which a repeated try overwrites whole; so a batch that was half written is
    not half repeated. The sink is not read, but for a run whose checkpoint is lost: all files come again then, and what the
    sink has is left out of that run.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    fresh = once(step(once(stream, work, ts, within) if work else stream), keys)

    recovering = _exists(spark, sink) and not _exists(spark, f"{checkpoint}/offsets")

    def write(batch: DataFrame, batch_id: int) -> None:
        if recovering:
            batch = batch.join(spark.read.parquet(sink).where(F.col("batch") != batch_id).select(*keys), keys, "left_anti")
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    with _state_store(spark):
        fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Beyond the reference: counts and sums by window and type, for batch and stream alike."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
