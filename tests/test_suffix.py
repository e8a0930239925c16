"""Completion of codes where most predictions have none or the same."""

from collections import Counter

from pyspark.sql import functions as F

from tariffspark.operators import suffix


def test_no_task_gets_all_rows_of_a_code(spark):
    """40 % without a code and 30 % of one: right reasons, and no partition of the join has more than a tenth of the rows."""
    n = 20_000
    k = F.col("seq") % 10
    code = F.format_string("%08d%02d", F.col("seq") % 997, F.col("seq") % 3 * 10)
    preds = spark.range(n).select(F.col("id").alias("seq"), (F.col("id") % 10 == 0).alias("pred_abstain"))
    preds = preds.withColumn("pred", F.when(k == 0, "0000.00.0000").when(k.isin(1, 2, 3), None).when(k.isin(4, 5, 6), "9900").when(k == 7, F.concat(F.substring(code, 1, 8), F.lit("99"))).when(k == 8, "").otherwise(code))
    idx = spark.range(2_991).select(F.format_string("%08d%02d", F.col("id") % 997, F.floor(F.col("id") / 997) * 10).alias("code"), (F.col("id") % 7 + 1).alias("n"))
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        done = suffix.complete(preds, idx).withColumn("at", F.spark_partition_id()).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    codes = {r.code: r.n for r in idx.collect()}
    first = {}
    for c, often in sorted(codes.items(), key=lambda x: (-x[1], x[0])):
        first.setdefault(c[:8], c)
    assert len(done) == n
    for r in done:
        full = (r.pred or "").replace(".", "").ljust(10, "0")
        best = first.get(full[:8])
        want = "skipped_abstain" if r.pred_abstain else "skipped_no_code" if not r.pred else "valid" if full in codes else "no_8digit_match" if best is None else "completed"
        assert (r.reason, r.pred_after) == (want, f"{best[:4]}.{best[4:6]}.{best[6:]}" if want == "completed" else r.pred)
    assert set(Counter(r.reason for r in done)) == {"skipped_abstain", "skipped_no_code", "valid", "no_8digit_match", "completed"}
    assert max(Counter(r.at for r in done).values()) < n / 10
