"""The keyed table and the stream's state: upserts that touch few files, runs that die, resumed streams."""

import os
import random

import pytest

from tariffspark.sources.keyed import ConcurrentWrite, KeyedTable
from tariffspark.streaming import queue


def test_upserts_against_a_dictionary(spark, tmp_path):
    rng = random.Random(2)
    rows = {k: f"v{k}" for k in range(1000)}
    table = KeyedTable.create(spark.createDataFrame(list(rows.items()), "k int, v string"), (tmp_path / "t").as_uri(), ["k"], buckets=32)
    first = table._state()["live"]
    for n in range(3):
        new = {rng.randrange(1200): f"n{n}" for _ in range(3)}
        table.upsert(spark.createDataFrame(list(new.items()), "k int, v string"))
        rows |= new
        assert {r.k: r.v for r in table.read().collect()} == rows and table.read().count() == len(rows)
    changed = {k for k, f in table._state()["live"].items() if f != first[k]}
    assert 0 < len(changed) <= 9  # of 32 buckets, after three upserts of three rows
    assert {r.k: r.v for r in table.read(1).collect()} == {k: f"v{k}" for k in range(1000)}
    assert table.sweep() > 0 and {r.k: r.v for r in table.read().collect()} == rows


def test_a_dead_run_leaves_the_table(spark, tmp_path, monkeypatch):
    table = KeyedTable.create(spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string"), (tmp_path / "t").as_uri(), ["k"], buckets=4)

    def die(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(KeyedTable, "_commit", die)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(spark.createDataFrame([(1, "z")], "k int, v string"))
    monkeypatch.undo()
    assert sorted((r.v for r in table.read().collect())) == ["a", "b"]
    # of two writers that start from one commit, the second fails
    state = table._state()
    table.upsert(spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string"))
    monkeypatch.setattr(table, "_state", lambda number=None: state)
    with pytest.raises(ConcurrentWrite):
        table.upsert(spark.createDataFrame([(1, "z")], "k int, v string"))
    monkeypatch.undo()
    assert sorted((str(r.k), r.v) for r in table.read().collect()) == [("1", "a"), ("2", "d"), ("None", "c")]
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(5, "e"), (5, "f")], "k int, v string"))
    with pytest.raises(FileExistsError):
        KeyedTable.create(table.read(), (tmp_path / "t").as_uri(), ["k"])


def test_stream_state(spark, tmp_path):
    """Work seen in earlier runs is not handed to the step again, though the sink is gone; a batch that failed is repeated whole."""
    source, sink, checkpoint, log = (str(tmp_path / n) for n in ("in", "out", "cp", "log"))
    schema = "k int, v string"

    def step(df):
        def logged(batches):
            for b in batches:
                with open(log, "a") as f:
                    f.writelines(f"{k}\n" for k in b["k"])
                if os.path.exists(log + ".fail"):
                    raise OSError("stopped")
                yield b

        return df.mapInPandas(logged, schema)

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        queue.process_new(spark, source, schema, sink, checkpoint, step, ["k"], work=["k"])

    def seen():
        with open(log) as f:
            return sorted(map(int, f.read().split()))

    arrive((1, "a"), (2, "b"), (2, "b"))
    run()
    os.rename(sink, sink + ".moved")
    arrive((2, "again"), (3, "c"))
    run()
    assert seen() == [1, 2, 3] and [(r.k, r.v) for r in spark.read.parquet(sink).collect()] == [(3, "c")]
    arrive((4, "d"), (1, "again"))
    open(log + ".fail", "w").close()
    with pytest.raises(Exception, match="stopped"):
        run()
    os.remove(log + ".fail")
    run()
    assert seen() == [1, 2, 3, 4, 4] and sorted(r.k for r in spark.read.parquet(sink).collect()) == [3, 4]
    run()
    assert seen() == [1, 2, 3, 4, 4]
