"""The keyset source against a small local database."""

import random
import sqlite3
import sys

from tariffspark.sources.keyset import KeysetReader, KeysetSource


def test_ranges_and_pages(spark, tmp_path):
    rng = random.Random(6)
    rows = [(f"N{k:05d}" if rng.random() < 0.5 else f"H{k * 7:06d}", k, None if k % 9 == 0 else f"text {k}") for k in range(1003)]
    rows += [(None, -1, "no key"), (None, -2, None)]
    path = str(tmp_path / "rulings.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE rulings (ruling_number TEXT UNIQUE, n INTEGER, body TEXT)")
        db.execute("CREATE TABLE empty_one (ruling_number TEXT, n INTEGER, body TEXT)")
        db.executemany("INSERT INTO rulings VALUES (?, ?, ?)", rng.sample(rows, len(rows)))
    (tmp_path / "own_database.py").write_text(f"import sqlite3\ndef opened():\n    return sqlite3.connect({path!r})\n")
    spark.sparkContext.addPyFile(str(tmp_path / "own_database.py"))
    sys.path.insert(0, str(tmp_path))
    spark.dataSource.register(KeysetSource)
    options = {"connect": "own_database:opened", "key": "ruling_number", "ranges": "5", "page": "64"}
    read = lambda t: spark.read.format("keyset").schema("ruling_number string, n int, body string").options(table=t, **options).load()
    found = read("rulings")
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(rows, key=str)
    assert read("empty_one").count() == 0

    class Schema:
        names = ["n"]

    reader = KeysetReader(Schema, options | {"table": "rulings"})
    ranges = reader.partitions()
    sizes = [len(list(reader.read(r))) for r in ranges]
    assert sizes[-1] == 2 and sum(sizes) == len(rows) and max(sizes[:-1]) - min(sizes[:-1]) <= 1
    by_number = {n: k for k, n, _ in rows}
    for r in ranges[:-1]:
        keys = [by_number[n] for (n,) in reader.read(r)]
        assert keys == sorted(keys)
