"""A database table as ranges of its key (SC8), read by Spark's Python data source interface.

    spark.dataSource.register(KeysetSource)
    spark.read.format("keyset").schema(...).options(connect="package.module:function", table=..., key=..., ranges=16).load()

`connect` names a function without arguments that opens a DB-API connection; driver and executors import it. The key may be of
any ordered type, texts included: the database itself cuts it into ranges of like many rows, whose first keys are all that the
driver sees. A range is read by pages that begin behind the last key of the page before (a keyset), so a page costs its own
rows wherever it is, and a task that is tried again reads its range again. Rows without a key are a range of their own.
The columns are those of the schema, and keys are unique. An empty table has no rows. `mark` is the driver's place holder.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

PAGE = 5000


class Range(InputPartition):
    """Keys from `low` (included) up to `high` (excluded, None: no bound); not keyed: null keys."""

    def __init__(self, low=None, high=None, keyed: bool = True):
        super().__init__((low, high, keyed))
        self.low, self.high, self.keyed = low, high, keyed


class KeysetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyset"

    def schema(self) -> str:
        raise ValueError("give the schema of the columns to read")

    def reader(self, schema: StructType) -> KeysetReader:
        return KeysetReader(schema, self.options)


class KeysetReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.columns, self.table, self.key = list(schema.names), options["table"], options["key"]
        self.connect, self.mark = options["connect"], options.get("mark", "?")
        self.ranges, self.page = int(options.get("ranges", 8)), int(options.get("page", PAGE))

    def _open(self):
        module, _, function = self.connect.partition(":")
        return getattr(importlib.import_module(module), function)()

    def partitions(self) -> list[Range]:
        connection = self._open()
        try:
            rows = connection.cursor()
            rows.execute(f"SELECT min({self.key}) FROM (SELECT {self.key}, ntile({self.ranges}) OVER (ORDER BY {self.key}) AS part FROM {self.table} WHERE {self.key} IS NOT NULL) q GROUP BY part ORDER BY part")
            low = [r[0] for r in rows.fetchall()]
        finally:
            connection.close()
        return [*(Range(a, b) for a, b in zip(low, [*low[1:], None], strict=False)), Range(keyed=False)]

    def read(self, partition: Range) -> Iterator[tuple]:
        connection = self._open()
        names = ", ".join([*self.columns, self.key])
        try:
            rows = connection.cursor()
            if not partition.keyed:
                rows.execute(f"SELECT {names} FROM {self.table} WHERE {self.key} IS NULL")
                while page := rows.fetchmany(self.page):
                    yield from (tuple(r[:-1]) for r in page)
                return
            last, first = partition.low, True
            while True:
                bound, values = f"{self.key} {'>=' if first else '>'} {self.mark}", [last]
                if partition.high is not None:
                    bound, values = f"{bound} AND {self.key} < {self.mark}", [last, partition.high]
                rows.execute(f"SELECT {names} FROM {self.table} WHERE {bound} ORDER BY {self.key} LIMIT {self.page}", values)
                page = rows.fetchall()
                yield from (tuple(r[:-1]) for r in page)
                if len(page) < self.page:
                    return
                last, first = page[-1][-1], False
        finally:
            connection.close()
