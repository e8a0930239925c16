"""A table with a key that upserts (SK4): hash buckets of the key, copied on write, under versions that a commit file names.

Each bucket lives in one folder, data/<version>/bucket=<k>. An upsert reads and rewrites the buckets that its rows touch, into
folders of a new version, and then commits a file that names the live folder of every bucket. The commit creates the file of
the next number and fails if that is there, so of two writers one starts over; a run that dies before it leaves the table as
it was, and its folders are swept later. Readers take the last commit and read whole folders: they never see half an upsert.

The driver holds one name a bucket. Rows without a key column's value are kept like others; nulls equal one another there.
Keys that repeat within the new rows are an error, as a table has each key once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; read again and try again."""


class KeyedTable:
    """The table at a path that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._to = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._to(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commits(self) -> list[int]:
        folder = self._to(f"{self.path}/commits")
        found = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        return sorted(int(f.getPath().getName()) for f in found if f.getPath().getName().isdigit())

    def _state(self, number: int | None = None) -> dict:
        numbers = self._commits()
        if not numbers:
            raise FileNotFoundError(f"no table at {self.path}")
        number = numbers[-1] if number is None else number
        body = "\n".join(r["value"] for r in self.spark.read.text(f"{self.path}/commits/{number}").collect())
        return {"number": number, **json.loads(body)}

    def _commit(self, number: int, state: dict) -> None:
        """Written beside its place and renamed to it, which fails where another writer was first."""
        place, draft = self._to(f"{self.path}/commits/{number}"), self._to(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        self._fs.mkdirs(place.getParent())
        if self._fs.exists(place) or not self._fs.rename(draft, place):
            raise ConcurrentWrite(f"commit {number} of {self.path} exists")

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> KeyedTable:
        """A new table of rows, whose keys are unique."""
        own = cls(rows.sparkSession, path)
        if own._commits():
            raise FileExistsError(f"there is a table at {path}")
        state = {"keys": keys, "buckets": buckets, "schema": rows.schema.json(), "live": {}}
        own._commit(1, state | {"live": own._written(own._bucketed(rows, state))})
        return own

    @staticmethod
    def _bucketed(rows: DataFrame, state: dict) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*state["keys"]), F.lit(state["buckets"])).cast("int"))

    def _written(self, rows: DataFrame) -> dict[str, str]:
        """bucket -> the folder of a new version that has its rows."""
        version = f"data/{uuid.uuid4().hex}"
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{version}")
        names = [f.getPath().getName() for f in self._fs.listStatus(self._to(f"{self.path}/{version}"))]
        return {n.removeprefix("bucket="): f"{version}/{n}" for n in names if n.startswith("bucket=")}

    def read(self, number: int | None = None) -> DataFrame:
        """The rows after the last commit, or after an earlier one whose folders are not swept yet."""
        state = self._state(number)
        return self._rows(state, state["live"])

    def _rows(self, state: dict, live: dict[str, str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"]))
        folders = [f"{self.path}/{f}" for f in live.values()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def upsert(self, rows: DataFrame, stamp: str | None = None) -> int:
        """Rows replace those of their key; columns that they lack are null, and `stamp` names one that gets the time of the run.

        The number of the commit. The rows are worked out once, into the folders of the new version.
        """
        state = self._state()
        new = rows.withColumn(stamp, F.current_timestamp()) if stamp else rows
        fields = StructType.fromJson(json.loads(state["schema"])).fields
        new = new.select(*[(F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        staged = self._written(self._bucketed(new, state))
        fresh = self._rows(state, staged)
        if fresh.groupBy(*state["keys"]).count().where("count > 1").limit(1).count():
            raise ValueError("a key comes more than once in the new rows")
        touched = {k: f for k, f in state["live"].items() if k in staged}
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in state["keys"]]
        kept = self._rows(state, touched).alias("old").join(fresh.select(*state["keys"]).alias("new"), same, "left_anti")
        merged = self._written(self._bucketed(kept.unionByName(fresh), state))
        self._commit(state["number"] + 1, {k: v for k, v in state.items() if k != "number"} | {"live": state["live"] | merged})
        return state["number"] + 1

    def sweep(self) -> int:
        """Delete folders that the last commit does not name, of old versions and of runs that died; not while another run writes."""
        live = set(self._state()["live"].values())
        gone = 0
        for version in self._fs.listStatus(self._to(f"{self.path}/data")):
            for folder in self._fs.listStatus(version.getPath()):
                name = f"data/{version.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and name not in live:
                    self._fs.delete(folder.getPath(), True)
                    gone += 1
        return gone
