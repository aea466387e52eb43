"""Tables in versions: data is written beside the current version, and a small pointer file that is written last makes it current.

``versions/`` under the table's folder holds the data and ``pointers/`` numbered files that name what is current. Nothing that readers may use is
renamed or overwritten: a writer that dies leaves a version without a pointer, or a pointer without its end, which readers pass over. The
newest two versions are kept for readers that resolved the one before; older ones are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT = 2
#: Buckets of a keyed table; a manifest has one entry for each.
BUCKETS = 64
#: Parts of a day above which a batch writes the day anew.
MOST_PARTS = 16


class Pointers:
    """The numbered pointer files of one table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = f"{folder.rstrip('/')}/pointers"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._read = lambda at: spark._jvm.org.apache.commons.io.IOUtils.toString(self.files.open(at), "UTF-8")

    def numbers(self) -> list[int]:
        """Numbers of the pointer files, also of unfinished ones, in order."""
        found = self.files.globStatus(self._path(f"{self.folder}/*.json")) or []
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)

    def get(self, number: int) -> dict | None:
        """What a pointer says, or None if it was not written to its end."""
        text = self._read(self._path(f"{self.folder}/{number:012d}.json"))
        return json.loads(text) if text.endswith("\n") else None

    def current(self) -> tuple[int, dict] | None:
        for number in reversed(self.numbers()):
            said = self.get(number)
            if said is not None:
                return number, said
        return None

    def set(self, number: int, said: dict) -> None:
        """Create a pointer file. A finished one with this number raises an error; an unfinished one is replaced."""
        at = self._path(f"{self.folder}/{number:012d}.json")
        unfinished = self.files.exists(at) and self.get(number) is None
        out = self.files.create(at, unfinished)
        out.write(bytearray((json.dumps(said) + "\n").encode()))
        out.close()

    def remove(self, path: str) -> None:
        self.files.delete(self._path(path), True)

    def tidy(self) -> list[dict]:
        """Remove all but the newest pointers, and return what the removed ones said."""
        whole = [(n, said) for n in self.numbers() if (said := self.get(n)) is not None]
        for number, _ in whole[:-KEPT]:
            self.remove(f"{self.folder}/{number:012d}.json")
        return [said for _, said in whole[:-KEPT]]


def publish(df: DataFrame, path: str, *, keep_old_if_empty: bool = True, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Make a frame the current version of the table at ``path`` and return its rows. Empty input leaves the old version unless told otherwise.

    The frame is computed once and counted on the way.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name, seen = uuid.uuid4().hex, Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/versions/{name}")
    rows, pointers = int(seen.get["rows"]), Pointers(spark, path)
    if not rows and keep_old_if_empty:
        pointers.remove(f"{path}/versions/{name}")
        return 0
    pointers.set(max(pointers.numbers(), default=-1) + 1, {"version": name, "format": fmt})
    for old in pointers.tidy():
        pointers.remove(f"{path}/versions/{old['version']}")
    return rows


def is_published(spark: SparkSession, path: str) -> bool:
    return Pointers(spark, path).current() is not None


def read_published(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The current version of a table. One that was never published raises an error."""
    found = Pointers(spark, path).current()
    if found is None:
        raise FileNotFoundError(f"no version of {path} is published")
    reader = spark.read.format(found[1]["format"])
    return (reader.schema(schema) if schema else reader).load(f"{path.rstrip('/')}/versions/{found[1]['version']}")


def _newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in (*keys, "_in")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, "_in")).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns if c != "_in"])


class KeyedTable:
    """A table with one row for each key, in buckets of the keys' hash. A batch rewrites the buckets that its keys are in, and no others.

    A pointer holds the manifest: for each bucket the batch that wrote it last. A batch that runs again after its pointer was set
    changes nothing, and before that it writes its own folder anew from the same manifest, so the result is the same. Batch numbers
    must grow; a table belongs to one stream checkpoint or one sequence of loads.

    With ``order`` the row with the largest value of it stays, whether it is stored or comes in (of equals the one that comes in; null is the
    smallest); without, the row that comes in. Of a batch's own rows for a key without ``order`` any one stays. Null keys are keys.
    """

    def __init__(self, path: str, keys: Sequence[str], schema: T.StructType, order: str | None = None, buckets: int = BUCKETS):
        self.path, self.keys, self.schema, self.order, self.buckets = path.rstrip("/"), list(keys), schema, order, buckets

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _rows(self, spark: SparkSession, manifest: dict, only: set[int] | None = None) -> DataFrame:
        places = [f"{self.path}/versions/batch={batch}/_bucket={b}" for b, batch in manifest.get("buckets", {}).items() if only is None or int(b) in only]
        return spark.read.schema(self.schema).parquet(*places) if places else spark.createDataFrame([], self.schema)

    def merge(self, batch: DataFrame, number: int) -> list[int]:
        """Merge a batch and return the buckets that it rewrote."""
        spark, pointers = batch.sparkSession, Pointers(batch.sparkSession, self.path)
        found = pointers.current()
        if found and found[0] >= number:
            return []
        manifest = found[1] if found else {"buckets": {}, "of": self.buckets}
        bucket = self._bucket(manifest["of"])
        batch = batch.select(*self.schema.names)
        touched = sorted(r[0] for r in batch.select(bucket).distinct().collect())  # at most as many as there are buckets
        stored = self._rows(spark, manifest, set(touched))
        rows = stored.withColumn("_in", F.lit(0)).unionByName(batch.withColumn("_in", F.lit(1)))
        merged = _newest(rows, self.keys, [self.order] if self.order else [])
        # A bucket is written by as many tasks as its keys are dealt to.
        merged.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/versions/batch={number}")
        pointers.set(number, {"of": manifest["of"], "buckets": manifest["buckets"] | {str(b): number for b in touched}})
        self._clear(spark, pointers)
        return touched

    def _clear(self, spark: SparkSession, pointers: Pointers) -> None:
        gone = {(b, n) for said in pointers.tidy() for b, n in said["buckets"].items()}
        used = {(b, n) for k in pointers.numbers() for b, n in (pointers.get(k) or {"buckets": {}})["buckets"].items()}
        for b, n in gone - used:
            pointers.remove(f"{self.path}/versions/batch={n}/_bucket={b}")

    def read(self, spark: SparkSession) -> DataFrame:
        found = Pointers(spark, self.path).current()
        return self._rows(spark, found[1] if found else {})


class DayLog:
    """Distinct rows with a day each. A batch compares its rows with those of its own days only and adds the new ones in a folder of its own.

    The manifest names for each day the batches that have rows of it and counts its rows. A day in more than ``most`` parts is written anew by the
    batch that finds it so. Rows without a day are one day.
    """

    def __init__(self, path: str, schema: T.StructType, day: str, most: int = MOST_PARTS):
        self.path, self.schema, self.day, self.most = path.rstrip("/"), schema, day, most

    def _rows(self, spark: SparkSession, days: dict, only: Sequence[str] | None = None) -> DataFrame:
        wanted = days if only is None else {d: days[d] for d in only if d in days}
        places = [f"{self.path}/versions/batch={n}/_part={day}" for day, said in wanted.items() for n in said["batches"]]
        return spark.read.schema(self.schema).parquet(*places) if places else spark.createDataFrame([], self.schema)

    def merge(self, batch: DataFrame, number: int) -> list[str]:
        """Add a batch and return the folders of earlier batches that it read."""
        spark, pointers, names = batch.sparkSession, Pointers(batch.sparkSession, self.path), self.schema.names
        found = pointers.current()
        if found and found[0] >= number:
            return []
        days = found[1]["days"] if found else {}
        part = F.coalesce(F.col(self.day).cast("string"), F.lit("none"))
        rows = batch.select(*names).distinct()
        mine = [r[0] for r in rows.select(part).distinct().collect()]  # the days of one batch
        known = [d for d in mine if d in days]
        crowded = [d for d in known if len(days[d]["batches"]) >= self.most]
        before = self._rows(spark, days, known)
        match = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in names]  # null values are values
        new = rows.alias("n").join(before.alias("o"), match, "left_anti")
        if crowded:
            new = new.unionByName(self._rows(spark, days, crowded))
        folder = f"{self.path}/versions/batch={number}"
        new.withColumn("_part", part).write.mode("overwrite").partitionBy("_part").parquet(folder)
        added = {r[0]: r["n"] for r in spark.read.schema(self.schema).parquet(folder).groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
        after = dict(days)
        for day, n in added.items():
            old = days.get(day) if day not in crowded else None
            after[day] = {"batches": [*(old["batches"] if old else []), number], "rows": n + (old["rows"] if old else 0)}
        pointers.set(number, {"days": after})
        pointers.tidy()
        return [f"batch={n}/_part={d}" for d in known for n in days[d]["batches"]]

    def read(self, spark: SparkSession) -> DataFrame:
        found = Pointers(spark, self.path).current()
        return self._rows(spark, found[1]["days"] if found else {})
