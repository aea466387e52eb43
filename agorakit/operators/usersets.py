"""Active users from stored sets: one bitmap of user numbers a day and stretch of numbers, which merge into weeks and months.

A load reads its own events only: users it has not met get the next numbers, and its days get their bitmaps. Sets of a day from several
loads are united when they are read, so a day may come in parts, late or twice. Users of a month are the union of its days, users that stay
are in the intersection of two months, and users of a population in the intersection with its set; no event is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorakit.functions.exprs import month_of
from agorakit.session import cut
from agorakit.sources.published import Pointers

#: Parts of the users' hash in which new users are numbered, one row each in the prefix sum.
PARTS = 1_024
#: Parts of a month, or of the numbering, above which a load writes it anew.
MOST_PARTS = 64
#: Sets of 4 KiB in a file.
FILE_SETS = 1_024
SETS = "day date, stretch bigint, users binary"


def _number(users: DataFrame, before: int) -> DataFrame:
    """(user_id, number) without gaps from before + 1 on, for different users; a part is a task's work and no task has all."""
    parted = users.withColumn("_part", F.pmod(F.xxhash64("user_id"), F.lit(PARTS)))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # PARTS rows at most
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("user_id"))
    return parted.withColumn("_in", inside).join(bases, "_part").select("user_id", (F.lit(before) + F.col("_base") + F.col("_in")).alias("number"))


def set_of(numbered: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of the column number: by, stretch, users."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    return numbered.groupBy(*by, F.bitmap_bucket_number("number").alias("stretch")).agg(bits)


class UserSets:
    """Sets of the users of each day under a folder. Load numbers must grow; a load that runs again changes nothing.

    Sets are stored by day, in a folder for each month and load. A pointer names the loads that hold each month and those that hold user numbers, so
    that both become current at once. A month, or the numbering, in ``most`` parts is written anew by the next load that adds to it, so loads
    of a day each never read a stored set. Events without a user or a day are in no set.
    """

    def __init__(self, path: str, user_type: T.DataType | None = None, most: int = MOST_PARTS):
        self.path, self.most = path.rstrip("/"), most
        self.numbering = T.StructType([T.StructField("user_id", user_type or T.StringType()), T.StructField("number", T.LongType())])

    def _current(self, spark: SparkSession) -> tuple[int, dict]:
        return Pointers(spark, self.path).current() or (-1, {"months": {}, "numbers": [], "users": 0})

    def _sets(self, spark: SparkSession, months: dict[str, list[int]]) -> DataFrame:
        places = [f"{self.path}/versions/load={n}/_month={month}" for month, loads in months.items() for n in loads]
        return spark.read.schema(SETS).parquet(*places) if places else spark.createDataFrame([], SETS)

    def _numbers(self, spark: SparkSession, loads: list[int]) -> DataFrame:
        places = [f"{self.path}/numbers/load={n}" for n in loads]
        return spark.read.schema(self.numbering).parquet(*places) if places else spark.createDataFrame([], self.numbering)

    def load(self, events: DataFrame, load: int, at: str = "activity_date") -> list[str]:
        """Add the users of the events' days, and return these days."""
        spark = events.sparkSession
        last, said = self._current(spark)
        if last >= load:
            return []
        seen = events.select(F.to_date(at).alias("day"), F.col("user_id").cast(self.numbering["user_id"].dataType).alias("user_id"))
        seen = cut(seen.dropna().distinct(), "user-days")
        days = sorted(r["day"].isoformat() for r in seen.select("day").distinct().collect())  # the days of one load

        known = self._numbers(spark, said["numbers"])
        new = _number(seen.select("user_id").distinct().join(known, "user_id", "left_anti"), said["users"])
        anew = len(said["numbers"]) >= self.most
        (known.unionByName(new) if anew else new).write.mode("overwrite").parquet(f"{self.path}/numbers/load={load}")
        numbers = [load] if anew else [*said["numbers"], load]
        users = self._numbers(spark, [load]).count() + (0 if anew else said["users"])

        months = sorted({day[:7] for day in days})
        crowded = [m for m in months if len(said["months"].get(m, [])) >= self.most]
        sets = set_of(seen.join(self._numbers(spark, numbers), "user_id"), "day")
        if crowded:
            stored = self._sets(spark, {m: said["months"][m] for m in crowded})
            sets = union_by(sets.unionByName(stored), F.col("day").alias("day"))
        # A file holds FILE_SETS stretches of a month's days at most.
        dealt = sets.withColumn("_month", F.date_format("day", "yyyy-MM")).repartition("_month", F.floor(F.col("stretch") / FILE_SETS))
        dealt.write.mode("overwrite").partitionBy("_month").parquet(f"{self.path}/versions/load={load}")
        held = {m: [load] if m in crowded else [*said["months"].get(m, []), load] for m in months}
        pointers = Pointers(spark, self.path)
        pointers.set(load, {"months": said["months"] | held, "numbers": numbers, "users": users})
        pointers.tidy()
        return days

    def numbers(self, spark: SparkSession) -> DataFrame:
        """user_id and number of all users met so far."""
        return self._numbers(spark, self._current(spark)[1]["numbers"])

    def read(self, spark: SparkSession, first: str | None = None, last: str | None = None) -> DataFrame:
        """day, stretch, users of the days from first to last; only files of their months are read."""
        months = self._current(spark)[1]["months"]
        wanted = {m: loads for m, loads in months.items() if (first is None or m >= first[:7]) and (last is None or m <= last[:7])}
        sets = self._sets(spark, wanted)
        for bound, keep in ((first, F.col("day") >= F.to_date(F.lit(first))), (last, F.col("day") <= F.to_date(F.lit(last)))):
            sets = sets if bound is None else sets.where(keep)
        return union_by(sets, F.col("day").alias("day"))

    def population(self, users: DataFrame) -> DataFrame:
        """stretch and users of those users that have a number."""
        return set_of(users.select("user_id").distinct().join(self.numbers(users.sparkSession), "user_id"))


def union_by(sets: DataFrame, *by: Column) -> DataFrame:
    """One set for each value of by."""
    return sets.groupBy(*by, "stretch").agg(F.bitmap_or_agg("users").alias("users"))


def by_month(sets: DataFrame) -> DataFrame:
    return union_by(sets, month_of(F.col("day")).alias("metric_month"))


def within(sets: DataFrame, population: DataFrame) -> DataFrame:
    """Sets without the users that are not in the population; sets have one row for each key and stretch."""
    keys = [c for c in sets.columns if c != "users"]
    met = sets.join(population.withColumnRenamed("users", "_these"), "stretch")
    each = met.select(*keys, F.explode(F.array("users", "_these")).alias("users"))
    return each.groupBy(*keys).agg(F.bitmap_and_agg("users").alias("users"))


def sizes(sets: DataFrame, key: str, name: str) -> DataFrame:
    """The number of users of each set; sets without users have no row."""
    return sets.groupBy(key).agg(F.sum(F.bitmap_count("users")).alias(name)).where(F.col(name) > 0)


def retained_by_month(months: DataFrame) -> DataFrame:
    """Users of each month that were also active in the month before: metric_month, retained_from_prev (0 if there are none)."""
    before = months.select(F.add_months("metric_month", 1).alias("metric_month"), "stretch", F.col("users").alias("_these"))
    met = months.join(before, ["metric_month", "stretch"], "left")
    none = F.when(F.col("_these").isNotNull(), F.array("users", "_these"))
    kept = met.select("metric_month", "stretch", F.explode_outer(none).alias("users"))
    kept = kept.groupBy("metric_month", "stretch").agg(F.when(F.count("users") > 0, F.bitmap_count(F.bitmap_and_agg("users"))).otherwise(0).alias("_n"))
    return kept.groupBy("metric_month").agg(F.sum("_n").cast("bigint").alias("retained_from_prev"))
