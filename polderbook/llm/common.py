"""What the operators share: inputs, word normalisation, scratch tables and size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polderbook.sources.shared import working_folder

#: A join side is broadcast only when its files are known to be no larger than this.
BROADCAST_BYTES = 16 << 20

NOT_A_WORD = r"[^\p{L}\p{M}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_line(text: Column) -> Column:
    """Lower-case words of a text, one space between them; empty when it has none."""
    return F.trim(F.regexp_replace(F.lower(text), NOT_A_WORD, " "))


class Scratch:
    """Intermediate tables of one operator call, in the folder that all executors share.

    A written table cuts the lineage without tying the rows to an executor, and
    its size on disk is known to later joins. ``drop`` removes tables that no
    returned frame reads; the others stay until the shared folder is cleared.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = working_folder(spark, purpose)

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")

    def bytes(self, name: str) -> int:
        path, fs = self._path(name)
        return fs.getContentSummary(path).getLength()

    def small(self, frame: DataFrame, name: str, limit: int = BROADCAST_BYTES) -> DataFrame:
        """``frame`` written as ``name``, with a broadcast hint if its files are at most ``limit`` bytes.

        Beyond that Spark shuffles both sides and splits a hot key.
        """
        written = self.write(frame, name)
        return F.broadcast(written) if self.bytes(name) <= limit else written

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = self._path(name)
            fs.delete(path, True)


def numbered(rows: DataFrame, group: str, keys: list[Column], scratch: Scratch, name: str, **sums: str) -> DataFrame:
    """``rows`` with ``place``, counted from 0 within ``group``, and ``total``, the rows of the group.

    ``keys`` order the rows and must begin with what orders the groups. Rows are range
    partitioned and sorted once; a task numbers its own rows and the counts of the tasks
    before it are added, so a group may spread over any number of tasks. ``sums`` adds
    columns with the sum of a column over the whole group. Keep ``rows`` narrow. The
    tables ``name`` and ``name-parts`` stay until the caller drops them.
    """
    placed = scratch.write(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()),
        name,
    )
    parts = placed.groupBy(group, F.shiftright("at", 33).alias("part")).agg(
        F.min("at").alias("first"), F.count("*").alias("n"), *[F.sum(c).alias(out) for out, c in sums.items()])
    whole = Window.partitionBy(group)
    ahead = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = scratch.write(parts.select(
        F.col(group).alias("of"), "part", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("total"), *[F.sum(out).over(whole).alias(out) for out in sums],
    ), f"{name}-parts")
    here = (F.shiftright("at", 33) == F.col("part")) & F.col(group).eqNullSafe(F.col("of"))
    return placed.join(plan, here).withColumn("place", F.col("at") + F.col("shift")).drop("at", "shift", "part", "of")
