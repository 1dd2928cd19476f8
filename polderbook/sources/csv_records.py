"""CSV records whose quoted values may hold line breaks, read in parallel.

Lines are read block by block as the file splits fall, so a record may be cut by a line
break inside quotes, and even lie in two blocks. A line break ends a record only when an
even number of quotes stands before it in the file. The first pass counts the quotes of
every block; their prefix sums tell whether a block begins inside a value. Blocks that do
not and that hold no line with an odd number of quotes are records line by line and
are read as they are. In the others a task joins the lines of every record as it reads them,
in the order of the file. Only the pieces of records that lie in two blocks are shuffled, at
most two of a block; each joins the record that the last piece at an even count began.

A quote inside a value is doubled. A quote in an unquoted value breaks the rule above, as
it does for any reader. Empty lines are skipped; every file starts with the header.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from polderbook.sources.shared import with_known_size

FILE, BLOCK, ROW = "__file", "__block", "__row"
OPTIONS = {"escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its place; ids rise in file order within a block."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW), "value")


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines (file, block, row, value, quotes, inside) that come in the order of the file, block by block.

    ``opens`` is null for whole records, true for the piece that begins one, false for a piece that goes on with one.
    """
    names = [FILE, BLOCK, ROW, "record", "opens"]
    key, parity, last = None, 0, -1
    held: list[str] = []
    begun, first = False, 0
    loose: list[tuple] = []

    def release(closed: bool) -> None:
        if held:
            loose.append((*key, first, "\n".join(held), None if begun and closed else begun))
            held.clear()

    def take() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(
            zip(*loose), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)]
        loose.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks, rows = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        if rows[0] <= last or (np.diff(rows) <= 0).any():
            raise RuntimeError("lines out of order")
        last = rows[-1]
        other = blocks[1:] != blocks[:-1]
        other |= pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for at, end in zip(bounds, bounds[1:]):
            if key != (files[at].as_py(), int(blocks[at])):
                release(parity % 2 == 0)
                key, parity = (files[at].as_py(), int(blocks[at])), batch.column(5)[at].as_py()
            quotes = batch.column(4).slice(at, end - at).to_numpy().astype(np.int64)
            after = parity + np.cumsum(quotes)
            starts = np.flatnonzero((after - quotes) % 2 == 0)
            parity = int(after[-1])
            values = batch.column(3).slice(at, end - at)
            head = int(starts[0]) if len(starts) else end - at
            if head:
                if not held:
                    begun, first = False, int(rows[at])
                held.extend(values.slice(0, head).to_pylist())
            if not len(starts):
                continue
            release(True)
            if len(starts) > 1:
                some = values.slice(head, int(starts[-1]) - head)
                lists = pa.ListArray.from_arrays(pa.array((starts - head).astype(np.int32)), some)
                n = len(lists)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1], np.int64)), pa.array(rows[at + starts[:-1]]),
                     pc.binary_join(lists, "\n"), pa.nulls(n, pa.bool_())], names)
            begun, first = True, int(rows[at + starts[-1]])
            held.extend(values.slice(int(starts[-1])).to_pylist())
        if loose:
            yield take()
    release(parity % 2 == 0)
    if loose:
        yield take()


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, record): one row per record, placed at its first line."""
    lines = _lines(spark, path).withColumn("quotes", _quotes(F.col("value")))
    blocks = lines.groupBy(FILE, BLOCK).agg(
        F.sum("quotes").alias("all"), F.max(F.col("quotes") % 2).alias("odd"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    states = blocks.select(
        F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), "odd",
        F.coalesce(F.sum("all").over(earlier) % 2, F.lit(0)).alias("inside"))
    # one row per block that needs it, counted once
    broken = with_known_size(states.where("odd = 1 or inside = 1").select("file", "block", "inside"))
    here = (F.col(FILE) == F.col("file")) & (F.col(BLOCK) == F.col("block"))
    plain = lines.join(F.broadcast(broken), here, "left_anti").select(FILE, BLOCK, ROW, F.col("value").alias("record"))

    cut = lines.join(F.broadcast(broken), here).select(
        FILE, BLOCK, ROW, "value", F.col("quotes").cast("int").alias("quotes"), F.col("inside").cast("int").alias("inside"))
    found = cut.mapInArrow(_joined, f"{FILE} string, {BLOCK} bigint, {ROW} bigint, record string, opens boolean")
    once = found.where(F.col("opens").isNull()).select(FILE, BLOCK, ROW, "record")
    # at most two pieces of a block belong to records that other blocks begin or end
    place = F.struct(F.col(BLOCK).alias("block"), F.col(ROW).alias("row"))
    so_far = Window.partitionBy(FILE).orderBy(BLOCK, ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = found.where(F.col("opens").isNotNull()).withColumn(
        "start", F.last(F.when(F.col("opens"), place), ignorenulls=True).over(so_far))
    piece = F.struct(place.alias("place"), "record")
    whole = pieces.groupBy(FILE, "start").agg(F.sort_array(F.collect_list(piece)).alias("pieces")).select(
        FILE, F.col("start.block").alias(BLOCK), F.col("start.row").alias(ROW),
        F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"))
    return plain.unionByName(once).unionByName(whole).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


def _header(spark: SparkSession, rows: DataFrame) -> list[str]:
    first = rows.orderBy(FILE, BLOCK, ROW).select("record").first()
    if first is None:
        return []
    text = first["record"].removeprefix("\ufeff")
    width = max(1, text.count(",") + 1)
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(width)])
    parsed = spark.range(1).select(F.from_csv(F.lit(text), schema.simpleString()[7:-1].replace(":", " "), OPTIONS).alias("r")).first()["r"]
    names = list(parsed)
    while names and names[-1] is None:
        names.pop()
    return [n if n is not None else f"_c{i}" for i, n in enumerate(names)]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The columns of the header as text, then the place of the record: file, block, row."""
    rows = records(spark, path)
    names = _header(spark, rows)
    firsts = rows.where(F.col(BLOCK) == 0).groupBy(F.col(FILE).alias("file")).agg(F.min(ROW).alias("first"))
    # one row per file
    data = rows.join(F.broadcast(firsts), (F.col(FILE) == F.col("file")) & (F.col(BLOCK) == 0) & (F.col(ROW) == F.col("first")), "left_anti")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    if not names:
        return data.select(FILE, BLOCK, ROW)
    return data.select(F.from_csv("record", schema, OPTIONS).alias("r"), FILE, BLOCK, ROW).select("r.*", FILE, BLOCK, ROW)
