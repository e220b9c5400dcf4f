"""CSV files cut into records by many tasks, line breaks inside cells included.

Whether a line break ends a record depends on the quotes before it, back to the start of
the file. A task that reads a byte range does not know them, so it states for both cases
(the range begins outside or inside a cell in quotes) how its blocks of lines end. These
few values per range are put together in file order, after which every block is cut into
records on its own; a record that crosses blocks is joined from its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replivote.session import written

#: Bytes of lines that are handled as one row.
BLOCK = 1 << 20
#: Origin of a record that was begun before the byte range.
_BEFORE = -1
_BLOCKS = (
    "file string, start long, n int, lines binary, inside0 boolean, inside1 boolean, origin0 int, origin1 int, "
    "after0 boolean, after1 boolean, left0 int, left1 int"
)


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line ends inside a cell in quotes, given whether it begins inside one.

    A cell is in quotes if its first character is one; a doubled quote stays inside, and what
    follows the closing quote up to the next comma is part of the cell, quotes included.
    """
    at = 0
    while True:
        if inside:
            close = line.find(b'"', at)
            while close >= 0 and line[close + 1 : close + 2] == b'"':
                close = line.find(b'"', close + 2)
            if close < 0:
                return True
            at = line.find(b",", close + 1) + 1
            if not at:
                return False
            inside = False
        if line[at : at + 1] != b'"':
            at = line.find(b',"', at) + 1
            if not at:
                return False
        at, inside = at + 1, True


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Lines of each byte range in blocks, with the state before and after a block in both cases."""
    place: tuple[str, int] | None = None
    n, held, used = 0, [], 0
    before: list[tuple[bool, int | None]] = []
    now: list[tuple[bool, int | None]] = []

    def row() -> pa.RecordBatch:
        values = [*place, n, b"\n".join(held), *[x[0] for x in before], *[x[1] for x in before], *[x[0] for x in now], *[x[1] for x in now]]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary()] + 2 * ([pa.bool_()] * 2 + [pa.int32()] * 2)
        names = [field.split()[0] for field in _BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        for file, start, line in zip(*[c.to_pylist() for c in batch.columns]):
            if (file, start) != place:
                if held:
                    yield row()
                place, n, held, used = (file, start), 0, [], 0
                before = now = [(False, None), (True, _BEFORE)]
            elif used + len(line) > size:
                yield row()
                n, held, used, before = n + 1, [], 0, now
            held.append(line)
            used += len(line) + 1
            if b'"' in line:
                now = [(after, (origin if inside else n) if after else None) for inside, origin in now for after in [ends_inside(line, inside)]]
    if held:
        yield row()


def _range_starts(blocks: DataFrame) -> DataFrame:
    """``file, start, begun, first, block``: is each byte range begun inside a record, and where did that record begin."""
    last = lambda name: F.max_by(name, "n").alias(name)
    ranges = blocks.groupBy("file", "start").agg(*[last(c) for c in ("after0", "after1", "left0", "left1")])
    upto = Window.partitionBy("file").orderBy("start")
    # a range either ends alike in both cases, or keeps the case, or turns it round
    fixed = F.when(F.col("after0") == F.col("after1"), F.col("after0").cast("int"))
    turns = F.sum((F.col("after0") & ~F.col("after1")).cast("int")).over(upto)
    known = ranges.withColumns({"fixed": fixed, "turns": turns})
    base = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turns")), ignorenulls=True).over(upto)
    known = known.withColumn("base", base)
    after = (F.coalesce("base.fixed", F.lit(0)) + F.col("turns") - F.coalesce("base.turns", F.lit(0))) % 2 == 1
    known = known.withColumn("begun", F.lag(after, 1, False).over(upto))
    left = F.when(F.col("begun"), F.col("left1")).otherwise(F.col("left0"))
    own = F.when(left >= 0, F.struct(F.col("start").alias("first"), left.alias("block")))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("own", own).withColumn("from", F.last("own", ignorenulls=True).over(earlier))
    return known.select("file", "start", "begun", "from.first", "from.block")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each block, and the pieces of those that cross its ends."""
    for batch in batches:
        for row in batch.to_pylist():
            here = (row["start"], row["n"])
            inside, key, held, out = row["inside"], (row["first"], row["block"]) if row["inside"] else here, [], []
            top = here == (0, 0)  # the first record of a file is its header
            for line in row["lines"].split(b"\n"):
                held.append(line)
                inside = ends_inside(line, inside) if b'"' in line or inside else False
                if inside:
                    continue
                crossing = key != here
                if crossing or held != [b""] and held != [b"\r"]:
                    out.append((*key, crossing, top, b"\n".join(held)))
                    top = top and crossing
                key, held = here, []
            if held:
                out.append((*key, True, top, b"\n".join(held)))
            if out:
                first, block, piece, tops, texts = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(out), pa.string()),
                        pa.array(first, pa.int64()),
                        pa.array(block, pa.int32()),
                        pa.array([here[0]] * len(out), pa.int64()),
                        pa.array([here[1]] * len(out), pa.int32()),
                        pa.array(piece, pa.bool_()),
                        pa.array(tops, pa.bool_()),
                        pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()),
                    ],
                    ["file", "first", "block", "start", "n", "piece", "header", "record"],
                )


def csv_records(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """``file, header, record``: every record of the ``.csv`` files under a path as text; empty lines are left out.

    ``header`` marks the first record of each file. The lines are written to the shared folder
    once, in blocks of about ``block`` bytes (a longer line alone), so that later steps do not depend on how the files were
    split; the byte ranges of one file are put in order by one task, as one narrow row each.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(path)
    lines = lines.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value"))
    blocks = written(lines.mapInArrow(lambda batches: _blocks(batches, block), _BLOCKS), "csv_blocks")
    starts = written(_range_starts(blocks), "csv_ranges")  # its size is known then, so that the blocks need not be shuffled to meet it
    case = lambda name: F.when(F.col("begun"), F.col(f"{name}1")).otherwise(F.col(f"{name}0")).alias(name)
    placed = blocks.join(starts, ["file", "start"]).select("file", "start", "n", "lines", case("inside"), case("origin"), "first", "block")
    within = F.col("origin") >= 0
    placed = placed.withColumns(
        {"first": F.when(within, F.col("start")).otherwise(F.col("first")), "block": F.when(within, F.col("origin")).otherwise(F.col("block"))}
    ).select("file", "start", "n", "lines", "inside", "first", "block")
    schema = "file string, first long, block int, start long, n int, piece boolean, header boolean, record string"
    cut = placed.mapInArrow(_cut, schema)
    whole = cut.where("not piece").select("file", "header", "record")
    pieces = cut.where("piece").groupBy("file", "first", "block").agg(
        F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("start", "n", "record"))).alias("parts")
    )
    joined = pieces.select("file", "header", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined).select("file", "header", _bare(F.col("record"), F.col("header")).alias("record"))


def _bare(record: Column, header: Column) -> Column:
    """A record without the carriage return at its end and, at the start of a file, the byte order mark."""
    ended = F.when(record.endswith("\r"), F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)
    return F.when(header & ended.startswith("﻿"), F.substring(ended, F.lit(2), F.length(ended))).otherwise(ended)
