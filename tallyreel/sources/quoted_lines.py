"""CSV records with line breaks inside quotes, from files that are still read in byte ranges.

A reader that looks for such records from the top of a file reads each file in one task. Here every
physical line says how it leaves the quotes, once for a start outside them and once for a start
inside. Two lines in a row compose to such an answer again, so the lines of a byte range reduce to
one of four kinds, and a prefix scan over the few ranges of a file gives the true start of each.
Rows are cut where a line ends outside quotes; only records that go over several lines are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyreel.sources.workspace import ensure_checkpoint_dir

QUOTE, DELIMITER = '"', ","
# Where a reader can be in a line: outside a quoted value, inside it, behind a quote that may end it, at the line's head.
OUTSIDE, INSIDE, CLOSED, HEAD = range(4)
RANGE = ["file", "block"]


def leaves_inside(line: Column, starts_inside: bool) -> Column:
    """Whether the line ends inside a quoted value. A quote opens a value only at its start; doubled, it is text."""
    pieces = F.split(line, QUOTE, -1)

    def next_quote(state: Column, piece: Column) -> Column:
        at, before = state["at"], state["before"]
        opens = F.endswith(before, F.lit(DELIMITER)) | ((at == HEAD) & (before == ""))
        to = F.when(at == INSIDE, CLOSED).when((at == CLOSED) & (before == ""), INSIDE).when(opens, INSIDE).otherwise(OUTSIDE)
        return F.struct(to.alias("at"), piece.alias("before"))

    start = F.struct(F.lit(INSIDE if starts_inside else HEAD).alias("at"), F.element_at(pieces, 1).alias("before"))
    ends = F.aggregate(F.slice(pieces, 2, F.size(pieces)), start, next_quote, lambda state: state["at"] == INSIDE)
    return F.when(F.contains(line, F.lit(QUOTE)), ends).otherwise(F.lit(starts_inside))


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line, from_outside, from_inside): ``at`` rises within a byte range."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    return lines.withColumns(
        {"from_outside": leaves_inside(F.col("line"), False), "from_inside": leaves_inside(F.col("line"), True)}
    )


def _compose(rows: DataFrame, fixed: Column, value: Column, swaps: Column, order: str, keys: list[str]) -> DataFrame:
    """``rows`` with the composition of all rows up to each: is the state known, and the state, or whether the start is inverted.

    A row fixes the state, inverts it, or leaves it. Since the last fixing row only inversions count.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    counted = rows.withColumn("_n", F.sum(swaps.cast("int")).over(window))
    last = F.last(F.when(fixed, F.struct(value.alias("v"), F.col("_n").alias("n"))), ignorenulls=True).over(window)
    odd = (F.col("_n") - F.coalesce(last["n"], F.lit(0))) % 2 == 1
    return counted.withColumns({"known": last.isNotNull(), "state": F.coalesce(last["v"], F.lit(False)) != odd}).drop("_n")


def _composed_lines(lines: DataFrame) -> DataFrame:
    out, ins = F.col("from_outside"), F.col("from_inside")
    return _compose(lines, out == ins, out, out & ~ins, "at", RANGE)


def range_starts(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(file, block, inside): whether each byte range starts inside quotes. An unclosed quote is an error."""
    # Lines that hand on whatever state they get need not be ordered.
    marks = lines.filter("from_outside or not from_inside").select(*RANGE, "at", "from_outside", "from_inside")
    last = _composed_lines(marks).groupBy(*RANGE).agg(F.max_by(F.struct("known", "state"), "at").alias("r"))
    kinds = ranges.select(*RANGE).join(last.select(*RANGE, "r.known", "r.state"), RANGE, "left")
    kinds = kinds.select(*RANGE, F.coalesce("known", F.lit(False)).alias("k"), F.coalesce("state", F.lit(False)).alias("s"))
    ends = _compose(kinds, F.col("k"), F.col("s"), ~F.col("k") & F.col("s"), "block", ["file"])
    by_file = Window.partitionBy("file").orderBy("block")
    ends = ends.select(
        *RANGE,
        F.coalesce(F.lag("state").over(by_file), F.lit(False)).alias("inside"),
        (F.lead("state").over(by_file).isNull() & F.col("state")).alias("unclosed"),
    ).checkpoint()
    unclosed = ends.filter("unclosed").take(1)
    if unclosed:
        raise ValueError(f"a quoted value is never closed in {unclosed[0]['file']}")
    return ends.drop("unclosed")


def records(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """(record, header): one row per CSV record, its line breaks kept; blank lines outside quotes are none."""
    in_range = Window.partitionBy(*RANGE).orderBy("at")
    cut = _composed_lines(lines.join(starts, RANGE))
    cut = cut.withColumn("after", F.when(F.col("known"), F.col("state")).otherwise(F.col("state") != F.col("inside")))
    cut = cut.withColumn("before", F.coalesce(F.lag("after").over(in_range), "inside"))
    cut = cut.withColumn("opens", ~F.col("before") & F.col("line").rlike(r"[^\x00-\x20]"))
    cut = cut.withColumn("number", F.sum(F.col("opens").cast("int")).over(in_range)).filter("before or opens")
    whole = cut.filter("opens and not after").select("line", *RANGE, "number")
    pieces = cut.filter("not opens or after").select(*RANGE, "at", "number", "line")
    # What a range starts with belongs to the last record that opened in an earlier range of the file.
    opened = cut.groupBy(*RANGE).agg(F.max("number").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    homes = opened.select(
        *RANGE, F.last(F.when(F.col("last") > 0, F.struct("block", "last")), ignorenulls=True).over(before).alias("home")
    )
    carried = pieces.filter("number = 0").join(homes, RANGE).select(*RANGE, "at", "home", "line")
    own = pieces.filter("number > 0").select(*RANGE, "at", F.struct("block", F.col("number").alias("last")).alias("home"), "line")
    gathered = own.union(carried).groupBy("file", "home").agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("parts"))
    joined = gathered.select(
        F.concat_ws("\n", F.transform("parts", lambda p: p["line"])).alias("line"), "file", F.col("home.block").alias("block"),
        F.col("home.last").alias("number"),
    )
    every = whole.unionByName(joined)
    ending = F.expr("if(endswith(line, '\r'), left(line, length(line) - 1), line)")
    return every.select(ending.alias("record"), ((F.col("block") == 0) & (F.col("number") == 1)).alias("header"))


def read_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(record, header) of header CSV, or None where no line of any file leaves a quoted value open.

    If no line that starts outside quotes ends inside them, every line is a record, and the plain
    reader is right.
    """
    lines = physical_lines(spark, path)
    ranges = lines.groupBy(*RANGE).agg(F.max("from_outside").alias("opens"))
    ensure_checkpoint_dir(spark)
    ranges = ranges.checkpoint()
    if not ranges.filter("opens").take(1):
        return None
    return records(lines, range_starts(lines, ranges))
