"""Records of CSV files with line breaks inside quotes, read by all tasks.

A file is read by blocks, line by line, and a line may start inside a quoted field that an earlier block opened. What a line
does to that state is a function of two values (where it leaves the state if it starts outside, and if inside). These functions
are composed per block and then over the blocks of each file, one row per block, which tells every block the state it
starts in. With that, each block knows where its records begin. Lines that are a record by themselves stay where they are;
only the lines of longer records meet their others, by the number of the record in its file.

Lines are exchanged by file and block, once as lines and once as records, which come in the order of the file. Quotes count as the CSV reader counts them: one opens a field only at its start, two
inside a field are one character, and text behind a closing quote belongs to the field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paperloom.session import land

FILE, BLOCK, SLOT = "_file", "_block", "_slot"
RECORD = "_record"
#: Lines a record may have; more means a quote that nothing closes.
MAX_LINES = 10_000

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:[^",][^,]*+|"{_INSIDE}"[^,]*+)?+'
_OPENS = rf'(?:{_FIELD},)*+"{_INSIDE}$'


def _left_open(line: Column) -> Column:
    """Whether a line that starts outside of quotes ends inside."""
    return line.contains('"') & line.rlike(f"^{_OPENS}")


def _stays_open(line: Column) -> Column:
    """Whether a line that starts inside of quotes ends inside."""
    return ~line.contains('"') | line.rlike(f"^{_INSIDE}$") | line.rlike(f'^{_INSIDE}"[^,]*+,{_OPENS}')


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block and place, and the two values of their function."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SLOT),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    return lines.select("*", _left_open(F.col("line")).alias("outside"), _stays_open(F.col("line")).alias("inside"))


def _then(state: Column, step: Column) -> Column:
    return F.when(state, step["inside"]).otherwise(step["outside"])


def block_states(lines: DataFrame) -> DataFrame:
    """Per block whether it starts inside of quotes. Only lines that change something are gathered, without their text."""
    step = F.struct(SLOT, "outside", "inside")
    changing = F.col("outside") | ~F.col("inside")
    per_block = lines.groupBy(FILE, BLOCK).agg(F.sort_array(F.collect_list(F.when(changing, step))).alias("steps"))
    both = F.struct(F.lit(False).alias("outside"), F.lit(True).alias("inside"))
    composed = F.aggregate(
        "steps", both, lambda s, x: F.struct(_then(s["outside"], x).alias("outside"), _then(s["inside"], x).alias("inside"))
    )
    blocks = per_block.select(FILE, F.struct(BLOCK, composed.alias("does")).alias("block"))
    per_file = blocks.groupBy(FILE).agg(F.sort_array(F.collect_list("block")).alias("blocks"))

    def walk(state: Column, block: Column) -> Column:
        return F.struct(
            F.array_append(state["found"], F.struct(block[BLOCK].alias(BLOCK), state["now"].alias("starts_inside"))).alias("found"),
            _then(state["now"], block["does"]).alias("now"),
        )

    none = F.array().cast(f"array<struct<{BLOCK}: bigint, starts_inside: boolean>>")
    walked = F.aggregate("blocks", F.struct(none.alias("found"), F.lit(False).alias("now")), walk, lambda s: s["found"])
    return per_file.select(FILE, F.explode(walked).alias("b")).select(FILE, f"b.{BLOCK}", "b.starts_inside")


def _with_state(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with the state they start in, and how many records of several lines have begun in the block."""
    in_block = Window.partitionBy(FILE, BLOCK).orderBy(SLOT)
    turns = F.col("outside") & ~F.col("inside")
    settles = F.col("outside") == F.col("inside")
    # the state behind a line: that of the last line which settles it, turned as often as lines since then turn it
    counted = lines.join(states, [FILE, BLOCK]).withColumn("turned", F.sum(turns.cast("int")).over(in_block))
    counted = counted.withColumn(
        "settled", F.last(F.when(settles, F.struct(F.col("outside").alias("to"), F.col("turned").alias("at"))), ignorenulls=True).over(in_block)
    )
    to, since = F.coalesce("settled.to", "starts_inside"), F.col("turned") - F.coalesce("settled.at", F.lit(0))
    behind = counted.withColumn("behind", to != (since % 2 == 1))
    before = F.coalesce(F.lag("behind").over(in_block), F.col("starts_inside"))
    known = behind.withColumn("before", before).withColumn("first", (F.col(BLOCK) == 0) & (F.row_number().over(in_block) == 1))
    opened = known.withColumn("opened", F.sum((~F.col("before") & F.col("outside")).cast("int")).over(in_block))
    return opened.select(FILE, BLOCK, SLOT, "line", "before", "outside", "first", "opened")


def csv_records(spark: SparkSession, path: str, max_lines: int = MAX_LINES) -> DataFrame:
    """One row per record: its text, its file, block and place there (those of its first line), and whether it is the ``first``.

    Blank lines between records are left out, line breaks inside a record are ``\\n``. Raises for a record of more than
    ``max_lines`` lines instead of gathering it.
    """
    lines = csv_lines(spark, path)
    states = land(block_states(lines), "csv-states")
    known = land(_with_state(lines, states), "csv-lines")
    alone = ~F.col("before") & ~F.col("outside")
    single = known.filter(alone & (F.length(F.trim("line")) > 0)).select(FILE, BLOCK, SLOT, F.col("line").alias(RECORD), "first")
    longer = known.filter(~alone)
    begun = longer.groupBy(FILE, BLOCK).agg(F.max("opened").alias("n"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = begun.select(FILE, BLOCK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    numbered = longer.join(starts, [FILE, BLOCK]).withColumn("number", F.col("earlier") + F.col("opened"))
    largest = numbered.groupBy(FILE, "number").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(1).first()
    if largest is None:
        return _in_file_order(single)
    if largest["n"] > max_lines:
        raise ValueError(f"A record of {largest[FILE]} has {largest['n']} lines; a quote is open, or max_lines is too low")
    pieces = F.sort_array(F.collect_list(F.struct(BLOCK, SLOT, "line", "first")))
    joined = numbered.groupBy(FILE, "number").agg(pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["line"]), "\n")
    several = joined.select(
        FILE, F.col("pieces")[0][BLOCK].alias(BLOCK), F.col("pieces")[0][SLOT].alias(SLOT), text.alias(RECORD), F.col("pieces")[0]["first"].alias("first")
    )
    return _in_file_order(single.unionByName(several))


def _in_file_order(records: DataFrame) -> DataFrame:
    """Records of a block side by side, as they stand in it."""
    return records.repartition(FILE, BLOCK).sortWithinPartitions(FILE, BLOCK, SLOT)
