"""Files whose records do not end at every separator, read in byte ranges.

A JSON array or a CSV file with line breaks inside cells has no place where a reader may simply start: whether a brace or a
line break ends a record depends on everything before it. Spark's text source still splits such a file into byte ranges
and these are cut into stretches of some pieces ("blocks"): sequences of pieces that end at a separator. What a piece does to the reader's state is a small number that
can be summed: quotes (odd or even) and braces opened. So the state before a piece is the sum over the blocks before its own,
of which there is one row each, plus the sum over the pieces before it in its block.

Blocks that need none of this are recognised in the first pass and their rows never move. Tables with one row per block are
written and broadcast, so that the pieces are shuffled once, with the block's number instead of its file's name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from formflow.session import materialise

#: A block has at most two to this power pieces: what a task sorts at once does not follow the size of a byte range.
STRETCH = 16
_BOM = "﻿"


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, seq, value): texts between separators; ``block`` is (byte range, stretch), ``seq`` orders its pieces."""
    raw = spark.read.option("lineSep", separator).text(path)
    rows = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                      F.monotonically_increasing_id().alias("seq"), "value")
    return rows.select("file", F.struct("range", F.shiftright("seq", STRETCH).alias("stretch")).alias("block"), "seq", "value")


def without_bom(df: DataFrame) -> DataFrame:
    first = (F.col("block.range") == 0) & F.col("value").startswith(_BOM)
    return df.withColumn("value", F.when(first, F.expr("substring(value, 2)")).otherwise(F.col("value")))


def quotes(text: Column) -> Column:
    """Number of double quotes."""
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def before_block(blocks: DataFrame, sums: Mapping[str, str]) -> DataFrame:
    """Per file: the sums over all earlier blocks, {new column: summed column}. One row per block goes through the window."""
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumns({new: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for new, c in sums.items()})


def bounds() -> list[Column]:
    return [F.min("seq").alias("low"), F.max("seq").alias("high")]


def numbered(blocks: DataFrame) -> DataFrame:
    """Add ``at``, the block's number in file order, and ``first``, the number of its file's first block."""
    known = blocks.withColumn("at", F.row_number().over(W.orderBy("file", "block")))
    return known.withColumn("first", F.min("at").over(W.partitionBy("file")))


def placed(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with the columns of their block, of which an earlier reading made the table; a reading that splits otherwise fails."""
    known = F.broadcast(blocks.withColumnsRenamed({"file": "_file", "block": "_block"}))
    met = rows.join(known, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")), "left")
    same = F.coalesce(F.col("seq").between(F.col("low"), F.col("high")), F.lit(False))
    message = F.concat(F.lit("split otherwise than in an earlier reading: "), F.col("file"))
    # Both columns: the check must be in what is used, or the join would leave such rows out.
    checked = {c: F.when(same, F.col(c)).otherwise(F.raise_error(message).cast(kind)) for c, kind in (("value", "string"), ("at", "int"))}
    return met.withColumns(checked).drop("_file", "_block", "low", "high")


def before_piece(value: Column) -> Column:
    """Sum of ``value`` over the pieces before this one in its block."""
    earlier = W.partitionBy("at").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


# --- JSON arrays ----------------------------------------------------------------------------------------------------------

#: What may stand between the objects of an array.
_BETWEEN = " \t\n\r\f\v[,"


def _unescaped(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _braces(text: Column, inside: bool) -> Column:
    """Braces opened outside strings; ``inside``: the text begins within a string. No escapes are left in it."""
    from_outside = F.regexp_replace(text, r'^[^"]*"?', "") if inside else text
    return _count(F.regexp_replace(from_outside, r'"[^"]*("|$)', ""), "{")


def _scanned(spark: SparkSession, path: str) -> DataFrame:
    """Pieces that end at a closing brace, with ``odd`` (quotes) and the braces they open if they begin outside or inside a string."""
    raw = without_bom(pieces(spark, path, "}"))
    text = F.col("value")
    plain, found = _unescaped(text), _count(text, "{")
    # Most pieces begin with their only brace, which needs no look at their strings.
    ahead = (found == 1) & F.ltrim(text, F.lit(_BETWEEN)).startswith("{")
    opened = F.when(found == 0, 0).when(ahead, 1).otherwise(_braces(plain, False))
    opened_inside = F.when((found == 0) | ahead, 0).otherwise(_braces(plain, True))
    return raw.select("*", (quotes(plain) % 2).alias("odd"), opened.alias("opened"), opened_inside.alias("opened_inside"))


def _stated(rows: DataFrame) -> DataFrame:
    """Pieces of numbered blocks with the state they begin in and the braces by which they change the level."""
    inside = (F.col("in_string").cast("int") + before_piece(F.col("odd"))) % 2 == 1
    end = F.col("last") & F.lead("seq").over(W.partitionBy("at").orderBy("seq")).isNull()
    known = rows.withColumns({"inside": inside, "end": end})
    closed = F.when(F.col("end") | ((F.col("inside").cast("int") + F.col("odd")) % 2 == 1), 0).otherwise(1)
    return known.withColumn("change", F.when(F.col("inside"), F.col("opened_inside")).otherwise(F.col("opened")) - closed)


def _fail(condition: Column, otherwise: Column, message: str) -> Column:
    return F.when(condition, F.raise_error(F.concat(F.lit(message + " in "), F.col("file"))).cast("bigint")).otherwise(otherwise)


def json_array_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the objects of files that hold one JSON array of objects each, as texts, in any order.

    A file is read by as many tasks as it has splits. Pieces end at a closing brace. A piece that opens one brace outside
    strings and has whole strings only is an object by itself; a block of such pieces is passed on as it is. In blocks with
    nested objects, or with a brace inside a string, the pieces are put in order, and those that are no object by themselves
    are put together by the number of the object in its block; what a block begins and another ends is joined last, at most
    two rows per block. A file that does not end with the array fails the read; an empty array gives no rows.
    """
    scanned = _scanned(spark, path)
    # The last piece of a file is what follows its last brace.
    ends = F.max_by(F.col("value").rlike(r"^\s*(\[\s*)?\]\s*$"), "seq")
    single = (F.col("odd") == 0) & (F.col("opened") == 1)
    whole = W.partitionBy("file")
    blocks = scanned.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.count_if(~single).alias("others"), ends.alias("ends"), *bounds())
    blocks = before_block(blocks, {"quotes_before": "odd"}).withColumns({
        "broken": (F.sum("odd").over(whole) % 2 == 1) | ~F.max_by("ends", "block").over(whole),
        "in_string": F.col("quotes_before") % 2 == 1, "last": F.col("block") == F.max("block").over(whole)})
    alone = (F.col("others") == 0) | (F.col("others") == 1) & F.col("last") & F.col("ends")
    blocks = blocks.select("file", "block", "low", "high", "broken", "in_string", "last", (alone & ~F.col("in_string")).alias("easy"))
    blocks = materialise(numbered(blocks), "blocks")

    # Not ``not easy``: a piece without its block must come through to fail.
    hard = placed(scanned, blocks.drop("broken")).where(~F.coalesce("easy", F.lit(False)))
    state = ["at", "seq", "odd", "opened", "opened_inside", "in_string", "last"]
    changes = _stated(hard.select(*state)).groupBy("at").agg(F.sum("change").alias("change"))
    deep = before_block(blocks.join(changes, "at", "left").na.fill(0, ["change"]), {"depth": "change"})
    broken = F.col("broken") | (F.sum("change").over(whole) != 0)
    # A broken file must be seen even if it has no object.
    deep = deep.withColumn("depth", _fail(broken, F.col("depth"), "no whole JSON array")).select("file", "block", "low", "high", "at", "first", "easy", "depth")
    deep = materialise(deep, "blocks")

    closing = F.concat("value", F.lit("}"))
    easy = placed(scanned.where(single), deep).where(F.coalesce(F.col("easy") & (F.col("depth") == 0), F.lit(True)))
    ordered = _stated(hard.select(*state, "value")).withColumn("level", before_piece(F.col("change")))
    ordered = ordered.join(F.broadcast(deep.select("at", "first", "file", "depth")), "at").withColumn("level", F.col("level") + F.col("depth"))
    begins = (F.col("level") == 0) & ~F.col("inside") & ~F.col("end")
    ordered = ordered.withColumn("begins", begins.cast("int")).withColumn("number", before_piece(F.col("begins")) + F.col("begins"))
    one = (F.col("begins") == 1) & single
    alone_rows = easy.select("file", closing.alias("value")).unionByName(ordered.where(one).select("file", closing.alias("value")))

    # A block of plain pieces inside an object that began before it holds parts only.
    between = placed(scanned, deep).where("easy and depth <> 0").withColumns({
        "number": F.lit(0).cast("bigint"), "level": F.col("depth"), "change": F.lit(0).cast("bigint")})
    part = ["at", "first", "number", "seq", "value", (F.col("level") + F.col("change") == 0).alias("closed")]
    parts = ordered.where(~one & ~F.col("end")).select(*part).unionByName(between.select(*part))
    place = F.struct("seq", closing.alias("value"))
    pieced = parts.groupBy("at", "number").agg(F.first("first").alias("first"), F.array_sort(F.collect_list(place)).alias("p"), F.max_by("closed", "seq").alias("closed"))
    pieced = pieced.select("at", "number", "first", F.array_join("p.value", "").alias("value"), (F.col("closed") & (F.col("number") > 0)).alias("done"))
    along = W.partitionBy("first").orderBy("at", "number")
    cut = pieced.where("not done").withColumn("object", F.sum((F.col("number") > 0).cast("int")).over(along))
    mended = cut.groupBy("first", "object").agg(F.array_sort(F.collect_list(F.struct("at", "number", "value"))).alias("p"))
    several = pieced.where("done").select("first", "value").unionByName(mended.select("first", F.array_join("p.value", "").alias("value")))
    files = F.broadcast(blocks.where("at = first").select("first", "file"))
    found = alone_rows.unionByName(several.join(files, "first").select("file", "value"))
    return found.withColumn("value", F.ltrim("value", F.lit(_BETWEEN)))


# --- CSV with line breaks inside cells ------------------------------------------------------------------------------------


def csv_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One written row per block: (file, block, low, high, at, first, before, records, records_before), ``before`` being the quotes before it."""
    lines = _csv_lines(spark, path)
    blocks = before_block(lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"), *bounds()), {"before": "odd"})
    blocks = blocks.withColumn("broken", F.sum("odd").over(W.partitionBy("file")) % 2 == 1).drop("odd")
    blocks = materialise(numbered(blocks), "blocks")
    counted = _csv_known(lines.withColumn("value", F.left("value", F.lit(2))), blocks).groupBy("at").agg(F.sum("begins").alias("records"))
    counts = before_block(blocks.join(counted, "at", "left").na.fill(0, ["records"]), {"records_before": "records"})
    before = _fail(F.col("broken"), F.col("records_before"), "a quote is never closed")
    return materialise(counts.withColumn("records_before", before), "blocks")


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    return without_bom(pieces(spark, path, "\n")).withColumn("odd", quotes(F.col("value")) % 2)


def _csv_known(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines with the state they begin in; empty ones between records are left out."""
    met = placed(lines, blocks.select("file", "block", "low", "high", "at", "before")).drop("file", "block")
    inside = (F.col("before") + before_piece(F.col("odd"))) % 2 == 1
    empty = F.col("value").isin("", "\r")
    known = met.withColumn("inside", inside)
    return known.withColumn("begins", (~F.col("inside") & ~empty).cast("int")).where(F.col("inside") | ~empty)


def csv_records(spark: SparkSession, path: str, blocks: DataFrame | None = None) -> DataFrame:
    """(file, row, value): the records of quoted CSV files as texts, numbered from 1 in each file, the header being 1.

    A line begins a record if an even number of quotes stands before it in its file (a doubled quote counts twice). Line
    breaks inside cells stay as they are; empty lines are no records. A quote left open fails the read. ``blocks``: the
    table of ``csv_blocks``, if it is there already.
    """
    blocks = csv_blocks(spark, path) if blocks is None else blocks
    known = _csv_known(_csv_lines(spark, path), blocks)
    known = known.withColumn("row", before_piece(F.col("begins")) + F.col("begins"))
    known = known.join(F.broadcast(blocks.select("at", "first", "records_before")), "at").withColumn("row", F.col("row") + F.col("records_before"))
    alone = (F.col("odd") == 0) & ~F.col("inside")
    place = F.struct("at", "seq", "value")
    joined = known.where(~alone).groupBy("first", "row").agg(F.array_sort(F.collect_list(place)).alias("p"))
    found = known.where(alone).select("first", "row", "value").unionByName(joined.select("first", "row", F.array_join("p.value", "\n").alias("value")))
    files = F.broadcast(blocks.where("at = first").select("first", "file"))
    return found.join(files, "first").select("file", "row", F.regexp_replace("value", r"\r$", "").alias("value"))
