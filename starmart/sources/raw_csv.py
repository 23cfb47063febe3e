"""CSV extracts, every column read as text.

Columns are found by header name, empty fields (quoted or not) are NULL, and a
row with too few or too many fields stops the read.

A quoted line break makes a CSV file unsplittable for the built-in reader, so
free-text sources are read as lines, which do split, and stitched back into
records, whatever the size, number or compression of their files. A file that is
one split by its nature (gzip) is one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.sources.catalog import RAW_SOURCES, source_path

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}

# A larger record stops the read, so that an unbalanced quote does not swallow a file.
MAX_RECORD_BYTES = 64 * 1024 * 1024

# States while a line is scanned: outside quotes, inside, and just behind a closing quote.
OUTSIDE, INSIDE, CLOSED = 0, 1, 2


def read_raw(
    spark: SparkSession,
    base: str,
    name: str,
    pattern: str = "{name}.csv",
    file_names: Mapping[str, str] | None = None,
    sep: str = ",",
) -> DataFrame:
    """Raw source ``name`` under ``base`` as text columns, in registry order."""
    source = RAW_SOURCES.get(name)
    path = source_path(base, name, pattern, file_names)
    if source.free_text:
        records = read_stitched(spark, path, sep)
    else:
        # Without pruning a ragged row is refused whichever columns a query uses.
        records = (
            spark.read.options(**CSV_OPTIONS, sep=sep)
            .option("header", True)
            .option("enforceSchema", False)
            .option("columnPruning", False)
            .csv(path)
        )
    return records.select(*source.columns)


def read_all_raw(
    spark: SparkSession,
    base: str,
    pattern: str = "{name}.csv",
    file_names: Mapping[str, str] | None = None,
    sep: str = ",",
    names: Iterable[str] = tuple(RAW_SOURCES),
) -> dict[str, DataFrame]:
    return {name: read_raw(spark, base, name, pattern, file_names, sep) for name in names}


def write_raw(df: DataFrame, path: str) -> None:
    """Write a table as a CSV extract that ``read_raw`` reads back unchanged."""
    # The writer trims values unless told not to.
    df.write.options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def remove_raw(spark: SparkSession, path: str) -> None:
    """Delete an extract, or a folder of extracts, wherever ``write_raw`` put it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_stitched(
    spark: SparkSession, path: str, sep: str = ",", max_record_bytes: int = MAX_RECORD_BYTES
) -> DataFrame:
    """CSV with quoted line breaks, read in parallel from within each file.

    Records end at a line feed, a carriage return or both, outside quotes; a quote
    opens a field only at the field's start. Every line tells in which state it
    ends if it begins outside quotes, and if it begins inside. Running along the
    lines of an input split, and then along the few splits of a file, these say
    where records start. A record is put together under the split that holds its
    first line, so no group is ever larger than a split plus one record. The
    result does not depend on where the splits fall.
    """
    header = (
        spark.read.options(**CSV_OPTIONS, sep=sep).option("header", True).csv(path)
    ).columns
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        "value",
    )
    marked = (F.col("block") == 0) & F.startswith("value", F.lit("\uFEFF"))
    read = read.withColumn("value", F.when(marked, _from("value", 2)).otherwise(F.col("value")))
    pieces = F.split("value", "\r", -1)
    lines = read.select(
        "file", "block", "position", F.size(pieces).alias("pieces"),
        F.posexplode(pieces).alias("piece", "value"),
    ).select(
        "file",
        "block",
        "position",
        "piece",
        "value",
        F.when(F.col("piece") < F.col("pieces") - 1, "\r").otherwise("\n").alias("end"),
        F.octet_length("value").alias("bytes"),
        _exit_state("value", sep, OUTSIDE).alias("exit_outside"),
        _exit_state("value", sep, INSIDE).alias("exit_inside"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("position", "piece")
    # Both possible numberings, so that one sort serves whichever state a split begins in.
    lines = _entered(lines, in_block)
    up_to = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("record_outside", F.sum(1 - F.col("after_outside")).over(up_to))
    lines = lines.withColumn("record_inside", F.sum(1 - F.col("after_inside")).over(up_to))

    placed = lines.join(
        _block_states(lines, in_block, max_record_bytes), ["file", "block"]
    ).withColumn(
        "record",
        F.when(F.col("entry") == 0, F.col("record_outside")).otherwise(F.col("record_inside")),
    )
    continues = F.col("record") == 0
    records = (
        placed.groupBy(
            "file",
            F.when(continues, F.col("owner_block")).otherwise(F.col("block")).alias("at"),
            F.when(continues, F.col("owner_record")).otherwise(F.col("record")).alias("record"),
        )
        .agg(
            F.sort_array(
                F.collect_list(F.struct("block", "position", "piece", "value", "end"))
            ).alias("parts")
        )
        .select(
            "file",
            "at",
            "record",
            F.array_join(
                F.transform("parts", lambda p: F.concat(p["value"], p["end"])), ""
            ).alias("text"),
        )
        .withColumn("text", F.substring(F.col("text"), F.lit(1), F.length("text") - 1))
        .filter(F.col("text") != "")
    )
    too_long = F.octet_length("text") > max_record_bytes
    records = records.withColumn(
        "text", F.when(too_long, _oversized().cast("string")).otherwise(F.col("text"))
    )

    schema = ", ".join(f"`{c}` string" for c in header)
    options = {**CSV_OPTIONS, "sep": sep, "multiLine": "true"}
    parsed = records.select("at", "record", F.from_csv("text", schema, options).alias("row"))
    # The first record of a file's first split is its header.
    is_header = (F.col("at") == 0) & (F.col("record") == 1)
    names = F.array(*[F.col("row")[c] for c in header])
    mismatch = F.raise_error(F.lit("the files of one source have different headers"))
    is_data = (
        F.when(~is_header, True)
        .when(names == F.array(*map(F.lit, header)), False)
        .otherwise(mismatch.cast("boolean"))
    )
    return parsed.filter(is_data).select("row.*")


def _exit_state(name: str, sep: str, entry: int) -> Column:
    """1 if a line that begins in the given state ends inside quotes, else 0.

    Only lines with quotes are scanned, from quote to quote.
    """

    def step(state: Column, before: Column, first: Column) -> Column:
        opens = F.endswith(before, F.lit(sep)) | (first & (before == "") & (state == OUTSIDE))
        return (
            F.when(state == INSIDE, CLOSED)
            .when((state == CLOSED) & (before == ""), INSIDE)
            .when(opens, INSIDE)
            .otherwise(OUTSIDE)
        )

    def scan(parts: Column) -> Column:
        quotes = F.sequence(F.lit(1), F.size(parts) - 1)
        return F.aggregate(
            quotes, F.lit(entry), lambda state, i: step(state, F.get(parts, i - 1), i == 1)
        )

    # Bound to a name, so that the line is cut once and not at every quote.
    scanned = F.transform(F.array(F.split(name, '"', -1)), scan)
    ends_inside = (F.element_at(scanned, 1) == INSIDE).cast("int")
    return F.when(F.contains(name, F.lit('"')), ends_inside).otherwise(
        F.lit(1 if entry == INSIDE else 0)
    )


def _entered(rows: DataFrame, order: Window) -> DataFrame:
    """The state before each row if its group begins outside quotes, and if inside.

    A row keeps the state, flips it, or leaves a fixed one whatever it was: the
    state before a row is the last fixed one, or the group's, flipped as often as
    rows flip it in between.
    """
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    flips = (F.col("exit_outside") > F.col("exit_inside")).cast("int")
    rows = rows.withColumn("flips", F.coalesce(F.sum(flips).over(earlier), F.lit(0)))
    fixed = F.when(
        F.col("exit_outside") == F.col("exit_inside"),
        F.struct(F.col("exit_outside").alias("state"), F.col("flips").alias("flips")),
    )
    rows = rows.withColumn("fixed", F.last(fixed, ignorenulls=True).over(earlier))
    for name, state in (("after_outside", 0), ("after_inside", 1)):
        since = F.when(
            F.col("fixed").isNull(), F.lit(state) + F.col("flips")
        ).otherwise(F.col("fixed.state") + F.col("flips") - F.col("fixed.flips"))
        rows = rows.withColumn(name, (since % 2).cast("int"))
    return rows.drop("flips", "fixed")


def _block_states(lines: DataFrame, in_block: Window, max_record_bytes: int) -> DataFrame:
    """Per split: the quote state it begins in, and the record its first lines continue.

    Works on line positions, sizes and states; the text itself stays behind.
    """
    # The state behind a line follows from the one before it.
    exits = {
        entry: F.when(F.col(f"after_{entry}") == 0, F.col("exit_outside")).otherwise(
            F.col("exit_inside")
        )
        for entry in ("outside", "inside")
    }
    place = F.struct("position", "piece")
    blocks = lines.groupBy("file", "block").agg(
        F.max_by(exits["outside"], place).alias("exit_outside"),
        F.max_by(exits["inside"], place).alias("exit_inside"),
        F.max("record_outside").alias("starts_outside"),
        F.max("record_inside").alias("starts_inside"),
        F.sum(F.col("bytes") + 1).alias("bytes"),
    )
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    # A file begins outside quotes.
    blocks = _entered(blocks, along).withColumn("entry", F.col("after_outside")).withColumn(
        "records",
        F.when(F.col("entry") == 0, F.col("starts_outside")).otherwise(F.col("starts_inside")),
    )
    owns = F.col("records") > 0
    owner = F.last(F.when(owns, F.col("block")), ignorenulls=True).over(earlier)
    blocks = blocks.withColumn("owner_block", owner).withColumn(
        "owner_record",
        F.last(F.when(owns, F.col("records")), ignorenulls=True).over(earlier),
    )
    # Splits without a record start lie within one record: it is refused before it is gathered.
    within = Window.partitionBy("file", "owner_block")
    inside = F.sum(F.when(~owns, F.col("bytes"))).over(within)
    too_long = F.coalesce(inside > max_record_bytes, F.lit(False))
    return blocks.select(
        "file",
        "block",
        F.when(too_long, _oversized().cast("int")).otherwise(F.col("entry")).alias("entry"),
        "owner_block",
        "owner_record",
    )


def _oversized() -> Column:
    return F.raise_error(F.concat(F.lit("unbalanced quote or oversized record in "), "file"))


def _from(name: str, first: int) -> Column:
    return F.substring(F.col(name), F.lit(first), F.length(name))
