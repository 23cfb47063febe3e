"""Scratch tables, numbering and joins shared by the operators of this package."""

from __future__ import annotations

import atexit
import functools
import shutil
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A word is a maximal run of anything but blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
# At most so many 64-bit ids (some 64 MB as a hash table) are broadcast; more are shuffled.
BROADCAST_IDS = 1_000_000
BATCH_ROWS = 1000


def by_value(module: str) -> None:
    """Send a module's functions to executors with the job, not as an import they must resolve."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place the session names for checkpoints."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    """For one machine and no shared folder: a temporary one that ends with the process."""
    folder = tempfile.mkdtemp(prefix="starmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: later steps survive lost executors without its lineage.

    Meanwhile rows go to Python in batches of at most BATCH_ROWS, so that whole texts do not
    fill the executors' memory outside the heap; the session's setting is put back.
    """
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def having(
    rows: DataFrame, ids: DataFrame, key: str, how: str = "left_semi", limit: int = BROADCAST_IDS
) -> DataFrame:
    """The rows whose key is among ids, a written table without repeats; left_anti: the others.

    Few ids (counted, at most limit) are broadcast, so that wide rows stay where they are;
    more are met by a shuffle.
    """
    chosen = ids.select(key)
    if chosen.count() <= limit:
        chosen = F.broadcast(chosen)
    return rows.join(chosen, key, how)


def smallest_present(known: DataFrame, docs: DataFrame, most: int, folder: str) -> DataFrame:
    """Of the rows of known (doc_id, ...) whose doc_id is in docs, the `most` of smallest hash, written.

    Only ids are shuffled.
    """
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    present = known.join(ids, "doc_id", "left_semi")
    return written(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), folder)


def spare(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column | str) -> Column:
    """Words of a text; none for NULL."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text,
                                     F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate value once and use it many times inside body."""
    return F.element_at(F.transform(F.array(value), body), 1)


def numbered(df: DataFrame, path: str) -> DataFrame:
    """The rows, written, with their partition (_part) and a number of their own (_row)."""
    return written(
        df.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        path,
    )


def running_sums(rows: DataFrame, by: str, value: Column, out: str) -> DataFrame:
    """Add the sum of value over all earlier rows with the same by, however many there are.

    rows come from numbered(). Sums run within a (group, partition) and start from the totals
    of the partitions before, so no task sees more of a group than one partition holds.
    """
    own, base = "_own", "_base"
    rows = rows.withColumn(own, value.cast("long"))
    within = Window.partitionBy(by, "_part").orderBy("_row")
    before = Window.partitionBy(by).orderBy("_part")
    totals = rows.groupBy(by, "_part").agg(F.sum(own).alias(base))
    starts = totals.select(
        F.col(by).alias("_by"), F.col("_part").alias("_by_part"),
        (F.sum(base).over(before) - F.col(base)).alias(base),
    )
    sums = rows.withColumn(out, F.sum(own).over(within) - F.col(own))
    on = F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_by_part"))
    return (
        sums.join(starts, on)
        .withColumn(out, F.col(out) + F.col(base))
        .drop(own, base, "_by", "_by_part")
    )


def content_sums(
    rows: DataFrame, by: str, identity: list[str], value: Column, out: str
) -> DataFrame:
    """Add the sum of value over all rows with the same by that come earlier in content order.

    rows come from numbered(); value is an expression of the identity columns. The order is by a
    hash of identity, so it does not depend on how the input is split; rows of one identity come
    in the input's order. Equal identities are summed before the shuffle and counted off with
    running_sums, and a group is cut into ranges of the hash, so a group or identity with very
    many rows is spread over tasks.
    """
    keys = [by, *identity]
    kinds = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    kinds = kinds.withColumns({"_hash": F.xxhash64(*identity), "_each": value.cast("long")})
    kinds = kinds.withColumns({
        "_range": F.shiftrightunsigned("_hash", 52), "_all": F.col("_each") * F.col("_n"),
    })
    within = Window.partitionBy(by, "_range").orderBy("_hash", *identity)
    before = Window.partitionBy(by).orderBy("_range")
    totals = kinds.groupBy(by, "_range").agg(F.sum("_all").alias("_base"))
    starts = totals.select(
        F.col(by).alias("_by"), F.col("_range").alias("_by_range"),
        (F.sum("_base").over(before) - F.col("_base")).alias("_base"),
    )
    on = F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_by_range"))
    kinds = kinds.withColumn("_before", F.sum("_all").over(within) - F.col("_all"))
    kinds = kinds.join(starts, on).select(
        *[F.col(c).alias(f"_k_{c}") for c in keys], "_n", "_each",
        (F.col("_before") + F.col("_base")).alias("_start"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    known = rows.join(kinds, same).drop(*[f"_k_{c}" for c in keys])
    known = known.withColumn("_kind", F.struct(by, "_start"))
    single = known.where("_n = 1").withColumn("_copy", F.lit(0).cast("long"))
    several = running_sums(known.where("_n > 1"), "_kind", F.lit(1), "_copy")
    placed = single.unionByName(several)
    return placed.withColumn(out, F.col("_start") + F.col("_copy") * F.col("_each")).drop(
        "_n", "_each", "_start", "_kind", "_copy"
    )
