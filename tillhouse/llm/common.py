"""What the corpus operators share: word splitting, stored intermediates, row numbering over stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.session import scratch_path

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# Rows of a stored file that are numbered together.
BLOCK_ROWS = 65_536


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_written: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and its size is known.

    The planner broadcasts such a table by the size of its files, so a hint is never needed.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_paths() -> list[str]:
    """What `stored` has written so far, in order."""
    return list(_written)


def drop_scratch(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete stored tables that no frame in use reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def words_of(text: Column) -> Column:
    """Array of words; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """A column name no input column has (names are compared without case, as Spark does)."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted


def numbered(table: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Number the rows of a stored table from 0 within each key, without gaps, however large a key is.

    A row is told from its equals by file and place in the file, so a repeated task numbers alike. Rows are counted
    by key and block of a file, the counts are summed up per key, and only rows of one block meet in a window.
    The running sum per key sees one row per block: 1/65,536 of the table.
    """
    placed = table.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    placed = placed.withColumn("_block", F.floor(F.col("_at") / F.lit(BLOCK_ROWS)))
    counts = placed.groupBy(*keys, "_file", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    order = Window.partitionBy(*keys).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_file").alias("_b_file"),
                           F.col("_block").alias("_b_block"),
                           F.coalesce(F.sum("_rows").over(order), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_file", "_block").orderBy("_at")
    same = (F.col("_file") == F.col("_b_file")) & (F.col("_block") == F.col("_b_block"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (placed.withColumn("_in", F.row_number().over(inside) - 1).join(starts, same)
            .select(*table.columns, (F.col("_start") + F.col("_in")).cast("long").alias(number)))
