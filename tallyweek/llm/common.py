"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII white-space characters.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one task numbers in a distributed ranking.
RANK_ROWS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, of ``spark.checkpoint.dir``.

    Where the session names none, a session that is one process (tests) gets a private one; on a cluster that is
    an error, as a folder of this machine would be lost to the others.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="run-llm-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def numbered(df: DataFrame, group: str, order: list[str], name: str, rows: int) -> DataFrame:
    """Add a gapless number from 0 within each group, however large a group is.

    Rows are dealt to cells by the hash of ``order``; a task numbers one cell of
    one group, and the cells' sizes give each cell its start. The input must be
    reproducible (checkpointed or a plain scan).
    """
    cells = max(1, -(-rows // RANK_ROWS))
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    starts = (
        dealt.groupBy(group, "_cell")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.sum("_rows").over(Window.partitionBy(group).orderBy("_cell")) - F.col("_rows"))
        .select(F.col(group).alias("_group"), F.col("_cell").alias("_in_cell"), "_start")
    )
    within = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)) - 1
    return (
        dealt.withColumn("_within", within)
        .join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_cell") == F.col("_in_cell")))
        .withColumn(name, (F.col("_start") + F.col("_within")).cast("long"))
        .drop("_cell", "_in_cell", "_within", "_start", "_group")
    )
