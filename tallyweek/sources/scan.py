"""Readers. A missing path yields ``None``: sources are allowed to be absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.columns import completeness, typed_empty
from tallyweek.functions.numbers import number_column
from tallyweek.schema import FACT, NA_TOKENS, POPULATION
from tallyweek.sources.publish import RUN, if_present, latest


def blank_to_null(df: DataFrame) -> DataFrame:
    """Null the spellings of a missing cell in every text column."""
    return df.select(
        *(
            F.when(~F.col(f"`{f.name}`").isin(NA_TOKENS), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name != MALFORMED
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema by name, from text where need be.

    Numbers go through double, so a count written as ``4858979.0`` by another
    tool is read as the integer it is. Absent columns are null.
    """

    def cell(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, T.NumericType):
            return number_column(df, field.name).try_cast(field.dataType)
        return F.col(field.name).cast(field.dataType)

    return df.select(*(cell(field).alias(field.name) for field in schema.fields))


#: Column that holds a line whose cells are not as many as the header's, null for all others.
MALFORMED = "_malformed"


def scan_csv(
    spark: SparkSession, path: str | Sequence[str], row_order: bool = False, multiline: bool = False, rescue: bool = False
) -> DataFrame | None:
    """Delimited text with a header; every column is text.

    Only the header line is read to learn the names, never the data. Files stay
    splittable unless ``multiline`` is set for quoted line breaks. With
    ``row_order`` each row carries its position (file, split, offset in split),
    which depends only on the files and so survives a task being run again. With
    ``rescue`` a line with too few or too many cells, also one that a quote left open
    cuts short, stands whole in MALFORMED beside the cells as far as they go.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
    )
    paths = path if isinstance(path, str) else list(path)
    df = if_present(lambda: reader.csv(paths))
    if df is None:
        return None
    if rescue and df.columns:
        if MALFORMED in df.columns:
            raise ValueError(f"a column of {path} is named {MALFORMED}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in [*df.columns, MALFORMED]])
        # all cells are parsed, whichever are read, or a line's surplus would go unseen
        rescuing = reader.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
        df = rescuing.csv(paths)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    if row_order:
        df = df.select("*", position.alias("row_ord"))
    if MALFORMED in df.columns:
        # the reader refuses queries of this column alone: it is bound to a cell, by what always holds
        bound = F.length(F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))) >= 0
        df = df.withColumn(MALFORMED, F.when(bound, F.col(MALFORMED)))
    return blank_to_null(df)


def scan_landing(
    spark: SparkSession, root: str, source: str, row_order: bool = True, multiline: bool = False, rescue: bool = False
) -> DataFrame | None:
    """One source of a landing area: every delimited file in its subfolder."""
    return scan_csv(spark, f"{root.rstrip('/')}/{source}", row_order=row_order, multiline=multiline, rescue=rescue)


def landed_files(spark: SparkSession, root: str, source: str) -> DataFrame | None:
    """path, length and modified (microseconds) of the files of one source, from the file system's listing."""
    files = if_present(lambda: spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{source}"))
    if files is None:
        return None
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_micros(F.col("_metadata.file_modification_time")).alias("modified"),
    )


def malformed_lines(scanned: DataFrame) -> DataFrame:
    """line, cells and rows of the lines that a scan with ``rescue`` found malformed; cells are those that hold a value."""
    cells = completeness(c for c in scanned.columns if c not in (MALFORMED, "row_ord"))
    lines = scanned.filter(F.col(MALFORMED).isNotNull())
    return lines.groupBy(F.col(MALFORMED).alias("line"), cells.alias("cells")).agg(F.count(F.lit(1)).alias("rows"))


def read_years(
    spark: SparkSession, out: str, name: str, parts: Mapping[str, str], schema: T.StructType = FACT
) -> DataFrame:
    """The partitions of a table that lie in folders of several runs, by their places below ``out``."""
    if not parts:
        return typed_empty(spark, schema)
    reader = spark.read.schema(T.StructType([*schema.fields, RUN])).option("basePath", f"{out}/{name}")
    return reader.parquet(*(f"{out}/{part}" for _, part in sorted(parts.items()))).select(schema.fieldNames())


def _scan_typed(spark: SparkSession, path: str, file_format: str, schema: T.StructType) -> DataFrame | None:
    out, _, name = path.rstrip("/").rpartition("/")
    edition = latest(spark, out) if out else None
    if edition is not None and name in edition.tables:
        parts = edition.tables[name]
        if list(parts) != [""]:
            return read_years(spark, out, name, parts, schema)
        path = f"{out}/{parts['']}"
    if file_format == "csv":
        text = scan_csv(spark, path)
        return None if text is None else conform(text, schema)
    return if_present(lambda: spark.read.schema(schema).format(file_format).load(path))


def scan_compiled(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame | None:
    """A compiled fact table, national or by state.

    Where ``path`` is a table of a published folder, the edition that was published last is read, whole.
    """
    return _scan_typed(spark, path, file_format, FACT)


def scan_population(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame | None:
    """The population dimension in long form: year, state, population."""
    return _scan_typed(spark, path, file_format, POPULATION)


def flatten_population(nested: DataFrame) -> DataFrame:
    """``year, populations map<state, count>`` to one row per year and state."""
    return nested.select("year", F.explode("populations").alias("state", "population"))


def population_from_dict(spark: SparkSession, table: Mapping[int, Mapping[str, int]]) -> DataFrame:
    """A small literal dimension ``{year: {state: count}}`` typed in by the user."""
    nested = T.StructType(
        [
            T.StructField("year", T.IntegerType()),
            T.StructField("populations", T.MapType(T.StringType(), T.LongType())),
        ]
    )
    return flatten_population(spark.createDataFrame([(y, dict(s)) for y, s in table.items()], nested))
