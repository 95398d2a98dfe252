"""Editions of an output folder: what a reader sees changes as a whole, or not at all.

A batch writes its tables to folders of its own run and appends one file to the manifest
when all are written. Readers take what the last run in the manifest names. A batch that
fails on the way leaves files that nobody names, and the edition before stays as it was.
A run may name partitions of earlier runs, so what did not change is not written again.

One batch at a time may write to a folder. Files that no edition names stay until they
are removed by hand.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: partition column of a run in tables that live in several.
RUN = T.StructField("run", T.StringType())

MANIFEST = T.StructType(
    [
        T.StructField("number", T.LongType()),
        RUN,
        # "table", "input" or "setting"
        T.StructField("kind", T.StringType()),
        # table, source or setting
        T.StructField("name", T.StringType()),
        # partition of a table, value of a setting
        T.StructField("part", T.StringType()),
        # folder below the published one, or landed file
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.LongType()),
        T.StructField("read_in", T.StringType()),
    ]
)


def if_present(load: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return load()
    except AnalysisException as error:
        # no such path, or a folder without any file
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class Landed:
    """A landed file as it was read."""

    length: int
    modified: int
    read_in: str


@dataclass(frozen=True)
class Edition:
    number: int
    run: str
    #: table -> partition ("" where it has none) -> folder below the published one.
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    #: (source, path) -> the file.
    inputs: dict[tuple[str, str], Landed] = field(default_factory=dict)
    #: what all rows depend on.
    settings: dict[str, str] = field(default_factory=dict)


def _manifest(out: str) -> str:
    return f"{out.rstrip('/')}/manifest"


def latest(spark: SparkSession, out: str) -> Edition | None:
    """The edition published last; None where nothing was published. Reads the small manifest."""
    rows = if_present(lambda: spark.read.schema(MANIFEST).json(_manifest(out)))
    found = [] if rows is None else rows.filter(F.col("number") == rows.agg(F.max("number")).scalar()).collect()
    if not found:
        return None
    edition = Edition(found[0].number, found[0].run)
    for row in found:
        if row.kind == "table" and row.path is not None:
            edition.tables.setdefault(row.name, {})[row.part] = row.path
        elif row.kind == "table":
            edition.tables.setdefault(row.name, {})
        elif row.kind == "input":
            edition.inputs[row.name, row.path] = Landed(row.length, row.modified, row.read_in)
        else:
            edition.settings[row.name] = row.part
    return edition


def following(previous: Edition | None) -> tuple[int, str]:
    """Number and run of the next edition. Runs are unique, so nothing that a failed one left is ever named."""
    number = 1 if previous is None else previous.number + 1
    return number, f"{number:06d}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, out: str, edition: Edition) -> None:
    """Switch the readers to an edition whose tables are all written: one file, which appears by a rename."""
    own = (edition.number, edition.run)
    rows = [(*own, "setting", name, value, None, None, None, None) for name, value in edition.settings.items()]
    for name, parts in edition.tables.items():
        # a table without any partition is there, and empty
        rows += [(*own, "table", name, part, path, None, None, None) for part, path in parts.items()] or [
            (*own, "table", name, None, None, None, None, None)
        ]
    for (source, path), landed in edition.inputs.items():
        rows.append((*own, "input", source, None, path, landed.length, landed.modified, landed.read_in))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(_manifest(out))
