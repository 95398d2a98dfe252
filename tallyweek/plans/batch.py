"""The whole batch: a landing area to a published edition of tables, reports and rejects.

Each landed file is read once, by the run that first sees it: every row is typed, tagged
with the reason it leaves, if it does, and written to ``rows``, kept and rejected beside
each other. All else is computed from that table. A later run may read new and changed
files only and compile the years again that they touch.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.columns import typed_empty
from tallyweek.operators import reject
from tallyweek.operators.combine import union_sources
from tallyweek.plans.facts import SOURCES, finish_facts, reports
from tallyweek.rules import DEFAULT, Rules
from tallyweek.schema import FACT, JURISDICTIONS, ROW_ORD, SOURCE_COLUMNS
from tallyweek.sources.marks import MARKS, marked_layout, normalised
from tallyweek.sources.publish import Edition, Landed, following, latest, publish
from tallyweek.sources.scan import landed_files, read_years, scan_csv
from tallyweek.sources.sinks import NO_YEAR, places, together, write_extracts, write_reports, write_years

#: Steps whose rows the batch counts.
STEPS = [f"{name} {step}" for name in SOURCES for step in ("read", "normalised")] + ["cleaned"]

ROWS = T.StructType(
    [*marked_layout(ROW_ORD).fields, T.StructField("run", T.StringType()), T.StructField("verdict", T.StringType()),
     T.StructField("source", T.StringType())]
)
CLEANED = T.StructType(
    [
        *[T.StructField(name, FACT[name].dataType) for name in SOURCE_COLUMNS],
        T.StructField("source_ord", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("kept_source", T.StringType()),
        T.StructField("kept_deaths", T.DoubleType()),
        T.StructField("verdict", T.StringType()),
    ]
)

Inputs = dict[tuple[str, str], Landed]


def _verdict() -> Column:
    return F.when(F.col("reason").isNull(), F.lit("kept")).otherwise(F.lit("rejected")).alias("verdict")


def _land(spark: SparkSession, fresh: Iterable[tuple[str, str]], out: str, run: str, rules: Rules, multiline: bool) -> dict[str, str]:
    """Tag the rows of the files and write them, all sources in one partitioned write."""
    marked = None
    for name, mark in MARKS.items():
        paths = sorted(path for source, path in fresh if source == name)
        scanned = scan_csv(spark, paths, row_order=True, multiline=multiline, rescue=True) if paths else None
        rows = None if scanned is None else mark(scanned, rules)
        if rows is not None:
            rows = rows.select("*", _verdict(), F.lit(name).alias("source"))
            marked = rows if marked is None else marked.unionByName(rows, allowMissingColumns=True)
    if marked is None:
        return {}
    marked.write.partitionBy("verdict", "source").parquet(f"{out}/rows/run={run}")
    return {run: f"rows/run={run}"}


def _rows(spark: SparkSession, out: str, parts: dict[str, str], inputs: Inputs) -> DataFrame:
    """Tagged rows of the files, each as the run left it that read it."""
    if not parts or not inputs:
        return typed_empty(spark, ROWS)
    rows = spark.read.schema(ROWS).option("basePath", f"{out}/rows").parquet(*(f"{out}/{part}" for part in parts.values()))
    files = [(landed.read_in, source, path) for (source, path), landed in inputs.items()]
    live = spark.createDataFrame(files, "l_run string, l_source string, l_file string")
    same = (F.col("run") == F.col("l_run")) & (F.col("source") == F.col("l_source")) & (F.col("row_ord.file") == F.col("l_file"))
    return rows.join(live, same, "left_semi")


def _year() -> Column:
    return F.col("year").try_cast("int")


def _years(rows: DataFrame) -> set[int]:
    """Years of the kept rows."""
    found = reject.kept(rows).select(_year().alias("year")).dropna().distinct()
    return {r.year for r in found.collect()}


def _clean(rows: DataFrame, present: Iterable[str], rules: Rules, jurisdictions: Sequence[str], years: set[int] | None) -> DataFrame:
    """Fold, merge and tag the kept rows of the years; rows without a year belong to every run."""
    if years is not None:
        rows = rows.filter(_year().isNull() | _year().isin(sorted(years)))
    kept = reject.kept(rows)
    sources = [
        normalised(name, kept.filter(F.col("source") == name).drop("run", "verdict", "source"), rules) if name in present else None
        for name in SOURCES
    ]
    merged = union_sources(sources)
    if merged is None:
        return typed_empty(rows.sparkSession, CLEANED)
    tagged = reject.mark_cleaning(merged, rules, jurisdictions).withColumn("verdict", _verdict())
    known = [F.col(f.name) if f.name in tagged.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CLEANED.fields]
    return tagged.select(*known)


def _settings(population: DataFrame, rules: Rules, multiline: bool, jurisdictions: Sequence[str]) -> dict[str, str]:
    """What rows of all files depend on; a change of any of it compiles everything again."""
    entry = F.xxhash64("year", "state", "population").cast("decimal(38,0)")
    row = population.agg(F.count(F.lit(1)).alias("n"), F.sum(entry).alias("sum")).collect()[0]
    return {"rules": repr(rules), "multiline": str(multiline), "jurisdictions": ",".join(jurisdictions), "population": f"{row.n} {row.sum}"}


def compile_landing(
    spark: SparkSession,
    landing: str,
    population: DataFrame,
    out: str,
    rules: Rules = DEFAULT,
    multiline: bool = False,
    changed_only: bool = False,
    jurisdictions: Sequence[str] = tuple(JURISDICTIONS),
) -> dict[str, str]:
    """Read a landing area, compile, and publish tables, extracts, reports, counts and rejects as one edition.

    With ``changed_only`` files that the last edition read and that are unchanged (path, size, time) are not read
    again, and only the years that new, changed or removed files touch are compiled again; all other years keep
    their files. The result is that of a full run. Other rules, jurisdictions or population, and rules that fold
    by what all data hold ("data"), make it a full run.
    """
    out = out.rstrip("/")
    before = latest(spark, out)
    number, run = following(before)
    found: dict[tuple[str, str], tuple[int, int]] = {}
    for name in SOURCES:
        listing = landed_files(spark, landing, name)
        found |= {} if listing is None else {(name, r.path): (r.length, r.modified) for r in listing.collect()}
    settings = _settings(population, rules, multiline, jurisdictions)
    reuse = before if changed_only and before and before.settings == settings and rules.fold != "data" else None
    known = reuse.inputs if reuse else {}
    unchanged = {key for key, of in found.items() if key in known and (known[key].length, known[key].modified) == of}
    inputs = {key: known[key] if key in unchanged else Landed(*of, run) for key, of in found.items()}

    fresh = inputs.keys() - unchanged
    added = _land(spark, fresh, out, run, rules, multiline)
    still = {landed.read_in for landed in inputs.values()}
    parts = {of: path for of, path in (reuse.tables["rows"] if reuse else {}).items() if of in still} | added
    rows = _rows(spark, out, parts, inputs)
    years = None
    if reuse:
        left = {key: landed for key, landed in known.items() if key not in unchanged}
        years = _years(_rows(spark, out, reuse.tables["rows"], left)) | _years(_rows(spark, out, added, {k: inputs[k] for k in fresh}))

    # a source whose files all lack a column it needs has no rows and is as absent as one without files
    landed = {(r.source, r.reason): r.n for r in rows.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    present = {source for source, _ in landed}
    untouched = {} if years is None else {y: p for y, p in reuse.tables["cleaned"].items() if y != NO_YEAR and int(y) not in years}
    new = write_years(_clean(rows, present, rules, jurisdictions, years), out, "cleaned", run, ("verdict",))
    cleaned = read_years(spark, out, "cleaned", untouched | new, CLEANED)
    facts = finish_facts(reject.kept(read_years(spark, out, "cleaned", new, CLEANED)).select(*SOURCE_COLUMNS), population)
    old = {y: p for y, p in reuse.tables["compiled"].items() if y in untouched} if reuse else {}
    compiled = old | write_years(facts, out, "compiled", run)

    table = read_years(spark, out, "compiled", compiled)
    tables = {"rows": parts, "cleaned": untouched | new, "compiled": compiled}
    described = reports(table) | {"source_conflicts": reject.source_conflicts(cleaned)}
    for written in together(
        lambda: write_extracts(table, out, run),
        lambda: _write_counts(landed, cleaned, out, run),
        lambda: write_reports(described, out, run),
    ):
        tables |= written
    edition = Edition(number, run, tables, inputs, settings)
    publish(spark, out, edition)
    return places(edition, out)


def _write_counts(landed: Mapping[tuple[str, str | None], int], cleaned: DataFrame, out: str, run: str) -> dict[str, dict[str, str]]:
    """Rows after each of STEPS, and rows that left by source, stage and reason.

    Both are sums of the same two counts per source and reason, of which there are a few dozen: what a source
    has read is what it rejects, sums into others and passes on.
    """
    spark = cleaned.sparkSession
    names = list(SOURCES)
    by_source = cleaned.groupBy("source_ord", "reason").agg(F.count(F.lit(1)).alias("n")).collect()
    merged = {(names[r.source_ord], r.reason): r.n for r in by_source}
    counts, rejected = [], []
    for name in names:
        read = sum(n for (source, _), n in landed.items() if source == name)
        normal = sum(n for (source, _), n in merged.items() if source == name)
        counts += [read, normal]
        rejected += [(name, "normalise", reason, n) for (source, reason), n in sorted(landed.items(), key=str) if source == name and reason]
        rejected.append((name, "fold", reject.SUMMED, landed.get((name, None), 0) - normal))
        rejected += [(name, "clean", reason, n) for (source, reason), n in sorted(merged.items(), key=str) if source == name and reason]
    counts.append(sum(n for (_, reason), n in merged.items() if reason is None))
    steps = spark.createDataFrame(list(zip(range(len(STEPS)), STEPS, counts)), "step int, stage string, rows long")
    gone = spark.createDataFrame([r for r in rejected if r[3]], "source string, stage string, reason string, rows long")
    for name, frame in (("counts", steps), ("rejects", gone)):
        frame.coalesce(1).write.option("header", True).csv(f"{out}/{name}/run={run}")
    return {name: {"": f"{name}/run={run}"} for name in ("counts", "rejects")}


def rejected_rows(spark: SparkSession, out: str) -> DataFrame | None:
    """Every rejected row of the last edition: source, file, stage, reason, raw and what replaced it.

    ``raw`` is the landed row, of a malformed line the line itself; rows that leave after the fold have the folded
    row instead. None where nothing was published by ``compile_landing``.
    """
    out = out.rstrip("/")
    edition = latest(spark, out)
    if edition is None or "rows" not in edition.tables:
        return None
    nothing = F.lit(None).cast("string")
    rows = _rows(spark, out, edition.tables["rows"], edition.inputs).filter(F.col("verdict") == "rejected")
    early = rows.select("source", F.col("row_ord.file").alias("file"), F.lit("normalise").alias("stage"), "reason", "raw", nothing.alias("kept_source"))
    cleaned = read_years(spark, out, "cleaned", edition.tables["cleaned"], CLEANED).filter(F.col("verdict") == "rejected")
    name = F.get(F.array(*(F.lit(source) for source in SOURCES)), F.col("source_ord"))
    late = cleaned.select(
        name.alias("source"), nothing.alias("file"), F.lit("clean").alias("stage"), "reason",
        F.to_json(F.struct(*SOURCE_COLUMNS)).alias("raw"), "kept_source",
    )
    return early.unionByName(late)
