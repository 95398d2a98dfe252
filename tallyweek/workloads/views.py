"""Surveillance-shaped views over the star-schema tables.

``weekly`` counts orders per customer nation and week; the years move by 20 so
that 1995-2001 lands on 2015-2021. Every other view starts from it, from the
customer counts (population) or from the event stream (dirty text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions.calendar import epi_week, week_ending
from tallyweek.schema import CITY, CITY_PARENT, JURISDICTIONS, NATIONAL

YEAR_SHIFT = 20
#: days of 1043 weeks, about as many years.
DATE_SHIFT = 7301
#: days by which a third of the events go back, from 2024 to 2019.
EVENT_SHIFT = 1827
_OTHERS = [name for name in JURISDICTIONS if name not in (NATIONAL, CITY_PARENT)]
#: nation key -> jurisdiction, for operators that look for known names.
FACT_NAMES = [NATIONAL, CITY_PARENT, *_OTHERS[:23]]
#: the same with the city as a jurisdiction of its own, as raw sources have it.
SOURCE_NAMES = [NATIONAL, CITY_PARENT, CITY, *_OTHERS[:22]]
#: nation key -> label for the fold.
FOLD_NAMES = {0: NATIONAL, 1: CITY_PARENT, 2: CITY, 3: "Bronx NYC", 4: "nyc lower"}
#: label of an event's user for the dirty single-year file.
EVENT_NAMES = [NATIONAL, CITY_PARENT, CITY, "Bronx NYC", "Ohio", "Texas", "Total", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """The folder of a query that writes, in the place all executors share.

    A query has one folder per application and overwrites what it wrote before.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tallyweek/{spark.sparkContext.applicationId}/{name}"


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as (o_custkey, day)."""
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nk, state, year, week, mmwr_week, week_ending_date, deaths.

    Rows are counted by nation key and closing Saturday, which is all a row has
    to compute; week number, year and nation name follow on the counted rows.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    counted = (
        order_days(spark, sf_dir)
        .select("o_custkey", week_ending(F.col("day")).alias("saturday"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nk"), "saturday")
        .agg(F.count(F.lit(1)).alias("deaths"))
    )
    year, week = epi_week(F.col("saturday"), "first_sunday")
    return counted.join(nations, F.col("nk") == F.col("n_nationkey")).select(
        "nk",
        F.col("n_name").alias("state"),
        (year + YEAR_SHIFT).alias("year"),
        week.alias("week"),
        week.alias("mmwr_week"),
        F.col("saturday").cast("string").alias("week_ending_date"),
        "deaths",
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nk, state, year, population, with gaps on purpose."""
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nk")).count()
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    years = counts.join(nations, F.col("nk") == F.col("n_nationkey")).select(
        "nk", "state", "count", F.explode(F.sequence(F.lit(2015), F.lit(2021))).alias("year")
    )
    kept = ((F.col("nk") + F.col("year")) % 3 != 0) & ~((F.col("nk") == 24) & (F.col("year") > 2015))
    return years.filter(kept).select(
        "nk", "state", "year", (F.col("count") * 1000 + (F.col("year") - 2015) * 10).alias("population")
    )


def _name_of(names: list[str], key: str = "nk") -> Column:
    return F.get(F.array(*(F.lit(n) for n in names)), F.col(key))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weekly`` under jurisdiction names, one of them national."""
    return weekly(spark, sf_dir).withColumn("state", _name_of(FACT_NAMES))


def facts_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population(spark, sf_dir).withColumn("state", _name_of(FACT_NAMES))


def foldable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weekly`` with a city, two look-alikes and a national total among the states."""
    label = F.col("state")
    for key, name in FOLD_NAMES.items():
        label = F.when(F.col("nk") == key, F.lit(name)).otherwise(label)
    return weekly(spark, sf_dir).withColumn("state", label)


def two_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Source A: dated rows of even nations. Source B: rows of all, dated for every sixth nation.

    Every sixth nation so has equally complete rows in both.
    """
    rows = weekly(spark, sf_dir)
    columns = ["year", "week", "mmwr_week", "state", "deaths"]
    dated = rows.filter(F.col("nk") % 2 == 0).select(*columns, "week_ending_date", F.lit("A").alias("data_source"))
    date = F.when(F.col("nk") % 6 == 0, F.col("week_ending_date")).alias("week_ending_date")
    tens = rows.withColumn("deaths", F.col("deaths") * 10)
    return [dated, tens.select(*columns, date, F.lit("B").alias("data_source"))]


def uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``facts`` with one state missing in 2019 and another in 2018."""
    gone = (F.col("nk") == 5) & (F.col("year") == 2019)
    late = (F.col("nk") == 6) & (F.col("year") == 2018)
    return facts(spark, sf_dir).filter(~gone & ~late)


def number_text(key: Column) -> Column:
    """Event id as clean or dirty numeric text."""
    kind = key % 7
    return (
        F.when(kind == 0, F.lit("1,234"))
        .when(kind == 1, F.lit(" 12 "))
        .when(kind == 2, F.lit("2019/2020"))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.lit("nan"))
        .when(kind == 5, F.lit("1.0d"))
        .otherwise(key.cast("string"))
    )


def date_text(key: Column, day: Column) -> Column:
    """A date in one of four spellings."""
    kind = key % 4
    return (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "M/d/yyyy"))
        .when(kind == 2, F.date_format(day, "yyyy/M/d"))
        .otherwise(F.date_format(day, "d/M/yyyy"))
    )


#: pattern of each spelling of a date, by event id; one is not a date.
SPELLINGS = [
    "yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "d/M/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "MM-dd-yyyy", "d MMMM yyyy", "MMM d yyyy",
    "MMMM d, yyyy", "yyyy.MM.dd", "M/d/yy", "EEEE, MMMM d, yyyy", "yyyy-MM-dd'T'HH:mm:ss", "'week' d 'of' yyyy",
]


def any_date_text(key: Column, day: Column) -> Column:
    """A date in one of SPELLINGS."""
    kind, text = key % len(SPELLINGS), F.lit(None).cast("string")
    for number, pattern in enumerate(SPELLINGS):
        text = F.when(kind == number, F.date_format(day, pattern)).otherwise(text)
    return text


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, day, label, number text, date text, year and week as numbers."""
    key, day = F.col("event_id"), F.col("ts").cast("date")
    label = F.get(F.array(*(F.lit(n) for n in EVENT_NAMES)), (F.col("user_id") % 8).cast("int"))
    return table(spark, sf_dir, "events").select(
        key,
        day.alias("day"),
        label.alias("label"),
        number_text(key).alias("number"),
        date_text(key, day).alias("date"),
        (F.lit(2014) + key % 8).cast("int").alias("year"),
        (key % 56).cast("int").alias("week"),
    )


def raw_dated_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is of five years before the others."""
    key = F.col("event_id")
    day = F.when(key % 3 == 0, F.date_sub("day", EVENT_SHIFT)).otherwise(F.col("day"))
    return dirty_events(spark, sf_dir).select(
        date_text(key, day).alias("Week Ending Date"),
        F.col("label").alias("Jurisdiction of Occurrence"),
        F.col("number").alias("All Cause"),
    )


def raw_country_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return dirty_events(spark, sf_dir).select(
        F.when(key % 3 == 0, F.lit("France")).otherwise(F.lit(NATIONAL)).alias("country_name"),
        F.when(key % 11 == 0, F.lit("x")).otherwise(F.col("year").cast("string")).alias("year"),
        F.col("week").cast("string").alias("time"),
        F.when(key % 5 == 0, F.lit("monthly")).otherwise(F.lit("weekly")).alias("time_unit"),
        F.col("number").alias("deaths"),
    )


def raw_provisional(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return dirty_events(spark, sf_dir).select(
        F.when(key % 11 == 0, F.lit("2019/2020")).otherwise(F.col("year").cast("string")).alias("Year"),
        F.when(key % 13 == 0, F.lit("")).otherwise(F.col("week").cast("string")).alias("MMWR Week"),
        F.col("date").alias("Week Ending Date"),
        F.col("label").alias("State"),
        F.col("number").alias("Total Deaths"),
    )


def raw_packed_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    packed = (F.col("year") * 100 + F.col("week")).cast("string")
    return dirty_events(spark, sf_dir).select(
        F.when(key % 9 == 0, F.lit("18-64")).otherwise(F.lit("All")).alias("age"),
        F.when(key % 11 == 0, F.lit("abc")).otherwise(packed).alias("MMWR Year/Week"),
        F.col("label").alias("State"),
        F.col("number").alias("All Deaths"),
    )


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four raw layouts cut out of ``weekly``, with dirt in each.

    The dated file's Saturdays move by whole weeks to about the year of their rows.
    """
    rows = weekly(spark, sf_dir).withColumn("label", _name_of(SOURCE_NAMES))
    saturday = F.date_add(F.col("week_ending_date").cast("date"), DATE_SHIFT)
    nk, year, week, deaths = (F.col(c) for c in ("nk", "year", "week", "deaths"))
    us_date = F.date_format(F.col("week_ending_date").cast("date"), "M/d/yyyy")
    text = deaths.cast("string")
    return {
        "dated_file": rows.filter(year == 2019).select(
            F.when(nk % 2 == 0, saturday.cast("string")).otherwise(F.date_format(saturday, "M/d/yyyy")).alias("Week Ending Date"),
            F.col("label").alias("Jurisdiction of Occurrence"),
            F.when((nk == 7) & (week % 10 == 0), F.lit("1,234")).otherwise(text).alias("All Cause"),
        ),
        "country_series": rows.filter(nk.isin(0, 3)).select(
            F.when(nk == 0, F.lit(NATIONAL)).otherwise(F.lit("France")).alias("country_name"),
            year.cast("string").alias("year"),
            week.cast("string").alias("time"),
            F.when(week == 53, F.lit("monthly")).otherwise(F.lit("weekly")).alias("time_unit"),
            (deaths * 10).cast("string").alias("deaths"),
        ),
        "packed_week": rows.filter(year <= 2019).select(
            F.when(nk % 9 == 8, F.lit("18-64")).otherwise(F.lit("All")).alias("age"),
            F.when((nk == 10) & (week == 7), F.lit("abc"))
            .otherwise((year * 100 + week).cast("string"))
            .alias("MMWR Year/Week"),
            F.col("label").alias("State"),
            text.alias("All Deaths"),
        ),
        "provisional": rows.filter(year >= 2019).select(
            F.when((nk == 11) & (week == 9), F.lit("2019/2020")).otherwise(year.cast("string")).alias("Year"),
            F.when((nk == 12) & (week == 3), F.lit("54")).otherwise(week.cast("string")).alias("MMWR Week"),
            us_date.alias("Week Ending Date"),
            F.col("label").alias("State"),
            F.when((nk == 13) & (week == 2), F.lit("0"))
            .otherwise((deaths + 1).cast("string"))
            .alias("Total Deaths"),
        ),
    }


def revised_packed_week(rows: DataFrame) -> DataFrame:
    """A later edition of the packed file: 2015 is gone, the counts of 2016 are twice as high."""
    year = F.substring("`MMWR Year/Week`", 1, 4)
    twice = (F.col("All Deaths").cast("bigint") * 2).cast("string")
    kept = rows.filter(year != "2015")
    return kept.withColumn("All Deaths", F.when(year == "2016", twice).otherwise(F.col("All Deaths")))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a provisional file as one column, whose name is the header: well formed, short, long, with an open quote."""
    key = F.col("event_id")
    start = F.concat_ws(",", F.col("year"), F.col("week"))
    date, state = F.date_format("day", "yyyy-MM-dd"), F.coalesce("label", F.lit(""))
    line = (
        F.when(key % 5 == 0, F.concat_ws(",", start, date, state, F.lit("7")))
        .when(key % 5 == 1, F.concat_ws(",", start, date, state))
        .when(key % 5 == 2, F.concat_ws(",", start, date, state, F.lit("7,extra")))
        .when(key % 5 == 3, F.concat(start, F.lit(',"'), date, F.lit(","), state, F.lit(",7")))
        .otherwise(F.concat(start, F.lit(","), date, F.lit(',"'), state, F.lit('",7')))
    )
    return dirty_events(spark, sf_dir).select(line.alias("Year,MMWR Week,Week Ending Date,State,Total Deaths"))
