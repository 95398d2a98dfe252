"""Table contracts and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

NATIONAL = "United States"
CITY = "New York City"
CITY_ABBREVIATION = "NYC"
CITY_PARENT = "New York"

# Names that mark a national total rather than a jurisdiction.
NATIONAL_VARIANTS = ["United States", "US", "USA", "National", "Total"]

# The jurisdictions a fact row may carry.
JURISDICTIONS = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware",
    "District of Columbia", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas",
    "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi",
    "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey", "New Mexico", "New York",
    "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Puerto Rico",
    "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas", "United States", "Utah", "Vermont",
    "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
]

# Provenance labels of the output column ``data_source``.
LABEL_DATED_FILE = "Local 2019 File"
LABEL_COUNTRY_SERIES = "World Mortality Dataset"
LABEL_PACKED_WEEK = "Archived NCHS"
LABEL_PROVISIONAL = "CDC Provisional"
LABEL_ROLLUP = "Calculated from State Data"

# Source headers and their canonical names.
COUNTRY_SERIES_NAMES = {"country_name": "country", "time": "week", "time_unit": "period_type"}
PACKED_WEEK_NAMES = {"State": "state", "All Deaths": "deaths"}
PACKED_WEEK_KEY = "MMWR Year/Week"
PROVISIONAL_NAMES = {
    "Year": "year",
    "MMWR Week": "mmwr_week",
    "Week Ending Date": "week_ending_date",
    "State": "state",
    "Total Deaths": "total_deaths",
}

# Text that delimited files use for a missing cell.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: columns every normalised source carries (a source may lack the date).
SOURCE_COLUMNS = ["year", "week", "mmwr_week", "week_ending_date", "state", "deaths", "data_source"]

#: a normalised source before cleaning: weeks and years are still doubles,
#: because fractional text is legal until the cleaning step truncates it.
SOURCE = T.StructType(
    [
        T.StructField("year", T.DoubleType()),
        T.StructField("week", T.DoubleType()),
        T.StructField("mmwr_week", T.DoubleType()),
        T.StructField("week_ending_date", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("deaths", T.DoubleType()),
        T.StructField("data_source", T.StringType()),
    ]
)

#: the output table, unique on (year, week, state).
FACT = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("mmwr_week", T.IntegerType()),
        T.StructField("week_ending_date", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("deaths", T.DoubleType()),
        T.StructField("population", T.LongType()),
        T.StructField("mortality_rate_per_100k", T.DoubleType()),
        T.StructField("data_source", T.StringType()),
    ]
)
FACT_COLUMNS = FACT.fieldNames()

POPULATION = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("population", T.LongType()),
    ]
)

#: place of a row in the landed files.
ROW_ORD = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("position", T.LongType()),
    ]
)
