import duckdb
from pyspark.sql import functions as F

from civicloom.functions import names

HEADERS = [
    "Percent\nLevel 3 and Above\n(GLP)",
    "ACT/WorkKeys  Assessments Indicator Percent",
    "Four-Year Cohort Graduation Rate Percent",
    "2nd Col",
    "Été name",
    " lead ",
    "a__b",
    "_x",
    "100%",
    "%",
    "dup",
    "DUP",
    "School Code",
]


def test_headers_match_the_sql_reader(tmp_path):
    path = tmp_path / "h.csv"
    path.write_text(",".join(f'"{h}"' for h in HEADERS) + "\n" + ",".join("1" * len(HEADERS)) + "\n")
    read = duckdb.sql(
        f"SELECT * FROM read_csv('{path}', delim=',', quote='\"', header=true, normalize_names=true, all_varchar=true)"
    )
    assert names.normalize_names(HEADERS) == read.columns


def test_reserved_words_are_prefixed():
    assert names.normalize_names(["Select", "group", "town"]) == ["_select", "_group", "town"]


def test_label_and_table_slugs(spark):
    row = spark.range(1).select(
        names.label_slug(F.lit("Estimate!!Total:!!Male:!!Bachelor's degree")),
        names.label_slug(F.lit("Estimate!!$25,000 to $49,999")),
        names.table_slug(
            names.concept_title(F.lit("Household Income (in 2024 Inflation-Adjusted Dollars)"))
        ),
        names.table_slug(names.concept_title(F.lit(None).cast("string"))),
        F.length(names.concept_title(F.repeat(F.lit("x"), 300))),
        names.measure_column(F.lit("ARTHRITIS"), F.lit("AgeAdjPrv")),
    )
    assert tuple(row.first()) == (
        "total_male_bachelor_s_degree",
        "25_000_to_49_999",
        "fact_household_income",
        "fact_misc",
        200,
        "arthritis_ageadjprv",
    )
