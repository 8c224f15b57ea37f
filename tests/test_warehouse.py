import json

import pytest
from landing import BLOCK_GROUPS, YEARS, estimate, land_everything
from pyspark.sql import functions as F

from civicloom.plans import build, health, reports
from civicloom.plans.layers import Warehouse


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("house")
    house = Warehouse(spark, str(root / "tables"), prefix="t_")
    made = build.run(house, land_everything(root / "landing"))
    return house, made


def test_every_layer_is_filled(built):
    house, made = built
    assert len(made["bronze"]) == 25 and len(made["silver"]) == 25
    assert set(health.CATEGORY_REPORTS.values()) <= set(made["main"]) and len(made["main"]) == 55
    assert made["main"] == house.tables("main")
    # Subject tables have no block-group rows.
    assert made["skipped_concepts"] == ["fact_concept_s1501_bg"] and made["shared_labels"] == []


def test_requested_variables_that_no_dictionary_lists(built):
    _, made = built
    unknown = [f"{g}/{y}/B00000_001" for g in ("block group", "place") for y in YEARS]
    assert made["missing_variables"] == sorted([*unknown, "block group/2023/B28002_013", "place/2023/B28002_013"])


def test_no_key_is_broken(built):
    house, _ = built
    assert build.integrity(house) == []


def test_calendar(built):
    house, _ = built
    dates, years = house.table("gold", "dim_date"), house.table("gold", "dim_year")
    assert dates.count() == 22280 and years.count() == 61
    day = dates.where("date_key = '2024-02-29'").first()
    assert (day.month_name, day.day_name, day.is_weekend, day.calendar_quarter) == ("February", "Thursday", False, 1)


def test_observations_are_clean(built):
    house, _ = built
    places = house.table("silver", "acs_place")
    assert {r.GEOID for r in places.select("GEOID").distinct().collect()} == {"37001", "37002", "37003"}
    rent = places.where("variable = 'B25064_001' AND GEOID = '37002'")
    assert {r.vintage_year: r.estimate for r in rent.collect()} == {
        2023: None,
        2024: float(estimate("37002", 2024, "B25064_001")),
    }
    assert places.where("variable LIKE 'S%' AND moe IS NOT NULL").count() == 0
    assert places.where("variable LIKE 'B%' AND moe IS NULL").count() == 0


def test_concept_facts_have_estimates_then_margins(built):
    house, _ = built
    fact = house.table("gold", "fact_concept_b25003_town")
    assert fact.columns == [
        "place_GEOID", "year_key", "total_line_b25003_002", "total_line_b25003_003",
        "total_line_b25003_002_moe", "total_line_b25003_003_moe",
    ]
    assert fact.count() == 6


def test_town_report_values(built):
    house, _ = built
    row = house.table("main", "agg_town_educational_attainment").where("GEOID = '37001' AND year = 2024").first()
    lines = {n: estimate("37001", 2024, f"B15003_{n:03d}") for n in range(1, 26)}
    assert row.town == "Davidson" and row.n_less_than_hs == sum(lines[n] for n in range(2, 17))
    assert row.pct_bachelors == pytest.approx(100 * lines[22] / lines[1], abs=0.005)


def test_a_missing_variable_or_table(built):
    """A variable absent from one vintage drops that area and year, as an inner join does."""
    house, _ = built
    tables = {r.year for r in house.table("main", "analytics_infrastructure_accessibility").collect()}
    # B28002 has another line in 2023, so the row stays and its rate is missing.
    assert tables == set(YEARS)
    rates = house.table("main", "analytics_infrastructure_accessibility").where("year = 2023")
    assert {r.household_no_internet_rate_pct for r in rates.collect()} == {None}


def test_neighborhoods_overlap_on_purpose(built):
    house, _ = built
    table = house.table("main", "agg_neighborhood_demographics")
    shared = table.where("GEOID = '371190064111' AND year = 2024")
    assert {r.neighborhood_name for r in shared.collect()} == {"Smithville", "East Catawba"}
    assert all("CONFLICT" in r.disclaimer for r in shared.collect())
    assert table.count() == len(YEARS) * sum(map(len, reports.NEIGHBORHOOD_BLOCK_GROUPS.values()))


def test_boundaries(built):
    house, _ = built
    areas = house.table("gold", "dim_bg")
    assert areas.count() == len(BLOCK_GROUPS) and areas.where("geometry IS NULL").count() == 1
    outlines = house.table("main", "agg_neighborhood_geometry_block")
    assert {r.neighborhood_name for r in outlines.collect()} == set(reports.NEIGHBORHOOD_BLOCKS)
    assert json.loads(outlines.where("neighborhood_name = 'Smithville'").first().geometry)["type"] == "Polygon"


def test_housing(built, rows):
    house, _ = built
    levels = rows(house.table("gold", "dim_ami_level"))
    assert levels == [(1, "30% AMI", 30), (2, "50% AMI", 50), (3, "100% AMI", 100)]
    gaps = house.table("main", "agg_charlotte_ami_affordability_gap")
    assert gaps.count() == 9 and gaps.where("fmr IS NULL").count() == 3
    assert gaps.where("monthly_gap >= 0").select("affordability_status").distinct().first()[0] == "Affordable"
    trend = house.table("main", "agg_town_rent_trends").where("town = 'Davidson'").orderBy("date").collect()
    assert [r.prev_rent_value for r in trend] == [None] * 4 + [1000.0] * 2
    assert house.table("main", "agg_town_alice_household").count() == 3
    index = house.table("main", "zillow_market_affordability_index")
    assert index.count() == 6 and index.where("town = 'Davidson' AND year = 2023 AND avg_rent IS NULL").count() == 1


def test_health(built):
    house, _ = built
    outcomes = house.table("main", "agg_town_cdc_health_outcomes")
    assert outcomes.columns == [
        "place_GEOID", "town_name", "year_key", "arthritis_ageadjprv", "arthritis_crdprv", "cancer_ageadjprv", "cancer_crdprv",
    ]
    assert house.table("silver", "cdc_places").first().total_population == 15106
    kinds = {r.facility_type_label: r.county for r in house.table("main", "agg_mhsu_facility_summary").collect()}
    assert kinds == {"Mental Health": "Mecklenburg", "ZZ": "Unknown"}


def test_schools(built, rows):
    house, _ = built
    dims = {r.school_code: (r.town_name, r.place_GEOID) for r in house.table("gold", "dim_school").collect()}
    assert dims["600357"] == ("Davidson", "37001") and dims["999999"] == (None, None)
    labels = {r.subgroup_code: r.subgroup_label for r in house.table("gold", "dim_subgroup").collect()}
    assert labels["NAIG"] == "Not Academically or Intellectually Gifted"
    gap = house.table("main", "agg_school_economic_gap").where("school = 'School 600312'").first()
    assert (gap.econ_disadv, gap.not_disadv, gap.gap) == (23.5, 26.5, 3.0)
    assert house.table("main", "agg_school_scorecard").count() == 4
    growth = house.table("main", "agg_school_growth").first()
    assert growth.reading_growth_status == "Met" and growth.math_growth_status is None
    graduation = house.table("main", "agg_school_graduation")
    assert {r.suppressed for r in graduation.collect()} == {True, False}
    learners = house.table("main", "agg_school_english_learner_progress")
    assert learners.count() == 4


def test_duplicate_rows_are_reported_not_hidden(built):
    house, _ = built
    fact = house.table("gold", "fact_school_workkeys")
    both = fact.unionByName(fact.limit(1))
    report = build.model.key_violations(both, build.FACT_KEYS["fact_school_workkeys"])
    assert report.select(F.col("problem")).collect()[0][0] == "duplicate key"


def test_snapshot_copies_all_layers(built, spark, tmp_path):
    house, _ = built
    copied = house.snapshot(str(tmp_path), layers=["gold"])
    assert len(copied) == len(house.tables("gold"))
    again = spark.read.parquet(str(tmp_path / "gold" / "dim_town"))
    assert again.count() == house.table("gold", "dim_town").count()


def test_reports_are_stored_in_order(built):
    house, _ = built
    for name in ("agg_town_demographics", "agg_mhsu_facility_summary", "agg_neighborhood_blocks", "agg_school_race_gap"):
        files = sorted(house.table("main", name).inputFiles())
        read = [r for f in files for r in house.spark.read.parquet(f).collect()]
        order = reports.STORED_ORDER.get(name, ["town", "year"])
        keys = [tuple(not r[c[1:]] if c[0] == "-" else r[c] for c in order) for r in read]
        assert keys == sorted(keys) and len(keys) > 1


def test_keys_were_counted_by_the_writes(spark, built):
    house, _ = built
    draft = house.draft("gold")
    draft.replace("gold", "fact_alice_county", house.table("gold", "fact_alice_county"), key=build.FACT_KEYS["fact_alice_county"])
    assert draft.key_checks == {("gold", "fact_alice_county"): {"repeated": 0, "null": 0}}
    draft.replace("gold", "dim_county", house.table("gold", "dim_county").where("false"))
    draft.replace("gold", "dim_year", house.table("gold", "dim_year"))
    found = [r for r in build.integrity(draft) if r[0] == "fact_alice_county"]
    assert found == [("fact_alice_county", "county_GEOID", "missing in dimension", 1)]
    draft.discard("gold")
