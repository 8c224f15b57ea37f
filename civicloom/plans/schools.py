"""School assessment results: cleaning, star schema and report tables.

Clean tables are strings plus tolerant numbers; facts carry coded subgroups.
Every function takes and returns DataFrames, so any district's files will do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions import parse
from civicloom.functions.semantics import (
    code_label,
    is_suppressed,
    raw_and_number,
    round_binary,
    strict_int,
    tolerant_double,
    tolerant_int,
)
from civicloom.operators import joins, metrics, reshape
from civicloom.sources import relations

# Subgroup wording of the result files and its official code.
SUBGROUP_CODES = {
    "All Students": "ALL",
    "Economically Disadvantaged": "EDS",
    "Not Economically Disadvantaged": "NEDS",
    "Academically or Intellectually Gifted": "AIG",
    "Not Academically or Intellectually Gifted": "NAIG",
    "Students With Disabilities": "SWD",
    "Not Student with Disabilities": "NSWD",
    "English Learner": "ELS",
    "All English Learners": "ELS",
    "Not English Learner": "NELS",
    "Black": "BLCK",
    "White": "WHTE",
    "Hispanic": "HISP",
    "Asian": "ASIA",
    "American Indian": "AMIN",
    "Two or More Races": "MULT",
    "Female": "FEM",
    "Male": "MALE",
    "Military Connected": "MIL",
    "Homeless": "HMS",
    "Foster Care": "FCS",
}

# Grade scope of each combined-result label.
GRADE_SCOPES = {
    "All Subjects": "All",
    "Grade 3-8": "3-8",
    "Grade 9-12": "9-12",
    **{f"Grade {n}": str(n) for n in range(3, 9)},
}

# Subject area and grade scope of each subject label.
SUBJECT_LABELS = {
    "Biology": ("Science", "EOC (9-12)"),
    "English II": ("English", "EOC (9-12)"),
    "NC Math 1 (9-12)": ("Math", "EOC (9-12)"),
    "NC Math 3 (9-12)": ("Math", "EOC (9-12)"),
    "Reading Grade 3-8": ("Reading", "3-8"),
    "Reading Grade 3": ("Reading", "3"),
    "Reading Grade 4": ("Reading", "4"),
    "Reading Grade 5": ("Reading", "5"),
    "Reading Grade 6": ("Reading", "6"),
    "Reading Grade 7": ("Reading", "7"),
    "Reading Grade 8": ("Reading", "8"),
    "Math Grade 3-8": ("Math", "3-8"),
    "Math Grade 3": ("Math", "3"),
    "Math Grade 4": ("Math", "4"),
    "Math Grade 5": ("Math", "5"),
    "Math Grade 6": ("Math", "6"),
    "Math Grade 7": ("Math", "7"),
    "Math Grade 8": ("Math", "8"),
    "Science Grade 5&8": ("Science", "5&8"),
    "Science Grade 5": ("Science", "5"),
    "Science Grade 8": ("Science", "8"),
}
SUBJECT_AREAS = {label: area for label, (area, _) in SUBJECT_LABELS.items()}
SUBJECT_SCOPES = {label: scope for label, (_, scope) in SUBJECT_LABELS.items()}

# Town of each school by its mailing address.
SCHOOLS_BY_TOWN = {
    "Cornelius": ["600312", "600313", "600346", "600433", "61J000"],
    "Davidson": ["600357", "60I000"],
    "Huntersville": [
        "600305", "600306", "600328", "600394", "600415", "600420", "600442", "600444",
        "600480", "600557", "600558", "600594", "60D000", "61V000", "62M000", "62N000",
    ],
}
SCHOOL_TOWNS = {code: town for town, codes in SCHOOLS_BY_TOWN.items() for code in codes}

# Codes in use that the official code lists leave out.
UNLISTED_SUBGROUPS = {
    "NAIG": "Not Academically or Intellectually Gifted",
    "NELS": "Not English Learner",
}
UNLISTED_SUBJECTS = {
    "MA37": "[UNDOCUMENTED CODE -- not in the workbook's own Format tab] Inferred from data: Mathematics grades 3-7 combined, i.e. MAGS excluding grade 8. Verified against 2 independent schools: Barnette Elementary (PK-05, no grade 6-8 data at all) has MA37 exactly equal to MAGS (same denominator 374, same glp_pct 73.3); J. M. Alexander Middle (06-08) has MA37's denominator (531) exactly equal to MAGS's denominator (791) minus MA08's denominator (260). Plausible reason: grade 8 math is reported separately (M8SEP/MA08) since some grade-8 students take the NC Math 1 EOC instead of the standard grade-8 EOG.",
}

# Benchmark score of each ACT measure that has one.
COMPOSITE = "ACT composite score of 17 or higher"
BENCHMARKS = {
    COMPOSITE: 17,
    "ACT English subtest": 18,
    "ACT Math subtest": 22,
    "ACT Reading subtest": 22,
    "ACT Science subtest": 23,
}

REPORT_YEAR = 2025
IDENTITY = ("school_code", "school_name", "district_name", "grade_span", "subgroup")


# -- cleaning ----------------------------------------------------------------


def _identity() -> list[Column]:
    return [F.trim(c).alias(c) for c in IDENTITY]


def clean_results(raw: DataFrame) -> DataFrame:
    """Combined results: the subject column holds a grade scope; unknown ones are NULL."""
    return raw.select(
        *_identity(),
        code_label(F.trim("subject"), GRADE_SCOPES).alias("grade_scope"),
        *raw_and_number("percent_level_3_and_above_glp", "glp_raw", "glp_pct"),
        *raw_and_number("percent_level_4_and_above_ccr", "ccr_raw", "ccr_pct"),
        tolerant_int("number_of_days_missed_due_to_hurricane_helene").alias("missed_days_helene"),
    )


def clean_growth(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_identity(),
        F.trim("school_growth_type").alias("growth_type"),
        F.trim("school_growth_status").alias("growth_status"),
        tolerant_double("school_growth_index_score").alias("growth_index_score"),
    )


def clean_high_school(raw: DataFrame) -> DataFrame:
    pairs = {
        "act_workkeys_indicator": "actworkkeys_assessments_indicator_percent",
        "passing_math3": "passing_nc_math_3_percent",
        "grad_4yr": "fouryear_cohort_graduation_rate_percent",
        "grad_5yr": "fiveyear_cohort_graduation_rate_percent",
    }
    columns = [c for n, source in pairs.items() for c in raw_and_number(source, f"{n}_raw", f"{n}_pct")]
    return raw.select(*_identity(), *columns)


def clean_master(raw: DataFrame) -> DataFrame:
    """Master data set: official codes, denominators and Title I status."""
    return raw.select(
        strict_int("reporting_year").alias("reporting_year"),
        F.trim("school_code").alias("school_code"),
        F.trim("school_name").alias("school_name"),
        F.trim("lea_name").alias("district_name"),
        F.trim("grade_span").alias("grade_span"),
        tolerant_int("missed_days").alias("missed_days_helene"),
        (F.trim("title_1") == "Y").alias("is_title_1"),
        F.trim("subgroup").alias("subgroup_code"),
        F.trim("subject").alias("subject_code"),
        tolerant_int("den").alias("denominator"),
        *raw_and_number("total_pct", "total_pct_raw", "total_pct"),
        *[tolerant_double(c).alias(c) for c in ("notprof_pct", "lev3_pct", "lev4_pct", "lev5_pct")],
        *raw_and_number("glp_pct", "glp_pct_raw", "glp_pct"),
        *raw_and_number("ccr_pct", "ccr_pct_raw", "ccr_pct"),
    )


def clean_subjects(raw: DataFrame) -> DataFrame:
    """Subject results: one label split into subject area and grade scope."""
    label = F.trim("subject")
    return raw.select(
        *_identity(),
        label.alias("original_subject_label"),
        code_label(label, SUBJECT_AREAS).alias("subject_area"),
        code_label(label, SUBJECT_SCOPES).alias("grade_scope"),
        *raw_and_number("not_proficient", "not_proficient_raw", "not_proficient_pct"),
        *[tolerant_double(f"percent_level_{n}").alias(f"level_{n}_pct") for n in (3, 4, 5)],
        *raw_and_number("percent_level_3_and_above_glp", "glp_raw", "glp_pct"),
        *raw_and_number("percent_level_4_and_above_ccr", "ccr_raw", "ccr_pct"),
    )


def clean_act(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_identity(),
        F.trim("the_act_subtest_or_composite").alias("act_measure"),
        *raw_and_number(
            "percent_meeting_benchmark_or_standard", "pct_meeting_benchmark_raw", "pct_meeting_benchmark"
        ),
    )


def clean_workkeys(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_identity(),
        *raw_and_number("percent_silver_or_higher", "pct_silver_or_higher_raw", "pct_silver_or_higher"),
    )


def clean_learners(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_identity(),
        *raw_and_number(
            "total_el_progress_exited_plus_annual_progress", "total_el_progress_raw", "total_el_progress_pct"
        ),
        *raw_and_number("percent_exiting_el_status", "pct_exiting_el_status_raw", "pct_exiting_el_status"),
        *raw_and_number(
            "percent_meeting_annual_progress_toward_exiting",
            "pct_meeting_annual_progress_raw",
            "pct_meeting_annual_progress",
        ),
    )


def clean_code_list(raw: DataFrame, code: str, text: str) -> DataFrame:
    return raw.select(F.trim(code).alias(code), F.trim(text).alias(text))


# -- star schema -------------------------------------------------------------


def school_dimension(
    master: DataFrame, towns: DataFrame, school_towns: Mapping[str, str] = SCHOOL_TOWNS
) -> DataFrame:
    """Schools with their town; unknown schools keep a NULL town."""
    columns = ["school_code", "school_name", "district_name", "grade_span", "is_title_1"]
    schools = master.select(*columns).distinct()
    placed = schools.withColumn("town_name", code_label("school_code", school_towns))
    joined = joins.attach(placed, towns.select("place_GEOID", "town_name"), "town_name", "left")
    return joined.select(*columns, "place_GEOID", "town_name")


def subgroup_dimension(master: DataFrame, listed: DataFrame) -> DataFrame:
    codes = master.select("subgroup_code").distinct()
    return joins.lookup(codes, listed, "subgroup_code", "subgroup_label", UNLISTED_SUBGROUPS)


def subject_dimension(master: DataFrame, listed: DataFrame) -> DataFrame:
    codes = master.select("subject_code").distinct()
    return joins.lookup(codes, listed, "subject_code", "description", UNLISTED_SUBJECTS)


def scope_dimension(results: DataFrame, subjects: DataFrame) -> DataFrame:
    scopes = results.select("grade_scope").union(subjects.select("grade_scope")).distinct()
    return scopes.select("grade_scope", *parse.grade_bounds("grade_scope"))


def act_dimension(act: DataFrame) -> DataFrame:
    scores = relations.literal(
        act.sparkSession, list(BENCHMARKS.items()), {"act_measure": "string", "benchmark_score": "int"}
    )
    codes = act.select("act_measure").distinct()
    return joins.lookup(codes, scores, "act_measure", "benchmark_score")


# Columns of each fact after (school_code, year_key, subgroup_code).
FACT_COLUMNS = {
    "fact_school_test_results": ("grade_scope", "glp_raw", "glp_pct", "ccr_raw", "ccr_pct"),
    "fact_school_growth": ("growth_type", "growth_status", "growth_index_score"),
    "fact_school_hs_indicators": (
        "act_workkeys_indicator_raw", "act_workkeys_indicator_pct", "passing_math3_raw", "passing_math3_pct",
        "grad_4yr_raw", "grad_4yr_pct", "grad_5yr_raw", "grad_5yr_pct",
    ),
    "fact_school_eog_eoc": (
        "subject_area", "grade_scope", "original_subject_label", "not_proficient_pct",
        "level_3_pct", "level_4_pct", "level_5_pct", "glp_pct", "ccr_pct",
    ),
    "fact_school_act": ("act_measure", "pct_meeting_benchmark"),
    "fact_school_workkeys": ("pct_silver_or_higher",),
    "fact_school_english_learner": (
        "total_el_progress_pct", "pct_exiting_el_status", "pct_meeting_annual_progress",
    ),
}


def school_fact(name: str, clean: DataFrame, year: int = REPORT_YEAR) -> DataFrame:
    """A fact of one report year; subgroup wording becomes its code by one shared map."""
    return clean.select(
        "school_code",
        F.lit(year).alias("year_key"),
        code_label("subgroup", SUBGROUP_CODES).alias("subgroup_code"),
        *FACT_COLUMNS[name],
    )


def master_fact(master: DataFrame) -> DataFrame:
    """The master data set already has codes and its own reporting year."""
    return master.select(
        "school_code",
        F.col("reporting_year").alias("year_key"),
        "subgroup_code", "subject_code", "is_title_1", "denominator", "total_pct", "notprof_pct",
        "lev3_pct", "lev4_pct", "lev5_pct", "glp_pct", "ccr_pct",
    )


# -- reports -----------------------------------------------------------------



def _schools(schools: DataFrame, *columns: str) -> DataFrame:
    return schools.select("school_code", F.col("school_name").alias("school"), *columns)


def proficiency(results: DataFrame, schools: DataFrame, scope: str) -> DataFrame:
    """Proficiency of all students in one grade scope."""
    rows = results.where((F.col("subgroup_code") == "ALL") & (F.col("grade_scope") == scope))
    joined = joins.attach(
        rows, _schools(schools, "grade_span", "town_name", "is_title_1"), "school_code"
    )
    return joined.select(
        "school", "grade_span", "town_name", "is_title_1",
        F.col("glp_pct").alias("glp"), "glp_raw", F.col("ccr_pct").alias("ccr"), "ccr_raw",
    )


def economic_gap(results: DataFrame, schools: DataFrame, scope: str) -> DataFrame:
    """Gap between students not disadvantaged and disadvantaged, per school code."""
    gaps = metrics.gap_wide(
        results.where(F.col("grade_scope") == scope),
        ["school_code"],
        "subgroup_code",
        "glp_pct",
        ("EDS", "econ_disadv"),
        ("NEDS", "not_disadv"),
    )
    joined = joins.attach(gaps, _schools(schools, "town_name", "is_title_1"), "school_code")
    return joined.select("school", "town_name", "is_title_1", "econ_disadv", "not_disadv", "gap")


def disability_gap(results: DataFrame, schools: DataFrame) -> DataFrame:
    gaps = metrics.gap_wide(
        results.where(F.col("grade_scope") == "All"),
        ["school_code"],
        "subgroup_code",
        "glp_pct",
        ("SWD", "swd_pct"),
        ("NSWD", "nswd_pct"),
    )
    return joins.attach(gaps, _schools(schools), "school_code").select("school", "swd_pct", "nswd_pct", "gap")


def race_gap(results: DataFrame, schools: DataFrame, subgroups: DataFrame) -> DataFrame:
    """Every other race group against White students, one row per school and group."""
    gaps = metrics.gap_long(
        results.where(F.col("grade_scope") == "All"),
        ["school_code"],
        "subgroup_code",
        "glp_pct",
        ("WHTE", "white_pct"),
        ["BLCK", "HISP", "ASIA", "AMIN", "MULT"],
    )
    named = joins.attach(joins.attach(gaps, _schools(schools), "school_code"), subgroups, "subgroup_code")
    return named.select(
        "school", F.col("subgroup_label").alias("comparison_group"), "white_pct", "comparison_pct", "gap"
    )


def growth(facts: DataFrame, schools: DataFrame) -> DataFrame:
    """Overall growth with reading and mathematics beside it, from one aggregation."""
    rows = facts.where(F.col("subgroup_code") == "ALL").withColumn("here", F.lit(True))
    wide = reshape.role_columns(
        rows,
        ["school_code"],
        "growth_type",
        {"Overall": "overall", "Reading": "reading", "Mathematics": "math"},
        {"here": "_here", "growth_status": "_status", "growth_index_score": "_index"},
    ).where("overall_here")
    joined = joins.attach(
        wide, _schools(schools, "grade_span", "town_name", "is_title_1"), "school_code"
    )
    return joined.select(
        "school", "grade_span", "town_name", "is_title_1",
        F.col("overall_status").alias("status"),
        F.col("overall_index").alias("index_score"),
        F.col("reading_status").alias("reading_growth_status"),
        F.col("reading_index").alias("reading_growth_index"),
        F.col("math_status").alias("math_growth_status"),
        F.col("math_index").alias("math_growth_index"),
    )


def graduation(indicators: DataFrame, schools: DataFrame) -> DataFrame:
    rows = indicators.where((F.col("subgroup_code") == "ALL") & F.col("grad_4yr_raw").isNotNull())
    joined = joins.attach(rows, _schools(schools, "town_name", "is_title_1"), "school_code")
    return joined.select(
        "school", "town_name", "is_title_1",
        F.col("grad_4yr_pct").alias("grad_4yr"), "grad_4yr_raw",
        is_suppressed("grad_4yr_raw").alias("suppressed"),
        F.col("grad_5yr_pct").alias("grad_5yr"), "grad_5yr_raw",
        "act_workkeys_indicator_pct", "act_workkeys_indicator_raw",
        "passing_math3_pct", "passing_math3_raw",
    )


def town_summary(results: DataFrame, schools: DataFrame) -> DataFrame:
    rows = results.where((F.col("subgroup_code") == "ALL") & (F.col("grade_scope") == "All"))
    joined = joins.attach(rows, schools.select("school_code", "town_name"), "school_code")
    return joined.groupBy("town_name").agg(
        F.count_distinct("school_code").alias("num_schools"),
        round_binary(F.avg("glp_pct"), 1).alias("avg_glp"),
        round_binary(F.avg("ccr_pct"), 1).alias("avg_ccr"),
    )


def college_readiness(
    results: DataFrame, act: DataFrame, workkeys: DataFrame, schools: DataFrame
) -> DataFrame:
    """Schools with high-school results, and three facts beside them."""
    everyone = F.col("subgroup_code") == "ALL"
    upper = F.col("grade_scope") == "9-12"
    key = ["school_code"]
    base = joins.attach(results.where(upper).select("school_code").distinct(), _schools(schools), "school_code")
    base = joins.role_join(base, results, key, everyone & upper, {"ccr_pct": "ccr_pct"})
    base = joins.role_join(
        base, act, key, everyone & (F.col("act_measure") == COMPOSITE),
        {"pct_meeting_benchmark": "act_composite_pct"},
    )
    base = joins.role_join(base, workkeys, key, everyone, {"pct_silver_or_higher": "workkeys_silver_pct"})
    return base.drop("school_code")


def scorecard(
    schools: DataFrame, results: DataFrame, growth_facts: DataFrame, indicators: DataFrame
) -> DataFrame:
    """One row per school, whatever it reported."""
    everyone = F.col("subgroup_code") == "ALL"
    key = ["school_code"]
    base = _schools(schools, "town_name", "grade_span", "is_title_1")
    base = joins.role_join(
        base, results, key, everyone & (F.col("grade_scope") == "All"), {"glp_pct": "glp", "ccr_pct": "ccr"}
    )
    base = joins.role_join(
        base, growth_facts, key, everyone & (F.col("growth_type") == "Overall"),
        {"growth_status": "growth_status", "growth_index_score": "growth_index_score"},
    )
    base = joins.role_join(base, indicators, key, everyone, {"grad_4yr_pct": "grad_4yr_pct"})
    return base.drop("school_code")


def subject_proficiency(schools: DataFrame, master: DataFrame) -> DataFrame:
    """Reading, math, science and course results with sample sizes, from one aggregation."""
    wide = reshape.role_columns(
        master.where(F.col("subgroup_code") == "ALL"),
        ["school_code"],
        "subject_code",
        {"RDGS": "reading", "MAGS": "math", "SCGS": "science", "EOC": "eoc"},
        {"glp_pct": "_glp", "ccr_pct": "_ccr", "denominator": "_n"},
    )
    return joins.attach(_schools(schools, "town_name"), wide, "school_code", "left").drop("school_code")


def grade_level_proficiency(subjects: DataFrame, schools: DataFrame) -> DataFrame:
    rows = subjects.where(F.col("subgroup_code") == "ALL")
    return joins.attach(rows, _schools(schools, "town_name"), "school_code").select(
        "school", "town_name", "subject_area", "grade_scope",
        F.col("glp_pct").alias("glp"), F.col("ccr_pct").alias("ccr"),
    )


def learner_progress(learners: DataFrame, schools: DataFrame) -> DataFrame:
    rows = learners.where(F.col("subgroup_code") == "ELS")
    return joins.attach(rows, _schools(schools, "town_name"), "school_code").select(
        "school", "town_name", "total_el_progress_pct", "pct_exiting_el_status", "pct_meeting_annual_progress"
    )


def reports(facts: Mapping[str, DataFrame], schools: DataFrame, subgroups: DataFrame) -> dict[str, DataFrame]:
    """All school report tables from the facts by table name."""
    results, grown = facts["fact_school_test_results"], facts["fact_school_growth"]
    indicators = facts["fact_school_hs_indicators"]
    act, workkeys = facts["fact_school_act"], facts["fact_school_workkeys"]
    return {
        "agg_school_proficiency": proficiency(results, schools, "All"),
        "agg_school_ccr": proficiency(results, schools, "9-12"),
        "agg_school_economic_gap": economic_gap(results, schools, "All"),
        "agg_school_hs_economic_gap": economic_gap(results, schools, "9-12"),
        "agg_school_growth": growth(grown, schools),
        "agg_school_graduation": graduation(indicators, schools),
        "agg_school_race_gap": race_gap(results, schools, subgroups),
        "agg_school_disability_gap": disability_gap(results, schools),
        "agg_town_school_summary": town_summary(results, schools),
        "agg_school_college_readiness": college_readiness(results, act, workkeys, schools),
        "agg_school_scorecard": scorecard(schools, results, grown, indicators),
        "agg_school_subject_proficiency": subject_proficiency(schools, facts["fact_school_assessment_master"]),
        "agg_school_grade_level_proficiency": grade_level_proficiency(facts["fact_school_eog_eoc"], schools),
        "agg_school_english_learner_progress": learner_progress(facts["fact_school_english_learner"], schools),
    }


