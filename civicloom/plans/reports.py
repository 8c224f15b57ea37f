"""Town and neighbourhood report tables, addressed by published variable code.

Codes do not change with the vintage text of a label, so a new year needs no
edit here.  A report lists the published tables an area must appear in and its
measures; ``civicloom.operators.metrics.indicators`` computes it in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.semantics import nulls_last
from civicloom.operators import joins, metrics
from civicloom.operators.metrics import Measure, lines, percent, ratio, total
from civicloom.sources import relations


@dataclass(frozen=True)
class Report:
    """A report table: published tables required, and measures."""

    requires: tuple[str, ...]
    measures: tuple[Measure, ...]


def _each(table: str, names: dict[str, int]) -> list[Measure]:
    """One plain measure per named line of a table."""
    return [total(name, *lines(table, number)) for name, number in names.items()]


def _bands(first: int, which: range, step: int = 3) -> list[int]:
    """Line numbers of consecutive age bands spaced ``step`` lines apart."""
    return [first + step * i for i in which]


# -- shared brackets ---------------------------------------------------------

POPULATION = lines("B01003", 1)
INCOME_TIERS = [range(2, 6), range(6, 11), range(11, 14), range(14, 18)]
LESS_THAN_HIGH_SCHOOL = lines("B15003", *range(2, 17))
HIGH_SCHOOL = lines("B15003", 17, 18)
SOME_COLLEGE = lines("B15003", 20, 19)
BACHELORS = lines("B15003", 22)
GRADUATE = lines("B15003", 23, 24, 25)
ADULTS = lines("B15003", 1)
K12 = lines("B14001", 4, 5, 6, 7)
ENROLLABLE = lines("B14001", 1)
BURDENED = lines("B25070", 7, 8, 9)
SEVERELY_BURDENED = lines("B25070", 10)
OWNERS, RENTERS = lines("B25003", 2), lines("B25003", 3)
UNITS = lines("B25001", 1)
WORKERS = lines("B08301", 1)
MEDIAN_INCOME, MEDIAN_VALUE = lines("B19013", 1), lines("B25077", 1)
MEDIAN_RENT, GINI = lines("B25064", 1), lines("B19083", 1)

# Children by age: (label, all, both parents, father only, mother only, neither,
# lone father working / not, lone mother working / not)
CHILDREN = {"under6": (2, 4, 5, 6, 7, 10, 11, 13, 14), "age6_17": (15, 17, 18, 19, 20, 23, 24, 26, 27)}

# Insurance by age band in B27001: bands count from 0 (under 6) to 8 (75 and over).
INSURED_BANDS = {
    "U18": range(0, 2),
    "19_25": range(2, 3),
    "26_34": range(3, 4),
    "35_64": range(4, 7),
    "65_over": range(7, 9),
}

# Kinds of coverage in B27010, every age group.  The direct-purchase list leaves
# out 35-64 direct only and 19-34 employer with direct, as published reports do.
COVERAGE = {
    "emp_based_ins": (4, 11, 12, 20, 27, 28, 36, 43, 44, 53, 59, 60),
    "dir_purchase_ins": (5, 11, 21, 43, 45, 54, 59, 61),
    "medicare_cov": (6, 12, 13, 22, 28, 29, 38, 44, 45, 46, 55, 60, 61, 62),
    "medicaid_cov": (7, 13, 23, 29, 39, 46, 62),
    "tricare_cov": (8, 24, 40, 56),
    "va_cov": (9, 25, 41, 57),
    "other_cov_type": (14, 15, 16, 30, 31, 32, 47, 48, 49, 63, 64, 65),
}

DISABILITY_BANDS = ["under5", "5_17", "18_34", "35_64", "65_74", "75_over"]


def _insured(offset: int, bands: range) -> tuple[str, ...]:
    return lines("B27001", *_bands(4 + offset, bands), *_bands(32 + offset, bands))


def _disabled(offset: int, bands: range) -> tuple[str, ...]:
    return lines("B18101", *_bands(4 + offset, bands), *_bands(23 + offset, bands))


def _disability() -> list[Measure]:
    measures = _each("B18101", {"total_population": 1})
    for prefix, offset in (("disab", 0), ("no_disab", 1)):
        for i, band in enumerate(DISABILITY_BANDS):
            measures.append(total(f"{prefix}_{band}", *_disabled(offset, range(i, i + 1))))
    every = range(len(DISABILITY_BANDS))
    measures.append(total("total_with_disability", *_disabled(0, every)))
    measures.append(percent("disability_rate_pct", _disabled(0, every), lines("B18101", 1)))
    for i, band in enumerate(DISABILITY_BANDS):
        one = range(i, i + 1)
        base = _disabled(0, one) + _disabled(1, one)
        measures.append(percent(f"disability_rate_{band}_pct", _disabled(0, one), base))
    for sex, first, base in (("male", 4, 2), ("female", 23, 21)):
        top = lines("B18101", *_bands(first, every))
        measures.append(percent(f"disability_rate_{sex}_pct", top, lines("B18101", base)))
    return measures


def _movers(who: str, first: int, base: tuple[str, ...]) -> list[Measure]:
    """Recent, middle and long-tenured households of one tenure in B25038."""
    recent, middle = lines("B25038", first), lines("B25038", first + 1)
    return [
        total(f"{who}_moved_2023_or_later", *recent),
        total(f"{who}_moved_2020_2022", *middle),
        total(f"{who}_long_tenured", *lines("B25038", *range(first + 2, first + 6))),
        percent(f"{who}_turnover_rate_pct", recent + middle, base),
    ]


def _commuting() -> list[Measure]:
    alone, transit, home = lines("B08301", 3), lines("B08301", 10), lines("B08301", 21)
    return [
        total("total_workers", *WORKERS),
        total("commute_drove_alone", *alone),
        total("commute_public_transit", *transit),
        total("commute_walked", *lines("B08301", 19)),
        total("commute_bicycle", *lines("B08301", 18)),
        total("commute_worked_from_home", *home),
        percent("pct_drove_alone", alone, WORKERS),
        percent("pct_public_transit", transit, WORKERS),
        percent("pct_worked_from_home", home, WORKERS),
        total("aggregate_commute_minutes", *lines("B08136", 1)),
        ratio("avg_commute_minutes", lines("B08136", 1), WORKERS, 1),
        total("households_no_vehicle", *lines("B08201", 2)),
    ]


def _working(age: str) -> tuple[str, ...]:
    """Children whose every parent at home works."""
    _, both, _, _, _, father, _, mother, _ = CHILDREN[age]
    return lines("B23008", both, father, mother)


def _child_totals() -> list[Measure]:
    return _each(
        "B23008", {"total_children_under_18": 1, "children_under6": 2, "children_6_17": 15}
    )


def _child_homes(age: str) -> list[Measure]:
    _, both, father_only, mother_only, neither, father, idle_father, mother, idle_mother = CHILDREN[age]
    return [
        *_each(
            "B23008",
            {
                f"{age}_two_parents_both_working": both,
                f"{age}_two_parents_father_only_working": father_only,
                f"{age}_two_parents_mother_only_working": mother_only,
                f"{age}_two_parents_neither_working": neither,
            },
        ),
        total(f"{age}_one_parent_working", *lines("B23008", father, mother)),
        total(f"{age}_one_parent_not_working", *lines("B23008", idle_father, idle_mother)),
    ]


def _child_need(after_school: str) -> list[Measure]:
    young, old = lines("B23008", 2), lines("B23008", 15)
    return [
        total("under6_likely_needs_childcare", *_working("under6")),
        percent("pct_under6_likely_needs_childcare", _working("under6"), young),
        total(f"age6_17_likely_needs_{after_school}", *_working("age6_17")),
        percent(f"pct_6_17_likely_needs_{after_school}", _working("age6_17"), old),
        total("grandparent_caregiver_households", *lines("B10002", 2)),
    ]


# Attainment by group in S1501: first line of the count, high-school and bachelor columns.
S1501_COUNTS = {
    "pop_25_34": (16, "_hs_grad_plus"),
    "pop_35_44": (19, "_hs_grad_plus"),
    "pop_45_64": (22, "_hs_grad_plus"),
    "pop_65_plus": (25, "_hs_grad_plus"),
    "pop_white_non_hispanic": (31, "_hs_plus"),
    "pop_black_alone": (34, "_hs_plus"),
    "pop_asian_alone": (40, "_hs_plus"),
    "pop_hispanic_or_latino": (52, "_hs_plus"),
    "pop_two_or_more_races": (49, "_hs_plus"),
}
S1501_SHARES = {
    "pct_45_64": (23, "_hs_grad_plus"),
    "pct_65_plus": (26, "_hs_grad_plus"),
    "pct_white_non_hispanic": (32, "_hs_plus"),
    "pct_black_alone": (35, "_hs_plus"),
    "pct_white_alone": (29, "_hs_plus"),
    "pct_hispanic_or_latino": (53, "_hs_plus"),
}


def _attainment_by_group() -> list[Measure]:
    counts, shares = "S1501_C01", "S1501_C02"
    measures = _each(
        counts,
        {
            "pop_18_24": 1,
            "pop_18_24_less_than_hs": 2,
            "pop_18_24_hs_grad": 3,
            "pop_18_24_some_college": 4,
            "pop_18_24_bachelors_plus": 5,
        },
    )
    measures += _each(shares, {"pct_population_25_plus": 6})
    for name, (first, school) in S1501_COUNTS.items():
        columns = {name: first, f"{name}{school}": first + 1, f"{name}_bachelors_plus": first + 2}
        measures += _each(counts, columns)
    for name, (first, school) in S1501_SHARES.items():
        measures += _each(shares, {f"{name}{school}": first, f"{name}_bachelors_plus": first + 1})
    earnings = ["all", "less_than_hs", "hs_grad", "some_college", "bachelors", "graduate"]
    measures += _each(counts, {f"median_earnings_{e}": 59 + i for i, e in enumerate(earnings)})
    poverty = ["less_than_hs", "hs_grad", "some_college", "bachelors_plus"]
    measures += _each(counts, {f"poverty_count_{p}": 55 + i for i, p in enumerate(poverty)})
    return measures + _each(shares, {"pct_poverty_hs_grad": 56, "pct_poverty_some_college": 57})


TOWN_REPORTS: dict[str, Report] = {
    "agg_town_health_data": Report(
        ("B19001", "B25044", "B27010", "B27011", "B27015"),
        (
            *_each("B19001", {"total_population": 1}),
            *[
                total(name, *lines("B19001", *tier))
                for name, tier in zip(
                    ["Income Under $25k", "Income $25k - $50k", "Income $50k - $100k", "Income $100k +"],
                    INCOME_TIERS,
                )
            ],
            *_each("B25044", {"total_owner_no_vehicle": 3, "total_renter_no_vehicle": 10}),
            total("ins_U19", *lines("B27010", 3, 10)),
            *_each("B27010", {"no_ins_U19": 17}),
            *_each(
                "B27011",
                {
                    "emp_insured": 4,
                    "emp_uninsured": 7,
                    "unemp_insured": 9,
                    "unemp_uninsured": 12,
                    "tot_lf": 2,
                    "nilf_insured": 14,
                    "nilf_uninsured": 17,
                },
            ),
            total("tot_ins_inc_pop", *lines("B27015", 3, 6, 8, 11, 13, 16, 18, 21, 23, 26)),
            *[
                total(f"{kind}_{tier}", *lines("B27015", first + offset))
                for first, tier in zip((3, 8, 13, 18, 23), ("U25", "25_50", "50_75", "75_100", "100_above"))
                for kind, offset in (("ins", 0), ("no_ins", 3))
            ],
        ),
    ),
    "agg_town_health_insurance": Report(
        ("B27001", "B27010"),
        (
            *[total(f"ins_{b}", *_insured(0, r)) for b, r in INSURED_BANDS.items()],
            *[total(f"unins_{b}", *_insured(1, r)) for b, r in INSURED_BANDS.items()],
            total("all_ins", *_insured(0, range(9))),
            total("all_unins", *_insured(1, range(9))),
            *[total(name, *lines("B27010", *numbers)) for name, numbers in COVERAGE.items()],
        ),
    ),
    "agg_town_economic_trends": Report(
        ("B19013", "B25077", "B25064", "B19083"),
        (
            total("median_income", *MEDIAN_INCOME),
            total("median_home_value", *MEDIAN_VALUE),
            total("median_rent", *MEDIAN_RENT),
            total("income_inequality_gini", *GINI),
        ),
    ),
    "economic_mobility_education": Report(
        ("B15003", "B19013", "B19083", "B17001", "B23025", "B27011"),
        (
            total("total_population", *ADULTS),
            percent("bachelors_masters_rate_pct", lines("B15003", 22, 23), ADULTS, guarded=False),
            total("median_income", *MEDIAN_INCOME),
            total("income_inequality_gini", *GINI),
            # The published poverty rate divides by the population 25 and over.
            percent("poverty_rate_pct", lines("B17001", 2), ADULTS, guarded=False),
            percent("labor_unemployment_rate_pct", lines("B23025", 5), lines("B27011", 2), guarded=False),
        ),
    ),
    "agg_town_educational_attainment": Report(
        ("B15003",),
        (
            total("total_pop_25_plus", *ADULTS),
            total("n_less_than_hs", *LESS_THAN_HIGH_SCHOOL),
            *_each("B15003", {"n_hs_diploma": 17, "n_ged_or_equiv": 18}),
            total("n_some_college_no_degree", *SOME_COLLEGE),
            *_each(
                "B15003",
                {
                    "n_associates": 21,
                    "n_bachelors": 22,
                    "n_masters": 23,
                    "n_professional_degree": 24,
                    "n_doctorate": 25,
                },
            ),
            total("n_hs_or_equiv_total", *HIGH_SCHOOL),
            total("n_graduate_or_prof", *GRADUATE),
            percent("pct_less_than_hs", LESS_THAN_HIGH_SCHOOL, ADULTS),
            percent("pct_hs_or_equiv", HIGH_SCHOOL, ADULTS),
            percent("pct_some_college_no_degree", SOME_COLLEGE, ADULTS),
            percent("pct_associates", lines("B15003", 21), ADULTS),
            percent("pct_bachelors", BACHELORS, ADULTS),
            percent("pct_graduate_or_prof", GRADUATE, ADULTS),
            percent("pct_bachelors_or_higher", BACHELORS + GRADUATE, ADULTS),
        ),
    ),
    "agg_town_school_enrollment": Report(
        ("B14001",),
        (
            *_each(
                "B14001",
                {
                    "total_pop_3_plus": 1,
                    "n_enrolled_total": 2,
                    "n_enrolled_preschool": 3,
                    "n_enrolled_kindergarten": 4,
                    "n_enrolled_elem_gr1_4": 5,
                    "n_enrolled_elem_gr5_8": 6,
                    "n_enrolled_high_school_gr9_12": 7,
                },
            ),
            total("n_enrolled_k12_total", *K12),
            *_each(
                "B14001",
                {"n_enrolled_college_undergrad": 8, "n_enrolled_grad_professional": 9, "n_not_enrolled": 10},
            ),
            percent("pct_enrolled_total", lines("B14001", 2), ENROLLABLE),
            percent("pct_enrolled_k12", K12, ENROLLABLE),
            percent("pct_enrolled_preschool", lines("B14001", 3), ENROLLABLE),
            percent("pct_enrolled_high_school", lines("B14001", 7), ENROLLABLE),
            percent("pct_enrolled_college_plus", lines("B14001", 8, 9), ENROLLABLE),
        ),
    ),
    "agg_town_demographics": Report(
        ("B18101", "B02001", "B03003", "B05002", "B21001", "B15003", "B28001", "B28002", "B19013", "B25077"),
        (
            *_each("B18101", {"total_population": 1, "male_population": 2, "female_population": 21}),
            *[
                percent(name, top, lines("B18101", 1), guarded=False)
                for name, top in {
                    "male_rate": lines("B18101", 2),
                    "female_rate": lines("B18101", 21),
                    "hispanic_or_latino_rate": lines("B03003", 3),
                    "foreign_born_rate": lines("B05002", 13),
                    "veteran_rate": lines("B21001", 2),
                }.items()
            ],
            *_each("B02001", {"race_white_alone": 2, "race_black_alone": 3, "race_asian_alone": 5}),
            *_each("B03003", {"ethnicity_hispanic_or_latino": 3}),
            *_each("B05002", {"foreign_born_population": 13}),
            *_each("B21001", {"veteran_population": 2}),
            *_each(
                "B15003",
                {"edu_high_school_diploma": 17, "edu_bachelor_degree": 22, "edu_master_degree": 23},
            ),
            *_each("B28001", {"digital_no_computer": 11}),
            *_each("B28002", {"digital_no_internet_access": 13}),
            total("median_household_income", *MEDIAN_INCOME),
            total("median_home_value", *MEDIAN_VALUE),
        ),
    ),
    "agg_town_disability_status": Report(("B18101",), tuple(_disability())),
    "agg_town_racial_equity_snapshot": Report(
        ("B02001", "B03003", "B01003"),
        (
            total("total_population", *POPULATION),
            *_each("B02001", {"pop_white_alone": 2, "pop_black_alone": 3, "pop_asian_alone": 5}),
            *_each("B03003", {"pop_hispanic_or_latino": 3}),
            percent("pct_white_alone", lines("B02001", 2), POPULATION),
            percent("pct_black_alone", lines("B02001", 3), POPULATION),
            percent("pct_asian_alone", lines("B02001", 5), POPULATION),
            percent("pct_hispanic_or_latino", lines("B03003", 3), POPULATION),
        ),
    ),
    "agg_town_housing_burden": Report(
        ("B25003", "B25070"),
        (
            total("total_renter_households", *RENTERS),
            total("total_households", *RENTERS, *OWNERS),
            total("cost_burdened_households", *BURDENED),
            total("severely_cost_burdened_households", *SEVERELY_BURDENED),
            percent("housing_burden_rate_%", BURDENED + SEVERELY_BURDENED, RENTERS, 1, guarded=False),
        ),
    ),
    "agg_town_housing_affordability_index": Report(
        ("B19013", "B25077", "B25064", "B25071"),
        (
            total("median_household_income", *MEDIAN_INCOME),
            total("median_home_value", *MEDIAN_VALUE),
            total("median_gross_rent", *MEDIAN_RENT),
            *_each("B25071", {"median_rent_to_income_ratio_%": 1}),
            ratio("home_price_to_income_ratio", MEDIAN_VALUE, MEDIAN_INCOME, 2, guarded=False),
        ),
    ),
    "agg_town_housing_stability": Report(
        ("B25001", "B25004", "B25003", "B25038"),
        (
            total("total_housing_units", *UNITS),
            *_each("B25004", {"vacant_units": 1}),
            percent("vacancy_rate_pct", lines("B25004", 1), UNITS),
            total("total_renter_occupied", *RENTERS),
            percent("renter_occupied_rate_pct", RENTERS, UNITS),
            percent("owner_occupied_rate_pct", OWNERS, UNITS),
            total("recent_movers_2023_or_later", *lines("B25038", 3, 10)),
            percent("recent_movers_rate_pct", lines("B25038", 3, 10), UNITS),
            *_movers("renter", 10, RENTERS),
            *_movers("owner", 3, OWNERS),
        ),
    ),
    "agg_town_childcare": Report(
        ("B23008", "B10002"),
        (
            *_child_totals(),
            *_child_homes("under6"),
            *_each("B23008", {"children_6_17_two_parent_hh": 16}),
            percent("pct_6_17_two_parent_hh", lines("B23008", 16), lines("B23008", 15)),
            *_child_homes("age6_17"),
            *_child_need("afterschool_care"),
        ),
    ),
    "agg_town_transportation_access": Report(("B08301", "B08136", "B08201"), tuple(_commuting())),
    "analytics_infrastructure_accessibility": Report(
        ("B25003", "B25044", "B28002", "B27011", "B27010"),
        (
            percent("owner_no_car_rate_pct", lines("B25044", 3), OWNERS, guarded=False),
            percent("renter_no_car_rate_pct", lines("B25044", 10), RENTERS, guarded=False),
            percent("household_no_internet_rate_pct", lines("B28002", 13), OWNERS + RENTERS, guarded=False),
            percent("labor_force_uninsured_rate_pct", lines("B27011", 7, 12), lines("B27011", 2), guarded=False),
            # The published senior rate divides by the population of all ages.
            percent("senior_uninsured_rate_pct", lines("B27010", 66), lines("B27010", 1), guarded=False),
        ),
    ),
    "agg_town_educational_attainment_s1501": Report(("S1501",), tuple(_attainment_by_group())),
}


NEIGHBORHOOD_REPORTS: dict[str, Report] = {
    "agg_neighborhood_demographics": Report(
        ("B01003", "B02001", "B03003", "B05002"),
        (
            total("total_population", *POPULATION),
            *_each("B02001", {"race_white_alone": 2, "race_black_alone": 3, "race_asian_alone": 5}),
            *_each("B03003", {"ethnicity_hispanic_or_latino": 3}),
            percent("hispanic_or_latino_rate", lines("B03003", 3), POPULATION),
            *_each("B05002", {"foreign_born_population": 13}),
            percent("foreign_born_rate", lines("B05002", 13), POPULATION),
        ),
    ),
    "agg_neighborhood_economic_profile": Report(
        ("B19001", "B19013", "B19083", "B17001"),
        (
            *_each("B19001", {"total_households": 1}),
            *[
                total(name, *lines("B19001", *tier))
                for name, tier in zip(
                    ["income_under_25k", "income_25k_50k", "income_50k_100k", "income_100k_plus"],
                    INCOME_TIERS,
                )
            ],
            total("median_household_income", *MEDIAN_INCOME),
            total("income_inequality_gini", *GINI),
            *_each("B17001", {"below_poverty_level": 2}),
            percent("poverty_rate_pct", lines("B17001", 2), lines("B17001", 1)),
        ),
    ),
    "agg_neighborhood_housing": Report(
        ("B25001", "B25003", "B25064", "B25077", "B25070", "B25044"),
        (
            total("total_housing_units", *UNITS),
            total("total_owner_occupied", *OWNERS),
            total("total_renter_occupied", *RENTERS),
            percent("owner_occupied_rate_pct", OWNERS, UNITS),
            percent("renter_occupied_rate_pct", RENTERS, UNITS),
            total("median_gross_rent", *MEDIAN_RENT),
            total("median_home_value", *MEDIAN_VALUE),
            total("cost_burdened_households", *BURDENED),
            total("severely_cost_burdened_households", *SEVERELY_BURDENED),
            percent("housing_burden_rate_pct", BURDENED + SEVERELY_BURDENED, RENTERS),
            *_each("B25044", {"owner_no_vehicle": 3, "renter_no_vehicle": 10}),
        ),
    ),
    "agg_neighborhood_education": Report(
        ("B15003", "B14001"),
        (
            total("total_pop_25_plus", *ADULTS),
            total("n_less_than_hs", *LESS_THAN_HIGH_SCHOOL),
            total("n_hs_or_equiv", *HIGH_SCHOOL),
            total("n_some_college", *SOME_COLLEGE),
            *_each("B15003", {"n_associates": 21, "n_bachelors": 22}),
            total("n_graduate_or_prof", *GRADUATE),
            percent("pct_less_than_hs", LESS_THAN_HIGH_SCHOOL, ADULTS),
            percent("pct_hs_or_equiv", HIGH_SCHOOL, ADULTS),
            percent("pct_bachelors", BACHELORS, ADULTS),
            percent("pct_bachelors_or_higher", BACHELORS + GRADUATE, ADULTS),
            *_each("B14001", {"n_enrolled_total": 2}),
            total("n_enrolled_k12", *K12),
        ),
    ),
    "agg_neighborhood_transportation": Report(("B08301", "B08136", "B08201"), tuple(_commuting())),
    "agg_neighborhood_childcare": Report(
        ("B23008", "B10002"),
        (
            *_child_totals(),
            *_each("B23008", {"under6_both_parents_working": 4, "under6_neither_parent_working": 7}),
            total("under6_single_parent_working", *lines("B23008", 10, 13)),
            *_child_need("afterschool"),
        ),
    ),
}

# Block groups and blocks of the focus neighbourhoods.  One block
# group belongs to two neighbourhoods, so their values overlap on purpose.
NEIGHBORHOOD_BLOCK_GROUPS = {
    "Huntington Green": ["371190062241"],
    "Pottstown": ["371190063071", "371190063072"],
    "West Davidson": ["371190064031"],
    "Smithville": ["371190064111"],
    "East Catawba": ["371190064082", "371190064091", "371190064102", "371190064111", "371190064112"],
}
NEIGHBORHOOD_BLOCKS = {
    "Huntington Green": [
        "371190062241063", "371190062241064", "371190062241065", "371190062241066", "371190062241069",
        "371190062241070", "371190062241071", "371190062241072", "371190062241073", "371190062241074",
        "371190062241075", "371190062241076", "371190062241097", "371190062241098", "371190062241099",
        "371190062241100",
    ],
    "Pottstown": [
        "371190063071064", "371190063071076", "371190063071077", "371190063071079", "371190063072020",
        "371190063072021", "371190063072022",
    ],
    "West Davidson": [
        "371190064031030", "371190064031031", "371190064031032", "371190064031033", "371190064031034",
        "371190064031035", "371190064031036", "371190064031037",
    ],
    "Smithville": [
        "371190064111011", "371190064111012",
    ],
    "East Catawba": [
        "371190064082023", "371190064082024", "371190064082029", "371190064082030", "371190064082031",
        "371190064082032", "371190064082033", "371190064082034", "371190064082035", "371190064091092",
        "371190064091093", "371190064091094", "371190064091095", "371190064091097", "371190064102006",
        "371190064111000", "371190064111001", "371190064111002", "371190064111003", "371190064111004",
        "371190064111005", "371190064111006", "371190064111007", "371190064111008", "371190064111009",
        "371190064111013", "371190064111014", "371190064111015", "371190064111016", "371190064111020",
        "371190064112000", "371190064112001",
    ],
}


# Note on how well whole block groups stand for each neighbourhood.
DISCLAIMERS = {
    "Huntington Green": "Note: block group approximation of neighborhood boundary",
    "Pottstown": "Note: neighborhood spans 2 block groups — boundary imprecision is higher",
    "West Davidson": "Note: block group approximation of neighborhood boundary",
    "Smithville": "Note: block group approximation of neighborhood boundary. CONFLICT: block group 371190064111 overlaps with East Catawba (see file header) -- 15 of its blocks are stakeholder-verified as East Catawba.",
    "East Catawba": "Note: block group approximation of neighborhood boundary, now using the 5 block groups verified against a stakeholder-provided boundary map. CONFLICT: block group 371190064111 overlaps with Smithville (see file header).",
}


def town_report(name: str, observations: DataFrame, towns: DataFrame) -> DataFrame:
    """A town report from clean place observations (GEOID, vintage_year, variable, estimate)."""
    report = TOWN_REPORTS[name]
    table = metrics.indicators(
        observations, report.measures, report.requires, "GEOID", "vintage_year"
    )
    named = towns.where(F.col("town_name") != "Other").select(
        F.col("place_GEOID").alias("GEOID"), F.col("town_name").alias("town")
    )
    joined = joins.attach(table, named, "GEOID").withColumnRenamed("vintage_year", "year")
    return joined.select("GEOID", "town", "year", *[f"`{m.name}`" for m in report.measures])


def neighborhood_members(
    spark, groups: dict[str, list[str]], member: str, notes: Mapping[str, str] = DISCLAIMERS
) -> DataFrame:
    """(member, neighborhood_name, disclaimer) of a neighbourhood map; no note gives NULL."""
    rows = [(m, n, notes.get(n)) for n, members in groups.items() for m in members]
    columns = {member: "string", "neighborhood_name": "string", "disclaimer": "string"}
    return relations.literal(spark, rows, columns)


def neighborhood_report(name: str, observations: DataFrame, members: DataFrame) -> DataFrame:
    """A neighbourhood report from clean block-group observations.

    ``members`` is (GEOID, neighborhood_name, disclaimer); an area claimed twice
    is reported twice.  Observations outside every neighbourhood are dropped
    before anything is shuffled.
    """
    report = NEIGHBORHOOD_REPORTS[name]
    inside = joins.only_members(observations, members.select("GEOID"), "GEOID")
    table = metrics.indicators(inside, report.measures, report.requires, "GEOID", "vintage_year")
    joined = joins.attach(table, members, "GEOID").withColumnRenamed("vintage_year", "year")
    notes = ["disclaimer"] if name == "agg_neighborhood_demographics" else []
    columns = [f"`{m.name}`" for m in report.measures]
    return joined.select("neighborhood_name", *notes, "GEOID", "year", *columns)


# The order in which reports are stored, by table or by the columns they have.
STORED_ORDER = {
    "agg_mhsu_facility_summary": ["-is_mecklenburg", "county", "facility_type_label"],
    "agg_mhsu_facility_detail": ["-is_mecklenburg", "county", "facility_name"],
    "agg_charlotte_fair_market_rent": ["region_name", "year", "assumed_household_size"],
    "agg_charlotte_ami_affordability_gap": ["region_name", "assumed_household_size", "ami_pct"],
    "agg_charlotte_occupation_housing_wage": ["region_name", "category", "occupation_name"],
    "agg_town_home_value_trends": ["town", "housing_type", "date"],
    "agg_town_rent_trends": ["town", "date"],
    "agg_neighborhood_blocks": ["neighborhood_name", "block_GEOID"],
    "agg_school_race_gap": ["school", "comparison_group"],
    "agg_school_grade_level_proficiency": ["school", "subject_area", "grade_scope"],
}
ORDERED_COLUMNS = (
    ["neighborhood_name", "GEOID", "year"], ["town", "year"], ["county", "year"], ["town_name", "year_key"], ["school"], ["town_name"],
)


def stored_order(name: str, columns: Sequence[str]) -> list[Column]:
    """The order in which a report's rows are stored, missing values last; [] where there is none."""
    order = STORED_ORDER.get(name) or next((o for o in ORDERED_COLUMNS if set(o) <= set(columns)), [])
    return nulls_last(*order)
