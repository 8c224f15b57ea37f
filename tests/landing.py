"""A small landing zone with every input of the warehouse, written as raw files."""

from __future__ import annotations

import csv
import json
from pathlib import Path

from civicloom.plans import reports, schools, survey

YEARS = (2023, 2024)
PLACES = {"37001": "Davidson town, North Carolina", "37002": "Cornelius town, North Carolina",
          "37003": "Huntersville town, North Carolina", "37004": "Matthews town, North Carolina"}
BLOCK_GROUPS = sorted({g for gs in reports.NEIGHBORHOOD_BLOCK_GROUPS.values() for g in gs}) + ["371190099991"]
MISSING_IN_2023 = "B28002_013"
ALL_REPORTS = {**reports.TOWN_REPORTS, **reports.NEIGHBORHOOD_REPORTS}
#: Every variable a report computes with, and a first line of the tables reports only ask for.
ASKED = sorted(
    {c for r in ALL_REPORTS.values() for m in r.measures for c in m.codes}
    | {f"{t}_002" for r in ALL_REPORTS.values() for t in r.requires}
)
SCHOOL_LIST = ["600312", "600357", "600305", "999999"]


def estimate(area: str, year: int, code: str) -> int | None:
    """Deterministic value of a cell; one median is marked as not estimated."""
    if code == "B25064_001" and area == "37002" and year == 2023:
        return survey.NOT_ESTIMATED
    return 10 + (int(area) * 31 + year * 7 + sum(map(ord, code)) * 13) % 90


def write_csv(path: Path, header, rows) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as handle:
        csv.writer(handle).writerows([header, *rows])
    return str(path)


def _payloads(folder: Path, kind: str, areas) -> str:
    geo_header = ["state", "county", "tract", "block group"] if kind == "block group" else ["state", "place"]
    codes = [c for c in ASKED if not (kind == "block group" and c.startswith("S"))]
    for year in YEARS:
        asked = [c for c in codes if not (c == MISSING_IN_2023 and year == 2023)]
        groups = [[c for c in asked if c.startswith("S")], [c for c in asked if not c.startswith("S")]]
        part = 0
        for margins, group in zip((False, True), groups):
            for i in range(0, len(group), 20):
                chunk = group[i : i + 20]
                header = ["NAME", *[f"{c}E" for c in chunk], *([f"{c}M" for c in chunk] if margins else []), *geo_header]
                table = [header]
                for area, name in areas.items():
                    cells = [str(estimate(area, year, c)) for c in chunk]
                    moes = ["1.5"] * len(chunk) if margins else []
                    ids = [area[:2], area[2:5], area[5:11], area[11:]] if kind == "block group" else [area[:2], area[2:]]
                    table.append([name, *cells, *moes, *ids])
                target = folder / str(year) / f"part{part}.json"
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text(json.dumps(table))
                part += 1
        (folder / str(year) / "empty.json").write_text(json.dumps([["NAME", "state"]]))
    return str(folder / "*" / "*.json")


def _dictionaries(folder: Path) -> str:
    for year in YEARS:
        variables = {"for": {"label": "x"}, "in": {}, "NAME": {}, "GEO_ID": {"label": "Geography"}}
        for code in ASKED:
            table = code.split("_")[0]
            if code == MISSING_IN_2023 and year == 2023:
                continue
            variables[f"{code}E"] = {
                "label": f"Estimate!!Total:!!Line {code}",
                "concept": f"Concept {table} (in {year} Inflation-Adjusted Dollars)",
            }
        variables["B99999_001E"] = {"label": "Estimate!!Unused", "concept": "Never Asked"}
        target = folder / str(year) / "variables.json"
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps({"variables": variables}))
    return str(folder / "*" / "*.json")


def _requested(path: Path) -> str:
    path.write_text("\n".join(["# codes", "", *ASKED, ASKED[0], "B00000_001"]))
    return str(path)


def _features(path: Path, shapes) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = []
    for i, properties in enumerate(shapes):
        ring = [[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]
        geometry = {"type": "Polygon", "coordinates": [ring]}
        lines.append(json.dumps({"type": "Feature", "properties": properties, "geometry": geometry}))
    path.write_text("\n".join(lines))
    return str(path)


def _schools(folder: Path) -> dict[str, str]:
    shared = ["District Name", "School Code", "School Name", "State Board Region", "Grade Span",
              "Number of Days Missed Due to Hurricane Helene", "Subgroup"]
    words = ["All Students", "Economically Disadvantaged", "Not Economically Disadvantaged", "White", "Black",
             "Students With Disabilities", "Not Student with Disabilities", "All English Learners"]

    def lead(code, word):
        return ["CMS", f" {code} ", f"School {code}", "SW", "K-12", "0", word]

    def each(extra):
        return [lead(code, word) + row for i, code in enumerate(SCHOOL_LIST) for j, word in enumerate(words) for row in extra(i, j)]

    def pct(i, j, k=0):
        value = 20 + i * 10 + j * 3 + k
        return ">95" if value > 66 else str(value + 0.5)

    scopes = ["All Subjects", "Grade 9-12", "Grade 3"]
    codes = [schools.SUBGROUP_CODES[w] for w in words]
    master = [
        ["2025", code, f"School {code}", "CMS", "K-12", "0", "Y" if i % 2 else "N", sub, subject, str(100 + j), pct(i, j), "1", "2", "3", "4", pct(i, j), pct(i, j, 1)]
        for i, code in enumerate(SCHOOL_LIST) for j, sub in enumerate([*codes, "NAIG"]) for subject in ("RDGS", "MAGS", "SCGS", "EOC", "MA37")
    ]
    glp, ccr = "Percent\nLevel 3 and Above\n(GLP)", "Percent\nLevel 4 and Above\n(CCR)"
    tables = {
        "school_combined_test_results": ([*shared, "Subject", glp, ccr], each(lambda i, j: [[s, pct(i, j, k), pct(i, j, k + 1)] for k, s in enumerate(scopes)])),
        "school_growth": ([*shared, "School Growth Type", "School Growth Status", "School Growth Index Score"], each(lambda i, j: [[t, "Met", str(i - 1.25)] for t in ("Overall", "Reading")])),
        "school_other_hs_indicators": ([*shared, "ACT/WorkKeys Assessments Indicator Percent", "Passing NC Math 3 Percent", "Four-Year Cohort Graduation Rate Percent", "Five-Year Cohort Graduation Rate Percent"], each(lambda i, j: [[pct(i, j), "<5", ">95" if i else "90.1", "*"]])),
        "school_assess_ind_master": (["reporting_year", "school_code", "school_name", "lea_name", "grade_span", "missed_days", "title_1", "subgroup", "subject", "den", "total_pct", "notprof_pct", "lev3_pct", "lev4_pct", "lev5_pct", "glp_pct", "ccr_pct"], master),
        "school_eog_eoc": ([*shared, "Subject", "Not Proficient", "Percent Level 3", "Percent Level 4", "Percent Level 5", glp, ccr], each(lambda i, j: [[s, "1", "2", "3", "4", pct(i, j), "*"] for s in ("Biology", "Science Grade 5&8", "Reading Grade 3")])),
        "school_act_grade11": ([*shared, "The ACT Subtest or Composite", "Percent Meeting Benchmark or Standard"], each(lambda i, j: [[m, pct(i, j)] for m in (schools.COMPOSITE, "ACT Math subtest", "Met all four")])),
        "school_workkeys": ([*shared, "Percent Silver or Higher"], each(lambda i, j: [[pct(i, j)]])),
        "school_english_learner": ([*shared, "Total EL Progress (Exited plus Annual Progress)", "Percent Exiting EL Status", "Percent Meeting Annual Progress Toward Exiting"], each(lambda i, j: [[pct(i, j), "<5", "3.5"]])),
        "school_subject_code_format": (["Subject Code", "Description"], [["RDGS", "Reading "], ["MAGS", "Math"], ["SCGS", "Science"], ["EOC ", "Courses"]]),
        "school_subgroup_format": (["Subgroup Code", "Subgroup Label"], [[c, f"{w} Student"] for w, c in zip(words, codes)]),
    }
    return {name: write_csv(folder / f"{name}.csv", header, data) for name, (header, data) in tables.items()}


def land_everything(root: Path) -> dict[str, str]:
    """Write all raw files under ``root`` and return bronze name -> path."""
    towns = ["Davidson", "Cornelius", "Huntersville"]
    months = [f"{m}/28/{y}" for y in (23, 24) for m in (1, 2, 3)]
    names = {g: f"Block Group {g[-1]}, Census Tract {g[7:9]}.{g[9:11]}, Mecklenburg County, North Carolina" for g in BLOCK_GROUPS}
    blocks = [b for bs in reports.NEIGHBORHOOD_BLOCKS.values() for b in bs]
    counts = ["total_households", "poverty_households", "alice_households", "above_alice_households"]
    bedrooms = ["Studio", "1-Bedroom", "2-Bedroom"]
    inputs = {
        "acs_blockgroup": _payloads(root / "bg", "block group", names),
        "acs_place": _payloads(root / "place", "place", PLACES),
        "acs_metadata": _dictionaries(root / "meta"),
        "acs_requested": _requested(root / "requested.txt"),
        "bg_geometry": _features(root / "bg.jsonl", [{"GEOID": g, "COUNTYFP": "119"} for g in BLOCK_GROUPS[:-1]] + [{"GEOID": "370250000001", "COUNTYFP": "025"}]),
        "block_geometry": _features(root / "block.jsonl", [{"GEOID20": b, "NAME20": f"Block {b[-4:]}", "COUNTYFP20": "119"} for b in blocks]),
        "zillow_home_values": write_csv(root / "zhvi.csv", ["town", "housing_type", "date", "home_value"], [[f" {t}", k, m, 100 * i + 7] for i, t in enumerate(towns) for k in ("condo", "house") for m in months]),
        "zillow_rents": write_csv(root / "zori.csv", ["RegionName", "date", "rent_index"], [[t, m, "NA" if t == "Davidson" and "/23" in m else 1000 + i] for i, t in enumerate(towns) for m in months]),
        "alice_household": write_csv(root / "alice.csv", ["town", "year", *counts], [[t.upper(), 2024, 10, 2, 3, 5] for t in towns]),
        "alice_county": write_csv(root / "county.csv", ["county", "year", *counts], [["Mecklenburg", y, 100, 20, 30, 50] for y in (2010, 2024)]),
        "ami_affordability_gap": write_csv(root / "ami.csv", ["bedrooms", "household_size", "ami_level", "annual_income", "max_affordable_rent", "fmr", "monthly_gap"], [[b, i + 1, f"{p}% AMI", 100 * p, 10 * p, 900, 10 * p - 500] for i, b in enumerate(bedrooms) for p in (30, 50, 100)]),
        "housing_wage": write_csv(root / "wage.csv", ["occupation", "hourly_wage", "employment", "category"], [["Wage Needed", 35.08, "NA", "Benchmark"], ["Teacher", 25.5, 1200, "Occupation"]]),
        "rent_by_bedroom": write_csv(root / "fmr.csv", ["region", "year", "bedrooms", "fmr"], [[r, y, b, 900 + i] for r in ("Charlotte-Concord-Gastonia", "Anson") for y in (2024, 2025) for i, b in enumerate(bedrooms[:2])]),
        "mh_su_facilities": write_csv(root / "mh.csv", ["name1", "street1", "street2", "city", "state", "zip", "county", "phone", "website", "latitude", "longitude", "type_facility", "payment_accepted", "services"], [["A", "1 St", "", "C", "NC", "28000", "Mecklenburg", "1", "w", "35.1", "x", "MH", "cash", "s"], ["B", "2 St", "", "C", "NC", "28001", "", "1", "w", "", "-80", "ZZ", "", ""]]),
        "cdc_places": write_csv(root / "cdc.csv", ["Year", "StateAbbr", "LocationName", "LocationID", "DataSource", "CategoryID", "MeasureID", "DataValueTypeID", "Measure", "Short_Question_Text", "Data_Value", "Low_Confidence_Limit", "High_Confidence_Limit", "TotalPopulation"], [["2023", "NC", "Davidson", "37001", "B", c, m, t, "m", "q", "12.5", "1", "2", "15,106"] for c, m in (("HLTHOUT", "ARTHRITIS"), ("HLTHOUT", "CANCER"), ("PREVENT", "DENTAL"), ("RISKBEH", "CSMOKING"), ("SOCLNEED", "FOODSTAMP"), ("HLTHSTAT", "GHLTH"), ("DISABLT", "HEARING")) for t in ("AgeAdjPrv", "CrdPrv", "Other")]),
        **_schools(root / "schools"),
    }
    return inputs
