"""Casts, sentinels, suppressed text, code maps, predicates and scalar functions."""

from pyspark.sql import functions as F

from civicloom.functions import names, parse, semantics as s
from civicloom.queries.registry import Tables, query

SEGMENT_CODES = {"AUTOMOBILE": "AUT", "BUILDING": "BLD", "FURNITURE": "FRN"}
PRIORITY_CODES = {
    "1-URGENT": "URG",
    "2-HIGH": "HI",
    "3-MEDIUM": "MED",
    "4-NOT SPECIFIED": "NS",
    "5-LOW": "LOW",
}


def sql_case(column: str, labels: dict, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


# Account balances as the text a raw file would hold, with the usual blemishes.
RAW_BALANCE_SQL = """
    SELECT c_custkey, c_nationkey, '  ' || c_name || ' ' AS raw_name,
           CASE WHEN c_acctbal < 0 THEN '<5' WHEN c_acctbal > 9000 THEN '>95'
                WHEN c_mktsegment = 'FURNITURE' THEN 'NA'
                ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS raw_balance
    FROM customer"""


def raw_balances(t: Tables):
    balance = (
        F.when(F.col("c_acctbal") < 0, "<5")
        .when(F.col("c_acctbal") > 9000, ">95")
        .when(F.col("c_mktsegment") == "FURNITURE", "NA")
        .otherwise(s.exact("c_acctbal", 12).cast("string"))
    )
    return t.customer.select(
        "c_custkey",
        "c_nationkey",
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("raw_name"),
        balance.alias("raw_balance"),
    )


@query(
    f"""
    SELECT c_custkey, trim(raw_name) AS customer, CAST(c_nationkey AS INTEGER) AS nation_key,
           TRY_CAST(raw_balance AS DOUBLE) AS balance,
           TRY_CAST(raw_balance AS INTEGER) AS whole_balance
    FROM ({RAW_BALANCE_SQL}) r WHERE raw_name IS NOT NULL"""
)
def typed_cleaning(t):
    """Trim and rename, strict cast, tolerant casts."""
    return (
        raw_balances(t)
        .where(F.col("raw_name").isNotNull())
        .select(
            "c_custkey",
            s.blank_trimmed("raw_name").alias("customer"),
            s.strict_int("c_nationkey").alias("nation_key"),
            s.tolerant_double("raw_balance").alias("balance"),
            s.tolerant_int("raw_balance").alias("whole_balance"),
        )
    )


@query(
    """
    SELECT event_id,
           CASE WHEN estimate = -666666666 THEN NULL ELSE estimate END AS estimate,
           CASE WHEN moe = -666666666 THEN NULL ELSE moe END AS moe
    FROM (SELECT event_id, CASE WHEN value < 10 THEN -666666666 ELSE value END AS estimate,
                 CASE WHEN event_type = 'error' THEN -666666666 ELSE value END AS moe FROM events) e"""
)
def sentinel_to_null(t):
    marked = t.events.select(
        "event_id",
        F.when(F.col("value") < 10, F.lit(float(s.NOT_ESTIMATED)))
        .otherwise(F.col("value"))
        .alias("estimate"),
        F.when(F.col("event_type") == "error", F.lit(float(s.NOT_ESTIMATED)))
        .otherwise(F.col("value"))
        .alias("moe"),
    )
    return marked.select(
        "event_id",
        s.null_if_sentinel("estimate").alias("estimate"),
        s.null_if_sentinel("moe").alias("moe"),
    )


@query(
    """
    SELECT p_partkey, raw AS share_raw, TRY_CAST(raw AS DOUBLE) AS share_pct,
           (TRY_CAST(raw AS DOUBLE) IS NULL) AS suppressed
    FROM (SELECT p_partkey, CASE WHEN p_size * 2 > 95 THEN '>95' WHEN p_size * 2 < 5 THEN '<5'
                 WHEN p_type = 'PROMO' THEN '*' ELSE CAST(p_size * 2 AS VARCHAR) END AS raw FROM part) p"""
)
def suppressed_pair(t):
    size = F.col("p_size") * 2
    raw = (
        F.when(size > 95, ">95")
        .when(size < 5, "<5")
        .when(F.col("p_type") == "PROMO", "*")
        .otherwise(size.cast("string"))
    )
    parts = t.part.select("p_partkey", raw.alias("raw"))
    return parts.select(
        "p_partkey",
        *s.raw_and_number("raw", "share_raw", "share_pct"),
        s.is_suppressed("raw").alias("suppressed"),
    )


@query(
    f"""
    SELECT c_custkey, {sql_case("trim(c_mktsegment)", SEGMENT_CODES)} AS segment_code
    FROM customer"""
)
def code_map_default_null(t):
    """Unknown codes are flagged with NULL."""
    code = s.code_label(F.trim("c_mktsegment"), SEGMENT_CODES)
    return t.customer.select("c_custkey", code.alias("segment_code"))


@query(
    f"""
    SELECT p_partkey, {sql_case("trim(p_type)", {"PROMO": "Promotion", "ECONOMY": "Economy line"}, "trim(p_type)")}
           AS type_label FROM part"""
)
def code_map_passthrough(t):
    """Unknown codes keep their own text."""
    label = s.code_label(
        F.trim("p_type"), {"PROMO": "Promotion", "ECONOMY": "Economy line"}, passthrough=True
    )
    return t.part.select("p_partkey", label.alias("type_label"))


@query(
    f"""
    SELECT {sql_case("o_orderpriority", PRIORITY_CODES)} AS priority_code,
           o_orderstatus, count(*) AS orders
    FROM orders GROUP BY ALL"""
)
def shared_code_map(t):
    """One mapping serves every fact that carries the label."""
    code = s.code_label("o_orderpriority", PRIORITY_CODES).alias("priority_code")
    return t.orders.groupBy(code, "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    """
    SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%widget%' THEN 'Widget'
        WHEN lower(p_name) LIKE 'blue%' THEN 'Blue goods'
        WHEN lower(p_name) LIKE '%rod' THEN 'Rod' ELSE 'Other' END AS family,
        regexp_matches(lower(p_name), 'gear|gizmo') AS geared
    FROM part"""
)
def pattern_case(t):
    rules = [("%widget%", "Widget"), ("blue%", "Blue goods"), ("%rod", "Rod")]
    return t.part.select(
        "p_partkey",
        s.first_match("p_name", rules, "Other").alias("family"),
        F.lower("p_name").rlike("gear|gizmo").alias("geared"),
    )


@query(
    """
    SELECT c_custkey, CASE WHEN bal >= 0 THEN 'Affordable' ELSE 'Unaffordable' END AS status,
           CASE WHEN lower(trim(c_mktsegment)) = 'machinery' THEN TRUE ELSE FALSE END AS is_machinery,
           (bal > 5000) AS is_rich
    FROM (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS bal FROM customer) c"""
)
def threshold_status(t):
    """A missing value reads as the lower status; a bare comparison stays missing."""
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return t.customer.select("c_custkey", "c_mktsegment", balance.alias("bal")).select(
        "c_custkey",
        s.at_least("bal", 0, "Affordable", "Unaffordable").alias("status"),
        F.coalesce(F.lower(F.trim("c_mktsegment")) == "machinery", F.lit(False)).alias("is_machinery"),
        (F.col("bal") > 5000).alias("is_rich"),
    )


@query(
    """
    SELECT * EXCLUDE (s_acctbal), '37119' AS county_id, 2025 AS year_key FROM supplier"""
)
def constant_and_star_minus(t):
    return t.supplier.drop("s_acctbal").select(
        "*", F.lit("37119").alias("county_id"), F.lit(2025).alias("year_key")
    )


@query(
    """
    SELECT o_orderpriority, count(*) AS orders FROM orders
    WHERE o_orderpriority IS NOT NULL AND o_orderstatus IN ('F', 'O')
      AND o_orderpriority NOT IN ('5-LOW') AND o_totalprice != 0 GROUP BY 1"""
)
def predicate_filters(t):
    return (
        t.orders.where(F.col("o_orderpriority").isNotNull())
        .where(F.col("o_orderstatus").isin("F", "O"))
        .where(~F.col("o_orderpriority").isin("5-LOW"))
        .where("o_totalprice != 0")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    """
    SELECT p_partkey, trim(BOTH '_' FROM '__' || p_name || '_') AS trimmed,
           lower(p_brand) || '/' || p_type AS joined, substr(p_name, 1, 4) AS head,
           replace('1,' || CAST(p_size AS VARCHAR), ',', '') AS plain,
           regexp_replace(p_name, '[aeiou]+', '-', 'g') AS dashed,
           regexp_replace(p_brand, '#.*$', '') AS brand_word,
           regexp_extract(p_brand, '([0-9]+)', 1) AS brand_number,
           regexp_extract(p_type, '([0-9]+)', 1) AS no_match,
           coalesce(nullif(p_type, 'PROMO'), 'promotion') AS type_or_word
    FROM part"""
)
def text_functions(t):
    return t.part.select(
        "p_partkey",
        F.expr("trim(BOTH '_' FROM concat('__', p_name, '_'))").alias("trimmed"),
        F.concat(F.lower("p_brand"), F.lit("/"), F.col("p_type")).alias("joined"),
        F.substring("p_name", 1, 4).alias("head"),
        s.strip_thousands(F.concat(F.lit("1,"), F.col("p_size").cast("string"))).alias("plain"),
        F.regexp_replace("p_name", "[aeiou]+", "-").alias("dashed"),
        F.regexp_replace("p_brand", "#.*$", "").alias("brand_word"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("brand_number"),
        F.regexp_extract("p_type", "([0-9]+)", 1).alias("no_match"),
        F.coalesce(F.nullif(F.col("p_type"), F.lit("PROMO")), F.lit("promotion")).alias("type_or_word"),
    )


@query(
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day,
           round(l_extendedprice * (1 - l_discount) / 7, 2) AS two,
           round(l_extendedprice / l_quantity / 3, 1) AS one,
           round((l_discount / nullif(l_tax, 0)) * 100, 2) AS pct
    FROM lineitem"""
)
def rounding_parity(t):
    """Rounding of binary doubles over every line, to one and two places."""
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("ship_day"),
        s.round_binary(net / F.lit(7), 2).alias("two"),
        s.round_binary(F.col("l_extendedprice") / F.col("l_quantity") / F.lit(3), 1).alias("one"),
        s.safe_percent("l_discount", "l_tax").alias("pct"),
    )


@query(
    """
    WITH made AS (SELECT p_partkey, p_size AS low, unnest(CASE
        WHEN p_size > 45 THEN [{'scope': 'All', 'span': NULL, 'course': false}]
        WHEN p_type = 'PROMO' THEN [{'scope': format('EOC ({}-{})', p_size, p_size + 3), 'span': 3, 'course': true}]
        WHEN p_type = 'SMALL' THEN [{'scope': format('{}&{}', p_size, p_size + 3), 'span': 3, 'course': false}]
        WHEN p_type = 'LARGE' THEN [{'scope': format('{}-{}', p_size, p_size + 5), 'span': 5, 'course': false}]
        WHEN p_type = 'MEDIUM' THEN [{'scope': NULL, 'span': NULL, 'course': NULL}]
        ELSE [{'scope': CAST(p_size AS VARCHAR), 'span': 0, 'course': false}] END) AS m FROM part)
    SELECT p_partkey, m.scope AS scope, CAST(low + 0 * m.span AS INTEGER) AS grade_min, CAST(low + m.span AS INTEGER) AS grade_max,
      m.course AS is_eoc FROM made"""
)
def scope_parse(t):
    size = F.col("p_size")
    scope = (
        F.when(size > 45, "All")
        .when(F.col("p_type") == "PROMO", F.format_string("EOC (%d-%d)", size, size + 3))
        .when(F.col("p_type") == "SMALL", F.format_string("%d&%d", size, size + 3))
        .when(F.col("p_type") == "LARGE", F.format_string("%d-%d", size, size + 5))
        .when(F.col("p_type") != "MEDIUM", size.cast("string"))
    )
    scoped = t.part.select("p_partkey", scope.alias("scope"))
    return scoped.select("p_partkey", "scope", *parse.grade_bounds("scope"))


AREA_SQL = """
    SELECT '37' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS geoid,
           'Block Group ' || (c_nationkey + 1) || ', Census Tract ' || c_custkey || '.0' || c_nationkey ||
           ', ' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'Union' ELSE 'Mecklenburg' END || ' County, North Carolina' AS name
    FROM customer"""


@query(
    f"""
    SELECT geoid AS "block_group_GEOID", regexp_extract(name, '^(Block Group [0-9]+)', 1) AS block_group_name,
           substr(geoid, 1, 11) AS "census_tract_GEOID", regexp_extract(name, '(Census Tract [0-9.]+)', 1) AS census_tract_name,
           substr(geoid, 1, 5) AS "county_GEOID", regexp_extract(name, '(Mecklenburg County)', 1) AS county_name
    FROM ({AREA_SQL}) a"""
)
def hierarchy_parse(t):
    geoid = F.concat(
        F.lit("37"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0"),
        F.lpad(F.col("c_custkey").cast("string"), 7, "0"),
    )
    county = F.when(F.col("c_mktsegment") == "BUILDING", "Union").otherwise("Mecklenburg")
    name = F.concat(
        F.lit("Block Group "), (F.col("c_nationkey") + 1).cast("string"),
        F.lit(", Census Tract "), F.col("c_custkey").cast("string"), F.lit(".0"),
        F.col("c_nationkey").cast("string"), F.lit(", "), county, F.lit(" County, North Carolina"),
    )
    areas = t.customer.select(geoid.alias("geoid"), name.alias("name"))
    return areas.select(*parse.area_hierarchy("geoid", "name", "Mecklenburg County"))


@query(
    """
    SELECT DISTINCT label, CAST(regexp_extract(label, '([0-9]+)%', 1) AS INTEGER) AS pct
    FROM (SELECT CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '% AMI' AS label FROM lineitem) d"""
)
def percent_label(t):
    label = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("% AMI"))
    labels = t.lineitem.select(label.alias("label")).distinct()
    return labels.select("label", parse.percent_of_label("label").alias("pct"))


@query(
    """
    SELECT lower(event_type) || '_' || lower('AgeAdjPrv') AS col_name, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1"""
)
def measure_columns(t):
    named = t.events.withColumn("col_name", names.measure_column("event_type", F.lit("AgeAdjPrv")))
    return named.groupBy("col_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(s.exact("value")).cast("double").alias("total")
    )
