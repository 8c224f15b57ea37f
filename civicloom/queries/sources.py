"""Reading raw files, landed payloads and dictionaries derived from the test tables."""

from pyspark.sql import functions as F

from civicloom.functions import semantics as s
from civicloom.operators.reshape import base_code
from civicloom.queries.registry import query
from civicloom.session import scratch_path
from civicloom.sources import boundaries, files, payloads, relations


@query(
    """
    SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
           CAST(c_acctbal AS INTEGER) AS whole FROM customer"""
)
def csv_scan(t):
    """Declared all-text scan of a written CSV, then typing."""
    path = scratch_path(t.spark, "csv")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.csv(path, header=True)
    raw = files.read_csv(t.spark, path, ["c_custkey", "c_name", "c_acctbal"])
    return raw.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        s.tolerant_double("c_acctbal").alias("c_acctbal"),
        s.whole_number(s.tolerant_double("c_acctbal")).alias("whole"),
    )


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS actworkkeys_indicator, s_name AS percent_level_3_and_above_glp,
           CAST(s_nationkey AS VARCHAR) AS _4th_place FROM supplier"""
)
def normalized_headers(t):
    """Awkward headers, one with line breaks, read back as normalised text columns."""
    path = scratch_path(t.spark, "headers")
    t.supplier.select(
        F.col("s_suppkey").alias("ACT/WorkKeys Indicator"),
        F.col("s_name").alias("Percent\nLevel 3 and Above\n(GLP)"),
        F.col("s_nationkey").alias("4th  Place"),
    ).write.csv(path, header=True)
    return files.read_csv_text(t.spark, path, line_breaks=True)


# One landed payload per customer: a header and two records, or a header only.
@query(
    """
    SELECT c_custkey, geoid AS "GEOID", nm AS "NAME", variable, estimate, moe FROM (
      SELECT c_custkey, '37' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS geoid, c_name AS nm, 'B01_001' AS variable,
             CAST(c_nationkey AS DOUBLE) AS estimate, CAST(0.5 AS DOUBLE) AS moe FROM customer WHERE c_acctbal >= 0
      UNION ALL
      SELECT c_custkey, '37' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0'), c_name, 'B01_002',
             CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END, NULL
      FROM customer WHERE c_acctbal >= 0
      UNION ALL
      SELECT c_custkey, '37999', 'total', 'B01_001', 1, NULL FROM customer WHERE c_acctbal >= 0
      UNION ALL
      SELECT c_custkey, '37999', 'total', 'B01_002', 2, NULL FROM customer WHERE c_acctbal >= 0) u"""
)
def payload_observations(t):
    """Array-of-arrays payloads straight to tidy observations; empty payloads vanish."""

    def row(*cells):
        return F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells])

    balance = F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(
        s.exact("c_acctbal", 12).cast("string")
    )
    county = F.lpad(F.col("c_nationkey").cast("string"), 3, "0")
    header = row("NAME", "B01_001E", "B01_001M", "B01_002E", "state", "county")
    first = row(F.col("c_name"), F.col("c_nationkey").cast("string"), "0.5", balance, "37", county)
    second = row("total", "1", "*", "2", "37", "999")
    table = F.when(F.col("c_acctbal") >= 0, F.array(header, first, second)).otherwise(F.array(header))
    landed = t.customer.select("c_custkey", F.to_json(table).alias("body"))
    return payloads.tidy_observations(landed, "body", ["state", "county"], ["c_custkey"])


@query(
    """
    SELECT p_partkey, code AS name, label, concept FROM (
      SELECT p_partkey, 'B' || p_size || '_001E' AS code, 'Estimate!!Total:!!' || p_name AS label, p_type AS concept FROM part
      UNION ALL SELECT p_partkey, 'GEO_ID', 'Geography', '' FROM part
      UNION ALL SELECT p_partkey, 'NAME', '', '' FROM part) d"""
)
def dictionary_entries(t):
    """Variable dictionaries with query keywords and missing fields."""
    entry = F.struct(
        F.concat(F.lit("Estimate!!Total:!!"), "p_name").alias("label"), F.col("p_type").alias("concept")
    )
    none = F.lit(None).cast("string")
    body = F.map_from_arrays(
        F.array(
            F.concat(F.lit("B"), F.col("p_size").cast("string"), F.lit("_001E")),
            F.lit("GEO_ID"), F.lit("NAME"), F.lit("for"), F.lit("in"),
        ),
        F.array(
            entry,
            F.struct(F.lit("Geography").alias("label"), none.alias("concept")),
            *[F.struct(none.alias("label"), none.alias("concept"))] * 3,
        ),
    )
    landed = t.part.select("p_partkey", F.to_json(F.struct(body.alias("variables"))).alias("body"))
    return payloads.dictionary_rows(landed, "body", ["p_partkey"])


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "block_GEOID", c_name AS block_name,
           '[' || c_custkey || ',' || c_nationkey || ']' AS corner
    FROM customer WHERE c_nationkey = 7"""
)
def boundary_features(t):
    """Feature lines, kept for one county, with their geometry as text."""
    x, y = F.col("c_custkey"), F.col("c_nationkey")
    square = F.array(
        F.array(F.array(x, y), F.array(x + 1, y), F.array(x + 1, y + 1), F.array(x, y + 1), F.array(x, y))
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            x.cast("string").alias("GEOID20"), F.col("c_name").alias("NAME20"), y.cast("string").alias("COUNTYFP20")
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), square.alias("coordinates")).alias("geometry"),
    )
    path = scratch_path(t.spark, "features")
    t.customer.select(F.to_json(feature).alias("value")).write.text(path)
    named = {"GEOID20": "block_GEOID", "NAME20": "block_name", "COUNTYFP20": "county"}
    read = boundaries.read_features(t.spark, path, named).where("county = '7'")
    shape = F.from_json("geometry", "type string, coordinates array<array<array<bigint>>>")
    return read.select(
        "block_GEOID", "block_name", F.to_json(shape["coordinates"][0][0]).alias("corner")
    )


@query(
    """
    SELECT c_custkey AS id, CASE WHEN c_nationkey = 3 THEN 'no JSON object' ELSE 'no properties' END AS why
    FROM customer WHERE c_nationkey IN (3, 5)"""
)
def rejected_features(t):
    """Feature lines cut short or without properties, listed; the others are read."""
    key = F.col("c_custkey").cast("string")
    whole = F.to_json(F.struct(F.struct(key.alias("GEOID20")).alias("properties"), F.lit(None).cast("string").alias("geometry")))
    bare = F.to_json(F.struct(key.alias("id"), F.lit("Feature").alias("type")))
    cut = F.concat(F.lit('{"id":"'), key, F.lit('","properties":{"GEOID20"'))
    line = F.when(F.col("c_nationkey") == 3, cut).when(F.col("c_nationkey") == 5, bare).otherwise(whole)
    path = scratch_path(t.spark, "lines")
    t.customer.select(line.alias("value")).write.text(path)
    lines = boundaries.read_lines(t.spark, path)
    read = boundaries.features(boundaries.accepted(lines, "line"), "line", {"GEOID20": "id"}).select(F.lit("read").alias("why"), F.col("id").cast("bigint").alias("id"))
    listed = boundaries.rejected(lines, "line").select("why", F.regexp_extract("line", '"id":"([0-9]+)"', 1).cast("bigint").alias("id"))
    twice = read.join(listed, "id", "left_semi")
    return listed.unionByName(twice).select("id", "why")


@query(
    """
    SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS calendar_year, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
           CAST(month(d) AS INTEGER) AS calendar_month, CAST(day(d) AS INTEGER) AS calendar_day,
           monthname(d) AS month_name, dayname(d) AS day_name, dayname(d) IN ('Saturday', 'Sunday') AS is_weekend,
           coalesce(n, 0) AS orders
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders) s
    LEFT JOIN (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY 1) o ON o.o_orderdate = s.d"""
)
def date_dim(t):
    """Every day between the first and last order, with the orders of the day."""
    day = F.to_date("o_orderdate")
    bounds = t.orders.select(F.min(day).alias("first"), F.max(day).alias("last"))
    per_day = t.orders.groupBy(day.alias("date_key")).agg(F.count(F.lit(1)).alias("n"))
    spine = relations.date_spine(bounds).join(per_day, "date_key", "left")
    return spine.withColumn("orders", F.coalesce("n", F.lit(0))).drop("n")


@query(
    """
    SELECT DISTINCT CAST(year(d) AS INTEGER) AS year_key, CAST(year(d) AS VARCHAR) AS year_label
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders) s"""
)
def year_dim(t):
    day = F.to_date("o_orderdate")
    bounds = t.orders.select(F.min(day).alias("first"), F.max(day).alias("last"))
    return relations.years_of(relations.date_spine(bounds))


@query(
    """
    SELECT CASE WHEN o_orderdate < '1998-01-01' THEN 1995 ELSE 1998 END AS vintage_year, o_orderstatus, count(*) AS orders,
           count(CASE WHEN o_orderdate >= '1998-01-01' THEN o_orderpriority END) AS priority_known FROM orders GROUP BY ALL"""
)
def vintage_stack(t):
    """Frames of two vintages under one another; the earlier lacks a column."""
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    frames = {
        1995: t.orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus"),
        1998: t.orders.where(F.col("o_orderdate") >= cut).select(
            "o_orderpriority", "o_orderstatus", "o_orderkey"
        ),
    }
    stacked = relations.stack_vintages(frames)
    return stacked.groupBy("vintage_year", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count("o_orderpriority").alias("priority_known")
    )


@query("SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def named_view(t):
    """A frame registered under a name and read with SQL text."""
    relations.register(t.customer, "raw_customer")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS customers FROM raw_customer GROUP BY 1")


REQUESTED_SQL = """
    SELECT DISTINCT CASE WHEN p_type = 'SMALL' THEN 'S' ELSE 'B' END || lpad(CAST(p_size AS VARCHAR), 3, '0') || '_' ||
           lpad(regexp_extract(p_brand, '([0-9]+)', 1), 3, '0') AS variable, p_retailprice > 950 AS listed FROM part"""


def _requested(t):
    prefix = F.when(F.col("p_type") == "SMALL", "S").otherwise("B")
    code = F.concat(
        prefix,
        F.lpad(F.col("p_size").cast("string"), 3, "0"),
        F.lit("_"),
        F.lpad(F.regexp_extract("p_brand", "([0-9]+)", 1), 3, "0"),
    )
    parts = t.part.select(code.alias("variable"), (F.col("p_retailprice") > 950).alias("listed"))
    dictionary = parts.where("listed").select(F.concat("variable", F.lit("E")).alias("name"))
    return parts.select("variable").distinct(), dictionary


@query(
    f"""
    WITH r AS ({REQUESTED_SQL})
    SELECT DISTINCT variable, CASE WHEN upper(variable) LIKE 'S%' THEN 'subject' ELSE 'detailed' END AS kind
    FROM r WHERE variable IN (SELECT variable FROM r WHERE listed)"""
)
def variables_kept(t):
    """Requested variables a dictionary lists, classified by table kind."""
    requested, dictionary = _requested(t)
    kept = payloads.requested_present(requested, dictionary)
    return kept.withColumn("kind", payloads.table_kind("variable"))


@query(
    f"""
    WITH r AS ({REQUESTED_SQL})
    SELECT DISTINCT variable FROM r WHERE variable NOT IN (SELECT variable FROM r WHERE listed)
      AND upper(variable) NOT LIKE 'S%'"""
)
def variables_missing(t):
    """Requested block-group variables the dictionary lacks."""
    requested, dictionary = _requested(t)
    asked = payloads.published_at(requested, "block group")
    return payloads.requested_missing(asked, dictionary)


@query(
    """
    WITH goods AS (
      SELECT p_partkey, 'P' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '_' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS code, p_type,
        list_filter(regexp_split_to_array(lower(p_name || ' ' || p_brand), '[^a-z0-9]+'), lambda w: w <> '') AS words,
        list_filter(regexp_split_to_array(lower(p_type), '[^a-z0-9]+'), lambda w: w <> '') AS kinds FROM part)
    SELECT code || 'E' AS name, code AS variable, 'total_' || array_to_string(words, '_') AS label_clean,
      p_type || ' goods, by size' AS concept, 'fact_' || array_to_string(kinds, '_') || '_goods_by_size' AS table_name
    FROM goods JOIN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'R' OR l_discount > 0.05)) u ON l_partkey = p_partkey"""
)
def variable_crosswalk(t):
    """Dictionary labels and concepts to column and table names, for variables that occur."""
    from civicloom.plans.survey import crosswalk

    code = F.concat(
        F.lit("P"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("_"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0"),
    )
    metadata = t.part.select(
        F.lit(2024).alias("year"),
        F.concat(code, F.lit("E")).alias("name"),
        F.concat(F.lit("Estimate!!Total:!!"), F.upper("p_name"), F.lit("!!"), "p_brand", F.lit(":")).alias("label"),
        F.concat("p_type", F.lit(" goods, by size (in 2024 Inflation-Adjusted Dollars) ")).alias("concept"),
        "p_partkey",
    )
    coded = metadata.select("p_partkey", base_code("name").alias("variable"))
    returned = t.lineitem.where("l_returnflag = 'R'").select("l_partkey")
    discounted = t.lineitem.where("l_discount > 0.05").select("l_partkey")
    in_use = [
        coded.join(keys, coded.p_partkey == keys.l_partkey, "left_semi")
        for keys in (returned, discounted)
    ]
    return crosswalk(metadata, in_use).drop("year")


