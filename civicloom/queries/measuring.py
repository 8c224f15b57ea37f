"""Bracket totals, rates, gaps, trends and summaries."""

from pyspark.sql import functions as F

from civicloom.functions import semantics as s
from civicloom.operators import metrics
from civicloom.queries.joining import NATION_YEARS_SQL, nation_years
from civicloom.queries.registry import query


@query(
    """
    SELECT l_suppkey, CAST(a + b + c AS BIGINT) AS small_total, CAST(c + d AS BIGINT) AS big_total FROM (
      SELECT l_suppkey, count(CASE WHEN l_quantity <= 10 THEN 1 END) AS a, count(CASE WHEN l_quantity > 10 AND l_quantity <= 20 THEN 1 END) AS b,
        sum(CASE WHEN l_quantity > 20 AND l_quantity <= 21 AND l_returnflag = 'R' THEN 1 END) AS c, sum(CASE WHEN l_quantity = 50 AND l_returnflag = 'N' AND l_linestatus = 'O' THEN 1 END) AS d
      FROM lineitem GROUP BY 1) x"""
)
def bracket_sum(t):
    """Sums of brackets, NULL as soon as one bracket is empty."""
    quantity = F.col("l_quantity")
    returned = (quantity > 20) & (quantity <= 21) & (F.col("l_returnflag") == "R")
    full = (quantity == 50) & (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    brackets = t.lineitem.groupBy("l_suppkey").agg(
        F.count(F.when(quantity <= 10, 1)).alias("a"),
        F.count(F.when((quantity > 10) & (quantity <= 20), 1)).alias("b"),
        F.sum(F.when(returned, 1)).alias("c"),
        F.sum(F.when(full, 1)).alias("d"),
    )
    return brackets.select(
        "l_suppkey",
        s.bracket_total(["a", "b", "c"]).alias("small_total"),
        s.bracket_total(["c", "d"]).alias("big_total"),
    )


RATE_SQL = """
    SELECT l_partkey, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n, count(CASE WHEN l_discount > 0.07 THEN 1 END) AS d
    FROM lineitem GROUP BY 1"""


def _rates(t):
    return t.lineitem.groupBy("l_partkey").agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n"),
        F.count(F.when(F.col("l_discount") > 0.07, 1)).alias("d"),
    )


@query(
    f"""
    SELECT l_partkey, round((n / nullif(d, 0)) * 100, 2) AS pct, round(n / nullif(d, 0), 1) AS ratio FROM ({RATE_SQL}) x"""
)
def guarded_ratio(t):
    """Zero denominators give NULL."""
    return _rates(t).select(
        "l_partkey",
        s.safe_percent("n", "d").alias("pct"),
        s.round_binary(s.safe_ratio("n", "d"), 1).alias("ratio"),
    )


@query(
    f"""
    SELECT l_partkey, CASE WHEN isfinite(r) THEN r END AS pct,
           CASE WHEN isnan(r) THEN 'undefined' WHEN isinf(r) THEN 'infinite' ELSE 'finite' END AS kind
    FROM (SELECT l_partkey, round((n / d) * 100, 2) AS r FROM ({RATE_SQL}) x) y"""
)
def unguarded_ratio(t):
    """Zero denominators give Infinity or NaN, told apart here."""
    rated = _rates(t).select("l_partkey", s.ieee_percent("n", "d").alias("r"))
    infinite = F.col("r") == F.lit(float("inf"))
    return rated.select(
        "l_partkey",
        F.when(~F.isnan("r") & ~infinite, F.col("r")).alias("pct"),
        F.when(F.isnan("r"), "undefined").when(infinite, "infinite").otherwise("finite").alias("kind"),
    )


PRICE_FACT_SQL = """
    price_fact AS (SELECT o_custkey, o_orderstatus AS role, max(o_totalprice) / 1000 AS pct FROM orders GROUP BY 1, 2)"""


def price_fact(t):
    """Best order per customer and status; one row per (customer, role)."""
    return t.orders.groupBy("o_custkey", F.col("o_orderstatus").alias("role")).agg(
        (F.max("o_totalprice") / 1000).alias("pct")
    )


@query(
    f"""
    WITH {PRICE_FACT_SQL}
    SELECT o_custkey, max(CASE WHEN role = 'F' THEN pct END) AS filled, max(CASE WHEN role = 'O' THEN pct END) AS open_pct,
           round(max(CASE WHEN role = 'O' THEN pct END) - max(CASE WHEN role = 'F' THEN pct END), 1) AS gap
    FROM price_fact WHERE role IN ('F', 'O') GROUP BY 1
    HAVING max(CASE WHEN role = 'F' THEN pct END) IS NOT NULL AND max(CASE WHEN role = 'O' THEN pct END) IS NOT NULL"""
)
def gap_wide(t):
    return metrics.gap_wide(
        price_fact(t), ["o_custkey"], "role", "pct", ("F", "filled"), ("O", "open_pct")
    )


@query(
    f"""
    WITH {PRICE_FACT_SQL}
    SELECT c.o_custkey, c.role, b.pct AS baseline_pct, c.pct AS comparison_pct, round(b.pct - c.pct, 1) AS gap
    FROM price_fact c JOIN price_fact b ON c.o_custkey = b.o_custkey AND b.role = 'F' WHERE c.role IN ('O', 'P')"""
)
def gap_long(t):
    """Baseline against each other role, one row per pair, without a self-join."""
    return metrics.gap_long(
        price_fact(t), ["o_custkey"], "role", "pct", ("F", "baseline_pct"), ["O", "P"]
    )


MONTHLY_SQL = """
    monthly AS (SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
      round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS mean_price
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def monthly_prices(t):
    segments = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    month = F.to_date(F.date_trunc("month", "o_orderdate")).alias("month_start")
    per_customer = t.orders.groupBy("o_custkey", month).agg(
        F.sum(s.units("o_totalprice")).alias("spent"), F.count(F.lit(1)).alias("n")
    )
    grouped = per_customer.join(segments, "o_custkey").groupBy("segment", "month_start")
    mean = s.round_binary(s.safe_ratio(s.from_units(F.sum("spent")), F.sum("n")), 2)
    return grouped.agg(mean.alias("mean_price"))


@query(
    f"""
    WITH {MONTHLY_SQL}
    SELECT segment, month_start, mean_price, lag(mean_price) OVER (PARTITION BY segment ORDER BY month_start) AS previous,
           round(mean_price - lag(mean_price) OVER (PARTITION BY segment ORDER BY month_start), 1) AS change
    FROM monthly"""
)
def trend_lag(t):
    """Monthly means beside the month before; a series is as long as the calendar."""
    trend = metrics.previous_value(monthly_prices(t), ["segment"], "month_start", "mean_price", "previous")
    return trend.withColumn("change", s.difference("mean_price", "previous"))


@query(
    """
    SELECT event_id, event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts NULLS LAST, event_id) AS previous
    FROM (SELECT event_id, value, nullif(event_type, 'view') AS event_type, CASE WHEN event_type <> 'click' OR value > 10 THEN ts END AS ts FROM events) e"""
)
def trend_lag_events(t):
    """Previous value per event type at event grain; one type is NULL, and so are some times."""
    timed = F.when((F.col("event_type") != "click") | (F.col("value") > 10), F.col("ts"))
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    rows = t.events.select("event_id", kind.alias("event_type"), timed.alias("ts"), "value")
    return metrics.previous_event(rows, ["event_type"], ["ts", "event_id"], "value", "previous").drop("ts")


@query(
    f"""
    WITH {MONTHLY_SQL},
    annual AS (SELECT segment, CAST(year(month_start) AS INTEGER) AS yr, CAST(sum(CAST(mean_price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
      FROM monthly GROUP BY 1, 2),
    balances AS (SELECT c_mktsegment AS segment, CAST(yr AS INTEGER) AS yr, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS balance
      FROM customer, (SELECT DISTINCT year(o_orderdate) + 1 AS yr FROM orders) y GROUP BY 1, 2)
    SELECT segment, yr, round(mean_price, 4) AS mean_price, round(balance, 4) AS balance, round(mean_price / nullif(balance, 0), 2) AS price_to_balance
    FROM balances LEFT JOIN annual USING (segment, yr)"""
)
def annual_affordability(t):
    """Yearly means joined to a base of the years after an order, of which the last has no prices."""
    cents = F.sum(s.exact("mean_price"))
    annual = monthly_prices(t).groupBy("segment", F.year("month_start").alias("yr")).agg(
        s.safe_ratio(cents, F.count(F.lit(1))).alias("mean_price")
    )
    years = t.orders.select((F.year("o_orderdate") + 1).alias("yr")).distinct()
    balances = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        s.safe_ratio(F.sum(s.exact("c_acctbal")), F.count(F.lit(1))).alias("balance")
    )
    every = years.agg(F.collect_set("yr").alias("ys")).scalar()
    base = balances.withColumn("yr", F.explode(every))
    joined = metrics.with_yearly(base, [annual], ["segment", "yr"])
    return joined.select(
        "segment",
        "yr",
        s.round_binary("mean_price", 4).alias("mean_price"),
        s.round_binary("balance", 4).alias("balance"),
        s.round_binary(s.safe_ratio("mean_price", "balance"), 2).alias("price_to_balance"),
    )


@query(
    """
    SELECT user_id, CAST(year(ts) AS INTEGER) AS year, round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2"""
)
def yearly_mean(t):
    means = metrics.yearly_mean(t.events, ["user_id"], "ts", "value", "mean_value")
    return means.withColumn("mean_value", s.round_binary("mean_value", 6))


@query(
    """
    SELECT n_name, r_name, CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END AS standing, (r_name = 'ASIA') AS is_asia, count(*) AS facility_count
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
    ORDER BY is_asia DESC, n_name, standing"""
)
def facility_summary(t):
    """Counts by several keys, ordered with the flagged group first."""
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    standing = F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit").alias("standing")
    counted = t.supplier.groupBy("s_nationkey", standing).agg(F.count(F.lit(1)).alias("n"))
    placed = counted.join(nations, "s_nationkey").join(
        t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    flagged = placed.withColumn("is_asia", F.col("r_name") == "ASIA")
    summary = flagged.groupBy("n_name", "r_name", "standing", "is_asia").agg(
        F.sum("n").alias("facility_count")
    )
    return summary.orderBy(*s.nulls_last("-is_asia", "n_name", "standing"))


@query(
    """
    SELECT c_mktsegment, count(DISTINCT o_custkey) AS buyers, round(avg(CAST(o_totalprice AS DECIMAL(18,2))), 1) AS mean_price,
           count(DISTINCT o_orderpriority) AS priorities
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def town_summary(t):
    """Distinct members and rounded means; orders are combined per customer first."""
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    per_customer = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(s.units("o_totalprice")).alias("spent")
    )
    joined = per_customer.join(segments, "o_custkey")
    return joined.groupBy("c_mktsegment").agg(
        F.count_distinct("o_custkey").alias("buyers"),
        s.round_binary(s.safe_ratio(s.from_units(F.sum("spent")), F.sum("n")), 1).alias("mean_price"),
        F.count_distinct("o_orderpriority").alias("priorities"),
    )


@query(
    f"""
    WITH {NATION_YEARS_SQL}
    SELECT n_nationkey, yr, round(CAST(urgent AS DOUBLE) - CAST(returned AS DOUBLE) / 7, 1) AS difference FROM nation_years"""
)
def difference_metric(t):
    years = nation_years(t)
    return years.select(
        "n_nationkey",
        "yr",
        s.difference(F.col("urgent").cast("double"), F.col("returned") / 7).alias("difference"),
    )


@query(
    """
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders GROUP BY ALL"""
)
def distinct_rows(t):
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


