"""Fact-to-dimension joins, lookups and membership."""

from pyspark.sql import functions as F

from civicloom.functions import semantics as s
from civicloom.operators import groups, joins, reshape
from civicloom.queries.registry import query
from civicloom.sources import relations


def order_lines(t):
    """Line totals per order: lines are combined before they meet the orders.

    Quantity is in hundredths and revenue in ten-thousandths.
    """
    net = s.units("l_extendedprice") * (F.lit(100) - s.units("l_discount"))
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"),
        F.sum(s.units("l_quantity")).alias("quantity"),
        F.sum(net).alias("revenue"),
    )


def placed_orders(t, *columns):
    """Orders with the nation of their customer and their year.

    The customer join happens at order size, so lines are shuffled only once,
    on the order key.
    """
    people = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"), *columns)
    return orders.join(people, "o_custkey").drop("o_custkey")


def nation_years(t):
    """Order measures per nation and year."""
    joined = placed_orders(t, "o_orderpriority").join(order_lines(t), "o_orderkey")
    # A nation's totals may pass the range of a long; one row per order is left by now.
    totals = [
        (F.sum(F.col(m).cast("decimal(20,0)")) / 10**d).alias(m)
        for m, d in (("quantity", 2), ("revenue", 4))
    ]
    return joined.groupBy("n_nationkey", "yr").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"),
        F.sum("lines").alias("lines"),
        F.sum("returned").alias("returned"),
        *totals,
    )


NATION_YEARS_SQL = """
    nation_years AS (
      SELECT c_nationkey AS n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS yr, count(DISTINCT o_orderkey) AS orders,
             count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS urgent, count(*) AS lines,
             count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
             sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,4)))) AS revenue
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(
    f"""
    WITH {NATION_YEARS_SQL}
    SELECT n_name AS nation, yr, orders, CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue,
           round((CAST(returned AS DOUBLE) / nullif(lines, 0)) * 100, 2) AS returned_pct,
           round((CAST(urgent AS DOUBLE) / nullif(orders, 0)) * 100, 2) AS urgent_pct,
           round(CAST(revenue AS DOUBLE) / nullif(orders, 0), 2) AS revenue_per_order
    FROM nation_years JOIN nation USING (n_nationkey)"""
)
def star_join_rates(t):
    """Lines, orders and customers rolled up to nation and year, with rates."""
    named = nation_years(t).join(t.nation.select("n_nationkey", "n_name"), "n_nationkey")
    return named.select(
        F.col("n_name").alias("nation"),
        "yr",
        "orders",
        F.col("quantity").cast("double").alias("quantity"),
        F.col("revenue").cast("double").alias("revenue"),
        s.safe_percent("returned", "lines").alias("returned_pct"),
        s.safe_percent("urgent", "orders").alias("urgent_pct"),
        s.round_binary(s.safe_ratio("revenue", "orders"), 2).alias("revenue_per_order"),
    )


@query(
    """
    SELECT p.c_nationkey AS nation_key, p.yr, p.priced, q.lines, r.late FROM
     (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS priced FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_totalprice > 300000 GROUP BY 1, 2) p
     JOIN (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey WHERE l_quantity > 45 GROUP BY 1, 2) q ON p.c_nationkey = q.c_nationkey AND p.yr = q.yr
     JOIN (SELECT c_nationkey, CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey WHERE year(l_shipdate) > year(o_orderdate) GROUP BY 1, 2) r ON p.c_nationkey = r.c_nationkey AND p.yr = r.yr"""
)
def multi_fact_join(t):
    """Three facts at (nation, year) grain joined on their common key."""
    keys = ["nation_key", "yr"]
    placed = placed_orders(t, "o_totalprice").withColumnRenamed("n_nationkey", "nation_key")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    one = F.count(F.lit(1)).alias("n")
    priced = placed.where("o_totalprice > 300000").groupBy(*keys).agg(F.count(F.lit(1)).alias("priced"))
    per_order = lines.where("l_quantity > 45").groupBy("o_orderkey").agg(one)
    bulky = per_order.join(placed, "o_orderkey").groupBy(*keys).agg(F.sum("n").alias("lines"))
    shipped = lines.groupBy("o_orderkey", F.year("l_shipdate").alias("ship_year")).agg(one)
    after = shipped.join(placed, "o_orderkey").where("ship_year > yr")
    late = after.groupBy("nation_key", F.col("ship_year").alias("yr")).agg(F.sum("n").alias("late"))
    return joins.join_facts([priced, bulky, late], keys)


@query(
    """
    SELECT c.c_custkey, c.c_name, o.orders, o.last_order FROM customer c LEFT JOIN
      (SELECT o_custkey, o_orderstatus, count(*) AS orders, CAST(max(o_orderdate) AS DATE) AS last_order FROM orders
       GROUP BY 1, 2) o
    ON c.c_custkey = o.o_custkey AND CASE WHEN c.c_acctbal < 0 THEN 'F' ELSE 'P' END = o.o_orderstatus"""
)
def left_join_keep(t):
    """Composite-key left join: customers without a match stay."""
    placed = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"))
        .agg(F.count(F.lit(1)).alias("orders"), F.to_date(F.max("o_orderdate")).alias("last_order"))
    )
    status = F.when(F.col("c_acctbal") < 0, "F").otherwise("P")
    base = t.customer.select("c_custkey", "c_name", status.alias("status"))
    return base.join(placed, ["c_custkey", "status"], "left").drop("status")


STATUS_FACT_SQL = """
    status_fact AS (SELECT o_custkey, o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
      FROM orders GROUP BY 1, 2)"""


def status_fact(t):
    return t.orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), s.from_units(F.sum(s.units("o_totalprice"))).alias("spent")
    )


@query(
    f"""
    WITH {STATUS_FACT_SQL}
    SELECT c_custkey, f.n AS filled_n, f.spent AS filled_spent, o.n AS open_n, o.spent AS open_spent, p.n AS pending_n, p.spent AS pending_spent
    FROM customer LEFT JOIN status_fact f ON c_custkey = f.o_custkey AND f.o_orderstatus = 'F'
    LEFT JOIN status_fact o ON c_custkey = o.o_custkey AND o.o_orderstatus = 'O'
    LEFT JOIN status_fact p ON c_custkey = p.o_custkey AND p.o_orderstatus = 'P'"""
)
def role_columns(t):
    """Three roles of one fact side by side: one aggregation, one left join."""
    roles = {"F": "filled", "O": "open", "P": "pending"}
    wide = reshape.role_columns(
        status_fact(t), ["o_custkey"], "o_orderstatus", roles, {"n": "_n", "spent": "_spent"}
    )
    base = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return joins.attach(base, wide, "o_custkey", "left").withColumnRenamed("o_custkey", "c_custkey")


@query(
    f"""
    WITH {STATUS_FACT_SQL}
    SELECT c_custkey, f.n AS filled, l.quality_lines FROM customer
    LEFT JOIN status_fact f ON c_custkey = f.o_custkey AND f.o_orderstatus = 'F'
    LEFT JOIN (SELECT user_id, count(*) AS quality_lines FROM events WHERE event_type = 'purchase' GROUP BY 1) l ON c_custkey = l.user_id"""
)
def role_join(t):
    """A base table with filtered rows of two different facts."""
    buys = t.events.groupBy(F.col("user_id").alias("o_custkey"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    base = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    filled = joins.role_join(
        base, status_fact(t), ["o_custkey"], F.col("o_orderstatus") == "F", {"n": "filled"}
    )
    both = joins.role_join(
        filled, buys, ["o_custkey"], F.col("event_type") == "purchase", {"n": "quality_lines"}
    )
    return both.withColumnRenamed("o_custkey", "c_custkey")


@query(
    """
    SELECT c_custkey, n_nationkey AS matched_nation FROM
    (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower('nation_' || c_nationkey) ELSE 'Nation_' || c_nationkey END AS typed FROM customer) c
    JOIN nation ON lower(typed) = lower(n_name)"""
)
def case_insensitive_join(t):
    spelled = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))
    typed = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, spelled).otherwise(F.initcap(spelled)).alias("typed"),
    )
    names = t.nation.select("n_name", F.col("n_nationkey").alias("matched_nation"))
    return joins.match_ignoring_case(typed, names, "typed", "n_name").select(
        "c_custkey", "matched_nation"
    )


@query(
    """
    SELECT s_suppkey, 2025 AS year_key, r_regionkey AS region_key, r_name AS region_name
    FROM supplier JOIN region ON r_name = 'EUROPE'"""
)
def constant_dimension(t):
    """The row of one fixed region on every supplier."""
    tagged = joins.attach_constant(
        t.supplier.select("s_suppkey", F.lit(2025).alias("year_key")),
        t.region,
        F.col("r_name") == "EUROPE",
        ["r_regionkey", "r_name"],
    )
    return tagged.withColumnsRenamed({"r_regionkey": "region_key", "r_name": "region_name"})


@query(
    """
    SELECT d.p_type, coalesce(f.label, u.label) AS label, lut.score
    FROM (SELECT DISTINCT p_type FROM part) d
    LEFT JOIN (VALUES ('ECONOMY', 'Economy'), ('SMALL', 'Small')) f(p_type, label) ON d.p_type = f.p_type
    LEFT JOIN (VALUES ('PROMO', 'Promotion, undocumented')) u(p_type, label) ON d.p_type = u.p_type
    LEFT JOIN (VALUES ('ECONOMY', 17), ('LARGE', 22)) lut(p_type, score) ON d.p_type = lut.p_type"""
)
def lookup_with_addendum(t):
    """Codes in use described from a documented list, a fixed addendum and a score list."""
    documented = relations.literal(
        t.spark, [("ECONOMY", "Economy"), ("SMALL", "Small")], {"p_type": "string", "label": "string"}
    )
    scores = relations.literal(t.spark, [("ECONOMY", 17), ("LARGE", 22)], {"p_type": "string", "score": "int"})
    codes = t.part.select("p_type").distinct()
    labelled = joins.lookup(
        codes, documented, "p_type", "label", {"PROMO": "Promotion, undocumented"}
    )
    return joins.lookup(labelled, scores, "p_type", "score")


@query(
    """
    SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48)"""
)
def semi_members(t):
    sold = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 48")
    keys = sold.select(F.col("l_partkey").alias("p_partkey"))
    return joins.only_members(t.part.select("p_partkey", "p_name"), keys, "p_partkey")


@query(
    """
    SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48)"""
)
def anti_report(t):
    sold = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 48")
    keys = sold.select(F.col("l_partkey").alias("p_partkey"))
    return joins.non_members(t.part.select("p_partkey", "p_name"), keys, "p_partkey")


@query(
    """
    SELECT l_returnflag AS source, l_partkey AS part_key FROM lineitem WHERE l_quantity = 50
    UNION SELECT 'catalog', p_partkey FROM part WHERE p_size > 48"""
)
def union_distinct(t):
    sold = t.lineitem.where("l_quantity = 50").select(
        F.col("l_returnflag").alias("source"), F.col("l_partkey").alias("part_key")
    )
    listed = t.part.where("p_size > 48").select(
        F.lit("catalog").alias("source"), F.col("p_partkey").alias("part_key")
    )
    return sold.unionByName(listed).distinct()


@query(
    """
    SELECT o_orderpriority, count(*) AS orders, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders
    WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1"""
)
def latest_vintage(t):
    dated = t.orders.withColumn("yr", F.year("o_orderdate"))
    newest = joins.latest_only(dated, "yr")
    return newest.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )


# Districts overlap on purpose: nation 7 belongs to two, nation 3 to three.
DISTRICTS = {
    "Harbour": [1, 3, 7],
    "Old Town": [3, 4],
    "North Side": [0, 2, 3, 5, 6, 7, 8, 9],
}
DISTRICTS_SQL = "(VALUES " + ", ".join(
    f"({n}, '{d}')" for d, members in DISTRICTS.items() for n in members
) + ") m(n_nationkey, district)"


@query(
    f"""
    WITH {NATION_YEARS_SQL}
    SELECT district, count(*) AS nation_years, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(revenue) AS DOUBLE) AS revenue,
           round((CAST(sum(returned) AS DOUBLE) / nullif(sum(lines), 0)) * 100, 2) AS returned_pct
    FROM nation_years JOIN {DISTRICTS_SQL} USING (n_nationkey) GROUP BY 1"""
)
def overlap_group_rollup(t):
    members = groups.membership(t.spark, DISTRICTS, "n_nationkey", "district")
    claimed = groups.by_group(nation_years(t), members, "n_nationkey")
    return (
        claimed.groupBy("district")
        .agg(
            F.count(F.lit(1)).alias("nation_years"),
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast("double").alias("revenue"),
            F.sum("returned").alias("returned"),
            F.sum("lines").alias("lines"),
        )
        .withColumn("returned_pct", s.safe_percent("returned", "lines"))
        .drop("returned", "lines")
    )


@query(
    """
    SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_groups, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS claimed_by
    FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1"""
)
def overlap_report(t):
    """Customers claimed by more than one priority class."""
    return groups.overlap_report(t.orders, "o_custkey", "o_orderpriority")


@query(
    """
    SELECT DISTINCT r_name AS region, c_mktsegment AS segment FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def region_segments(t):
    """Inner star join of customers, nations and regions reduced to what occurs."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    regions = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    pairs = t.customer.select("c_nationkey", F.col("c_mktsegment").alias("segment")).distinct()
    return joins.attach(joins.attach(pairs, nations, "c_nationkey"), regions, "n_regionkey").select(
        "region", "segment"
    ).distinct()


