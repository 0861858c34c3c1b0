"""Driver tables seen as ticket tables.

The driver ships TPC-H-like tables, not tickets.  This view gives them the
ticket roles so every operator runs on data that grows with the driver
tables.  One row per order:

=========================  ==============================================
ticket column              driver source
=========================  ==============================================
ticket_id                  o_orderkey
agency_name                c_mktsegment
violator_name              c_name
violation_street_number    o_custkey as text (high cardinality)
violation_street_name      n_name
city                       n_name
state                      r_name
zip_code                   c_nationkey as text
country                    'USA'
ticket_issued_date         o_orderdate
hearing_date               earliest l_shipdate of the order's 'F' lines,
                           null when the order has none
violation_code             number of lines of the order as text (null
                           when the order has no lines)
violation_description      smallest l_returnflag of the 'F' lines
disposition                o_orderpriority ('1-URGENT' plays "fine waived")
fine_amount                c_acctbal
late_fee                   o_totalprice / 10
discount_amount            -c_acctbal when negative, else 0
judgment_amount            o_totalprice
payment_status (train)     o_orderstatus (leakage: it defines the label)
compliance (train)         F -> 1, O -> 0, P -> null
=========================  ==============================================

Training tickets are issued before 1999-01-01, scoring tickets from then on.

Plan shape at scale: ``lineitem`` is aggregated by order key with a partial
(map-side) aggregate, so only one row per order crosses the shuffle; the
aggregate's output is already hash-partitioned by order key, so the left
join to ``orders`` shuffles ``orders`` only.  ``customer`` is joined by key
(broadcast while it is small by Spark's own statistics, sort-merge with AQE
skew splitting beyond); ``nation`` and ``region`` are fixed-size dimensions
broadcast after a row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

SPLIT_DATE = "1999-01-01 00:00:00"
WAIVED_DISPOSITION = "1-URGENT"

TICKET_COLUMNS = [
    "ticket_id", "agency_name", "violator_name", "violation_street_number",
    "violation_street_name", "city", "state", "zip_code", "country",
    "ticket_issued_date", "hearing_date", "violation_code", "violation_description",
    "disposition", "fine_amount", "late_fee", "discount_amount", "judgment_amount",
]
TRAIN_EXTRA = ["payment_status", "compliance"]

# Categorical columns of the view, used by the drift / fold / encode queries.
VIEW_CATEGORICALS = [
    "agency_name", "violator_name", "violation_street_number", "violation_street_name",
    "city", "state", "zip_code", "country", "violation_code", "violation_description",
    "disposition",
]
VIEW_FOLD_ATTRIBUTES = ["city", "violation_code", "violation_street_name",
                        "violation_description", "zip_code", "violation_street_number"]


def _line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_linestatus", "l_returnflag")
    done = F.col("l_linestatus") == F.lit("F")
    # l_returnflag is one character: its smallest code point is its smallest
    # value, and an integer min keeps the aggregate hash-based (a string min
    # would force a sort of all of lineitem before the partial aggregate).
    agg = li.groupBy(F.col("l_orderkey").alias("ticket_id")).agg(
        F.min(F.when(done, F.col("l_shipdate"))).alias("hearing_date"),
        F.min(F.when(done, F.ascii("l_returnflag"))).alias("_flag"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return agg.withColumn("violation_description", F.chr("_flag")).drop("_flag")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation with its region; both are read plainly, so the planner (and AQE
    at run time) picks the join from their sizes."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left").select(
        "n_nationkey", "n_name", "r_name")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tickets (both periods) with the training-only columns."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    # an order without a known customer is a ticket all the same
    base = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    base = base.join(_geo(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey"),
                     "c_nationkey", "left")
    base = base.join(_line_summary(spark, sf_dir),
                     base.o_orderkey == F.col("ticket_id"), "left")
    return base.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("c_mktsegment").alias("agency_name"),
        F.col("c_name").alias("violator_name"),
        F.col("o_custkey").cast("string").alias("violation_street_number"),
        F.col("n_name").alias("violation_street_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("c_nationkey").cast("string").alias("zip_code"),
        F.lit("USA").alias("country"),
        F.col("o_orderdate").alias("ticket_issued_date"),
        F.col("hearing_date"),
        F.col("n_lines").cast("string").alias("violation_code"),
        F.col("violation_description"),
        F.col("o_orderpriority").alias("disposition"),
        F.col("c_acctbal").alias("fine_amount"),
        (F.col("o_totalprice") / F.lit(10.0)).alias("late_fee"),
        F.when(F.col("c_acctbal") < 0, -F.col("c_acctbal")).otherwise(F.lit(0.0))
        .alias("discount_amount"),
        F.col("o_totalprice").alias("judgment_amount"),
        F.col("o_orderstatus").alias("payment_status"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1.0))
        .when(F.col("o_orderstatus") == "O", F.lit(0.0)).alias("compliance"),
    )


def train_part(t: DataFrame) -> DataFrame:
    return t.filter(F.col("ticket_issued_date") < F.lit(SPLIT_DATE).cast("timestamp_ntz"))


def scoring_part(t: DataFrame) -> DataFrame:
    """Scoring period, without the columns only the training table has.  A
    ticket without an issue date is scored: every ticket is in one period."""
    issued = F.col("ticket_issued_date")
    return (t.filter(issued.isNull() | (issued >= F.lit(SPLIT_DATE).cast("timestamp_ntz")))
            .drop(*TRAIN_EXTRA))


def train_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_part(tickets(spark, sf_dir))


def scoring_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring_part(tickets(spark, sf_dir))


def both_periods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(training, scoring) tickets from ONE computation of the view.

    For work that reads both periods more than once: the view (and its
    lineitem aggregate) is built once and materialized in the checkpoint
    folder, instead of once per period and per read."""
    from ..session import materialize
    t = materialize(tickets(spark, sf_dir), "tickets", wide=True)
    return train_part(t), scoring_part(t)


def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-hop lookup: ticket -> address (customer nation) -> place (region)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    step1 = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    step2 = step1.join(_geo(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey"),
                       "c_nationkey", "left")
    return step2.select(F.col("o_orderkey").alias("ticket_id"),
                        F.col("n_name").alias("address"),
                        F.col("r_name").alias("place"))


# ---------------------------------------------------------------------------
# The same view in DuckDB SQL, for the oracle.  ``WITH`` prefix defining
# ``tickets``, ``train_tickets`` and ``scoring_tickets``.
# ---------------------------------------------------------------------------

TICKETS_CTE = f"""
line_summary AS (
  SELECT l_orderkey AS ls_key,
         min(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS hearing_date,
         min(CASE WHEN l_linestatus = 'F' THEN l_returnflag END) AS violation_description,
         count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey
),
tickets AS (
  SELECT o.o_orderkey AS ticket_id,
         c.c_mktsegment AS agency_name,
         c.c_name AS violator_name,
         CAST(o.o_custkey AS VARCHAR) AS violation_street_number,
         n.n_name AS violation_street_name,
         n.n_name AS city,
         r.r_name AS state,
         CAST(c.c_nationkey AS VARCHAR) AS zip_code,
         'USA' AS country,
         o.o_orderdate AS ticket_issued_date,
         ls.hearing_date AS hearing_date,
         CAST(ls.n_lines AS VARCHAR) AS violation_code,
         ls.violation_description AS violation_description,
         o.o_orderpriority AS disposition,
         c.c_acctbal AS fine_amount,
         o.o_totalprice / 10.0 AS late_fee,
         CASE WHEN c.c_acctbal < 0 THEN -c.c_acctbal ELSE 0.0 END AS discount_amount,
         o.o_totalprice AS judgment_amount,
         o.o_orderstatus AS payment_status,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(1.0 AS DOUBLE)
              WHEN o.o_orderstatus = 'O' THEN CAST(0.0 AS DOUBLE) END AS compliance
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN line_summary ls ON ls.ls_key = o.o_orderkey
),
train_tickets AS (
  SELECT * FROM tickets WHERE ticket_issued_date < TIMESTAMP '{SPLIT_DATE}'
),
scoring_tickets AS (
  SELECT * EXCLUDE (payment_status, compliance) FROM tickets
  WHERE ticket_issued_date IS NULL OR ticket_issued_date >= TIMESTAMP '{SPLIT_DATE}'
)"""


def with_tickets(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix ``sql_body`` with the ticket CTEs (and optional more CTEs)."""
    more = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {TICKETS_CTE}{more}\n{sql_body}"
