"""Query catalog: every operator as a query over the driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library operator on
the ticket view (or on a driver table directly for the text operators);
``ORACLE_SQL[name]`` is the same result written independently in DuckDB
SQL over the raw tables.  Queries whose result depends on a fitted model
(trees, solvers) have no SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (BOOSTING_GRID, FOREST_TREES_GRID, FOREST_TREES_IMPORTANCE, GBT_TREE_GRID, LOGREG_C_GRID, LOGREG_C_GRID_UNDATED, MILE_PATTERN, ORGANISATION_PATTERNS, PO_BOX_PATTERN,
                         SCORING_CITY_ALIASES, SCORING_CITY_REPLACEMENTS, TRAIN_CITY_ALIASES,
                         TRAIN_CITY_REPLACEMENTS, COUNTRY_FROM_CITY, DAY_PARTS, SENTINEL_DATE)
from ..functions import text as TX
from ..functions.numeric import unit_hash_sql
from ..functions.temporal import calendar_parts, day_part_flags, parse_timestamp, sentinel_date
from ..operators import clean, encode, filters, geo, profile, segment, vocab
from ..session import bucketed, in_one_wave, materialize
from ..sources.tables import read_table
from ..sources.ticket_view import (VIEW_FOLD_ATTRIBUTES, WAIVED_DISPOSITION, both_periods,
                                   geo_lookup, scoring_tickets, tickets, train_tickets,
                                   with_tickets)
from . import boosting, deep_forest, dummies, logistic_path, metrics, models
from .routing import RouteSpec, encoded_segments, prepare_scoring, prepare_train, routed_scores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round for the comparison with another engine (the operators don't round)."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _labelled(spark, sf):
    return filters.labelled_rows(train_tickets(spark, sf))


NOT_WAIVED_SQL = f"NOT coalesce(contains(disposition, {_q(WAIVED_DISPOSITION)}), false)"
LABELLED_CTE = "lt AS (SELECT * FROM train_tickets WHERE compliance IS NOT NULL AND NOT isnan(compliance))"
NW_CTE = (LABELLED_CTE + f",\nt AS (SELECT * FROM lt WHERE {NOT_WAIVED_SQL}),\n"
          f"s AS (SELECT * FROM scoring_tickets WHERE {NOT_WAIVED_SQL})")
TTH_SQL = ("date_diff('second', date_trunc('second', ticket_issued_date), "
           "date_trunc('second', hearing_date))")


def _not_waived(df: DataFrame) -> DataFrame:
    return df.filter(~filters.contains_any("disposition", [WAIVED_DISPOSITION]))


# ===================================================================== sources
@query("scan_project", with_tickets(
    "SELECT ticket_id, agency_name, ticket_issued_date, disposition, judgment_amount FROM tickets"))
def scan_project(spark, sf):
    return tickets(spark, sf).select("ticket_id", "agency_name", "ticket_issued_date",
                                      "disposition", "judgment_amount")


@query("geo_lookup", """
SELECT o.o_orderkey AS ticket_id, n.n_name AS address, r.r_name AS place
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_geo_lookup(spark, sf):
    return geo_lookup(spark, sf)


@query("ticket_coordinates", """
SELECT o.o_orderkey AS ticket_id, c.c_name AS address, n.n_nationkey * 1.5 AS lat, n.n_regionkey * 10.0 AS lon
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_ticket_coordinates(spark, sf):
    """Ticket -> address -> coordinates: tickets and addresses lie bucketed by ticket, so neither is shuffled to be joined."""
    orders = read_table(spark, sf, "orders")
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    addresses = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("c_name").alias("address"))
    latlons = customer.join(read_table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").select(
        F.col("c_name").alias("address"), (F.col("c_nationkey") * 1.5).alias("lat"), (F.col("n_regionkey") * 10.0).alias("lon"))
    return geo.attach_coordinates(bucketed(orders.select(F.col("o_orderkey").alias("ticket_id")), "ticket_id"),
                                  bucketed(addresses, "ticket_id"), latlons)


# ===================================================================== projections / filters
@query("drop_leakage", with_tickets("SELECT * EXCLUDE (payment_status) FROM train_tickets"))
def q_drop_leakage(spark, sf):
    return filters.drop_leakage(train_tickets(spark, sf))


@query("rename_cols", with_tickets(
    "SELECT ticket_id, judgment_amount AS judgment, disposition AS disposition_label FROM tickets"))
def q_rename_cols(spark, sf):
    df = filters.rename_columns(tickets(spark, sf), {"judgment_amount": "judgment",
                                                     "disposition": "disposition_label"})
    return df.select("ticket_id", "judgment", "disposition_label")


@query("labelled_rows", with_tickets(
    "SELECT ticket_id, compliance, judgment_amount FROM lt", LABELLED_CTE))
def q_labelled_rows(spark, sf):
    return _labelled(spark, sf).select("ticket_id", "compliance", "judgment_amount")


@query("null_branch", with_tickets(
    "SELECT ticket_id, compliance, judgment_amount FROM lt WHERE hearing_date IS NULL", LABELLED_CTE))
def q_null_branch(spark, sf):
    return filters.null_rows(_labelled(spark, sf), "hearing_date").select(
        "ticket_id", "compliance", "judgment_amount")


@query("class_slice", with_tickets(
    "SELECT ticket_id, judgment_amount FROM lt WHERE compliance = 1", LABELLED_CTE))
def q_class_slice(spark, sf):
    return filters.class_slice(_labelled(spark, sf), 1.0).select("ticket_id", "judgment_amount")


AMOUNT_THRESHOLD = 150000.0


@query("amount_threshold", with_tickets(
    f"SELECT ticket_id, compliance, judgment_amount FROM lt WHERE judgment_amount <= {AMOUNT_THRESHOLD}",
    LABELLED_CTE))
def q_amount_threshold(spark, sf):
    return filters.amount_at_most(_labelled(spark, sf), AMOUNT_THRESHOLD).select(
        "ticket_id", "compliance", "judgment_amount")


@query("interval_filter", with_tickets(f"""
SELECT ticket_id, 'positive' AS tag, tth AS time_to_hearing FROM d WHERE tth > 0
UNION ALL
SELECT ticket_id, 'nonpositive_compliant' AS tag, tth AS time_to_hearing FROM d
WHERE tth <= 0 AND compliance = 1""",
    LABELLED_CTE + f",\nd AS (SELECT *, {TTH_SQL} AS tth FROM lt WHERE hearing_date IS NOT NULL)"))
def q_interval_filter(spark, sf):
    d = filters.with_time_to_hearing(filters.not_null_rows(_labelled(spark, sf), "hearing_date"))
    pos = filters.positive_interval(d).select("ticket_id", F.lit("positive").alias("tag"),
                                              "time_to_hearing")
    neg = filters.nonpositive_interval_of_class(d, 1.0).select(
        "ticket_id", F.lit("nonpositive_compliant").alias("tag"), "time_to_hearing")
    return pos.unionByName(neg)


@query("waived_split", with_tickets(f"""
SELECT ticket_id, CASE WHEN coalesce(contains(disposition, {_q(WAIVED_DISPOSITION)}), false)
                       THEN 1 ELSE 0 END AS waived
FROM lt""", LABELLED_CTE))
def q_waived_split(spark, sf):
    df = _labelled(spark, sf)
    waived, rest = filters.split_by_substring(df, "disposition", [WAIVED_DISPOSITION])
    return (waived.select("ticket_id", F.lit(1).alias("waived"))
            .unionByName(rest.select("ticket_id", F.lit(0).alias("waived"))))


@query("distinct_values", with_tickets("SELECT DISTINCT disposition FROM tickets"))
def q_distinct_values(spark, sf):
    return vocab.distinct_values(tickets(spark, sf), "disposition")


# ===================================================================== vocabularies
def _fold_sql(attrs, src, other, side):
    cols = ",\n  ".join(
        f"CASE WHEN {a} IN (SELECT {a} FROM {other} WHERE {a} IS NOT NULL) THEN {a} ELSE 'NaN' END AS {a}"
        for a in attrs)
    return f"SELECT ticket_id, '{side}' AS side,\n  {cols}\nFROM {src}"


@query("oov_fold", with_tickets(
    _fold_sql(VIEW_FOLD_ATTRIBUTES, "t", "s", "train") + "\nUNION ALL\n"
    + _fold_sql(VIEW_FOLD_ATTRIBUTES, "s", "t", "scoring"), NW_CTE))
def q_oov_fold(spark, sf):
    tr, sc = both_periods(spark, sf)
    t = _not_waived(filters.labelled_rows(tr))
    s = _not_waived(sc)
    ft, fs = vocab.mutual_vocab(t, s, VIEW_FOLD_ATTRIBUTES, materialize_inputs=False, key="ticket_id")
    cols = ["ticket_id", *VIEW_FOLD_ATTRIBUTES]
    return (ft.select(cols[0], F.lit("train").alias("side"), *cols[1:])
            .unionByName(fs.select(cols[0], F.lit("scoring").alias("side"), *cols[1:])))


def _set_sql(attrs, op):
    parts = []
    for a in attrs:
        parts.append(f"(SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM t WHERE {a} IS NOT NULL\n"
                     f" {op}\n SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM s "
                     f"WHERE {a} IS NOT NULL)")
    return "\nUNION ALL\n".join(parts)


@query("vocab_anti", with_tickets(_set_sql(VIEW_FOLD_ATTRIBUTES, "EXCEPT"), NW_CTE))
def q_vocab_anti(spark, sf):
    t = _not_waived(_labelled(spark, sf))
    s = _not_waived(scoring_tickets(spark, sf))
    return vocab.only_left(vocab.vocabulary(t, s, VIEW_FOLD_ATTRIBUTES))


@query("vocab_intersect", with_tickets(_set_sql(VIEW_FOLD_ATTRIBUTES, "INTERSECT"), NW_CTE))
def q_vocab_intersect(spark, sf):
    t = _not_waived(_labelled(spark, sf))
    s = _not_waived(scoring_tickets(spark, sf))
    return vocab.shared(vocab.vocabulary(t, s, VIEW_FOLD_ATTRIBUTES))


DRIFT_VIEW_ATTRIBUTES = ["violator_name", "violation_street_number", "violation_street_name",
                         "city", "zip_code", "violation_code", "violation_description"]


def _drift_sql(attrs):
    parts = []
    for a in attrs:
        parts.append(f"""SELECT '{a}' AS attribute,
  (SELECT CAST(count(*) FILTER (WHERE {a} IS NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.{a} IS NULL))
            + count(*) FILTER (WHERE {a} IS NOT NULL AND {a} NOT IN (SELECT {a} FROM s WHERE {a} IS NOT NULL)) AS DOUBLE)
     / CAST(count(*) AS DOUBLE) FROM t) AS left_only_ratio,
  (SELECT CAST(count(*) FILTER (WHERE {a} IS NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.{a} IS NULL))
            + count(*) FILTER (WHERE {a} IS NOT NULL AND {a} NOT IN (SELECT {a} FROM t WHERE {a} IS NOT NULL)) AS DOUBLE)
     / CAST(count(*) AS DOUBLE) FROM s) AS right_only_ratio""")
    return "\nUNION ALL\n".join(parts)


@query("drift_ratio", with_tickets(_drift_sql(DRIFT_VIEW_ATTRIBUTES), NW_CTE))
def q_drift_ratio(spark, sf):
    t = _not_waived(_labelled(spark, sf))
    s = _not_waived(scoring_tickets(spark, sf))
    return profile.category_drift(t, s, DRIFT_VIEW_ATTRIBUTES)


# ===================================================================== profiling
PROFILE_COLUMNS = ["ticket_id", "agency_name", "violator_name", "violation_street_number",
                   "violation_street_name", "city", "state", "zip_code", "country",
                   "ticket_issued_date", "hearing_date", "violation_code",
                   "violation_description", "disposition", "fine_amount", "late_fee",
                   "discount_amount", "judgment_amount", "payment_status", "compliance"]


@query("null_profile", with_tickets("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM tickets"
    for c in PROFILE_COLUMNS)))
def q_null_profile(spark, sf):
    return profile.null_profile(tickets(spark, sf), PROFILE_COLUMNS)


@query("null_branch_rate", with_tickets(
    "SELECT avg(compliance) AS rate, count(compliance) AS n FROM lt WHERE hearing_date IS NULL",
    LABELLED_CTE))
def q_null_branch_rate(spark, sf):
    return profile.conditional_rate(_labelled(spark, sf), F.col("hearing_date").isNull())


@query("rate_by_code", with_tickets("""
SELECT violation_code, avg(compliance) AS rate, count(compliance) AS n
FROM lt WHERE violation_code IS NOT NULL GROUP BY violation_code""", LABELLED_CTE))
def q_rate_by_code(spark, sf):
    return profile.rate_by(_labelled(spark, sf), "violation_code")


PEOPLE_SQL = ("CASE WHEN coalesce(regexp_matches(violator_name, "
              + _q("|".join(f"(?:{p})" for p in ORGANISATION_PATTERNS)) + "), false) THEN 0 ELSE 1 END")
RATE_VIEW_ATTRIBUTES = ["agency_name", "violation_street_number", "violation_street_name", "city",
                        "state", "zip_code", "country", "violation_code", "violation_description",
                        "disposition", "people"]


def _rate_sql(attrs):
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value, avg(compliance) AS rate, "
        f"count(compliance) AS n FROM lp WHERE {a} IS NOT NULL GROUP BY 2" for a in attrs)


@query("rate_by_attribute", with_tickets(
    _rate_sql(RATE_VIEW_ATTRIBUTES), LABELLED_CTE + f",\nlp AS (SELECT *, {PEOPLE_SQL} AS people FROM lt)"))
def q_rate_by_attribute(spark, sf):
    df = clean.add_text_flags(_labelled(spark, sf))
    return profile.rate_by_attributes(df, RATE_VIEW_ATTRIBUTES)


RATE_SETS = [["agency_name"], ["city"], ["disposition"], ["state"], ["violation_code"], ["agency_name", "disposition"], ["state", "violation_code"],
             ["city", "disposition"]]


def _grouping_sets_sql(sets) -> str:
    columns = sorted({c for s in sets for c in s})
    bits = {c: len(columns) - 1 - i for i, c in enumerate(columns)}
    whens = " ".join(f"WHEN {sum(1 << bits[c] for c in columns if c not in s)} THEN {_q(' * '.join(s))}" for s in sets)
    values = " ".join(f"WHEN {sum(1 << bits[c] for c in columns if c not in s)} THEN " + " || ' * ' || ".join(
        f"CAST({c} AS VARCHAR)" for c in s) for s in sets)
    return (f"SELECT CASE g {whens} END AS grouping, CASE g {values} END AS value, rate, n FROM (SELECT {', '.join(columns)}, "
            f"grouping({', '.join(columns)}) AS g, avg(compliance) AS rate, count(compliance) AS n FROM lt GROUP BY GROUPING SETS ("
            + ", ".join(f"({', '.join(s)})" for s in sets) + ")) WHERE value IS NOT NULL")


@query("rate_by_pairs", with_tickets(_grouping_sets_sql(RATE_SETS), LABELLED_CTE))
def q_rate_by_pairs(spark, sf):
    """Single attributes and chosen pairs in one Expand and one aggregate."""
    return profile.rate_by_sets(_labelled(spark, sf), RATE_SETS)


@query("freq_by_category", with_tickets("""
SELECT city, round(avg(judgment_amount), 6) AS mean,
       count(judgment_amount) AS n
FROM scoring_tickets WHERE city IS NOT NULL GROUP BY city"""))
def q_freq_by_category(spark, sf):
    return _rounded(profile.frequency_by(scoring_tickets(spark, sf), "city", "judgment_amount"), "mean")


SPREAD = ["mean", "std", "p25", "p50", "p75"]


def _describe_sql(src, value, group=None):
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"""SELECT {g}count({value}) AS count,
  round(avg({value}), 6) AS mean, round(stddev_samp({value}), 6) AS std, min({value}) AS min,
  round(quantile_cont({value}, 0.25), 6) AS p25, round(quantile_cont({value}, 0.5), 6) AS p50,
  round(quantile_cont({value}, 0.75), 6) AS p75, max({value}) AS max
FROM {src} WHERE {value} IS NOT NULL{gb}"""


@query("describe_by_class", with_tickets(_describe_sql("lt", "judgment_amount", "compliance"),
                                         LABELLED_CTE))
def q_describe_by_class(spark, sf):
    return _rounded(profile.describe_numeric(_labelled(spark, sf), "judgment_amount", ["compliance"]), *SPREAD)


@query("describe_late_fee", with_tickets(_describe_sql("lt", "late_fee", "disposition"), LABELLED_CTE))
def q_describe_late_fee(spark, sf):
    """An amount with three decimals."""
    return _rounded(profile.describe_numeric(_labelled(spark, sf), "late_fee", ["disposition"]), *SPREAD)


@query("describe_numeric", with_tickets(_describe_sql("scoring_tickets", "fine_amount")))
def q_describe_numeric(spark, sf):
    return _rounded(profile.describe_numeric(scoring_tickets(spark, sf), "fine_amount"), *SPREAD)


CATEGORICAL_DESCRIBE = ["agency_name", "violator_name", "city", "state", "violation_code",
                        "disposition"]


def _describe_cat_sql(attrs):
    longs = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM scoring_tickets "
        f"WHERE {a} IS NOT NULL" for a in attrs)
    return f"""SELECT attribute, CAST(sum(cnt) AS BIGINT) AS count, count(value) AS unique,
  arg_min(value, rk) AS top, max(cnt) AS freq
FROM (SELECT attribute, value, cnt,
        row_number() OVER (PARTITION BY attribute ORDER BY cnt DESC, value) AS rk
      FROM (SELECT attribute, value, count(*) AS cnt FROM ({longs}) GROUP BY attribute, value))
GROUP BY attribute"""


@query("describe_categorical", with_tickets(_describe_cat_sql(CATEGORICAL_DESCRIBE)))
def q_describe_categorical(spark, sf):
    return profile.describe_categorical(scoring_tickets(spark, sf), CATEGORICAL_DESCRIBE)


@query("histogram10", with_tickets("""
SELECT compliance, bin,
  round(mn + (mx - mn) * bin / 10.0, 4) AS lower,
  round(mn + (mx - mn) * (bin + 1) / 10.0, 4) AS upper, count(*) AS n
FROM (SELECT lt.compliance, b.mn, b.mx,
        CAST(CASE WHEN b.mx - b.mn = 0 THEN 0
             ELSE least(floor((lt.judgment_amount - b.mn) * 10.0 / (b.mx - b.mn)), 9) END AS INTEGER) AS bin
      FROM lt JOIN (SELECT compliance, min(judgment_amount) AS mn, max(judgment_amount) AS mx
                    FROM lt WHERE judgment_amount IS NOT NULL GROUP BY compliance) b
      ON lt.compliance = b.compliance
      WHERE lt.judgment_amount IS NOT NULL)
GROUP BY compliance, bin, mn, mx""", LABELLED_CTE))
def q_histogram10(spark, sf):
    return _rounded(profile.histogram(_labelled(spark, sf), "judgment_amount", ["compliance"]),
                    "lower", "upper", digits=4)


@query("histogram_all", with_tickets("""
SELECT bin, round(mn + (mx - mn) * bin / 10.0, 4) AS lower,
       round(mn + (mx - mn) * (bin + 1) / 10.0, 4) AS upper, count(*) AS n
FROM (SELECT b.mn, b.mx,
        CAST(CASE WHEN b.mx - b.mn = 0 THEN 0
             ELSE least(floor((t.fine_amount - b.mn) * 10.0 / (b.mx - b.mn)), 9) END AS INTEGER) AS bin
      FROM lt t, (SELECT min(fine_amount) AS mn, max(fine_amount) AS mx FROM lt) b
      WHERE t.fine_amount IS NOT NULL)
GROUP BY bin, mn, mx""", LABELLED_CTE))
def q_histogram_all(spark, sf):
    """All labelled training rows, one amount with negative values."""
    return _rounded(profile.histogram(_labelled(spark, sf), "fine_amount"), "lower", "upper", digits=4)


def _slices(df: DataFrame):
    is_train = F.col("ticket_issued_date") < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return [
        ("compliant", is_train & (F.col("compliance") == 1)),
        ("non_compliant", is_train & (F.col("compliance") == 0)),
        ("scoring", ~is_train),
        ("null_hearing", is_train & F.col("compliance").isNotNull() & F.col("hearing_date").isNull()),
    ]


@query("boxplot_by_slice", with_tickets("""
SELECT slice, round(quantile_cont(judgment_amount, 0.0), 4) AS lo,
  round(quantile_cont(judgment_amount, 0.25), 4) AS q1,
  round(quantile_cont(judgment_amount, 0.5), 4) AS median,
  round(quantile_cont(judgment_amount, 0.75), 4) AS q3,
  round(quantile_cont(judgment_amount, 1.0), 4) AS hi
FROM (
  SELECT 'compliant' AS slice, judgment_amount FROM train_tickets WHERE compliance = 1
  UNION ALL SELECT 'non_compliant', judgment_amount FROM train_tickets WHERE compliance = 0
  UNION ALL SELECT 'scoring', judgment_amount FROM scoring_tickets
  UNION ALL SELECT 'null_hearing', judgment_amount FROM train_tickets
            WHERE compliance IS NOT NULL AND hearing_date IS NULL)
WHERE judgment_amount IS NOT NULL GROUP BY slice"""))
def q_boxplot_by_slice(spark, sf):
    df = tickets(spark, sf)
    slices = _slices(df)
    return _rounded(profile.boxplot_summary(profile.tag_slices(df, slices), "judgment_amount"), "lo", "q1", "median", "q3", "hi", digits=4)


@query("label_prior", with_tickets(
    "SELECT avg(compliance) AS prior, count(compliance) AS n FROM t WHERE hearing_date IS NOT NULL",
    NW_CTE))
def q_label_prior(spark, sf):
    t = _not_waived(_labelled(spark, sf)).filter(F.col("hearing_date").isNotNull())
    return profile.target_prior(t)


# ===================================================================== scalar cleaning
SENTINEL_VIEW = ["violator_name", "state", "zip_code", "violation_code", "violation_description"]


@query("null_sentinel", with_tickets("SELECT ticket_id, " + ", ".join(
    f"coalesce({c}, 'NaN') AS {c}" for c in SENTINEL_VIEW) + " FROM tickets"))
def q_null_sentinel(spark, sf):
    return clean.fill_sentinel(tickets(spark, sf), SENTINEL_VIEW).select("ticket_id", *SENTINEL_VIEW)


@query("null_default", with_tickets(
    "SELECT ticket_id, coalesce(violation_code, '0') AS violation_code FROM scoring_tickets"))
def q_null_default(spark, sf):
    return clean.fill_default(scoring_tickets(spark, sf), "violation_code", "0").select(
        "ticket_id", "violation_code")


def _number_text_sql(c):
    s = f"CAST({c} AS VARCHAR)"
    return (f"CASE WHEN regexp_matches({s}, '^-?[0-9]+\\.0+$') "
            f"THEN CAST(CAST(floor({c}) AS BIGINT) AS VARCHAR) ELSE {s} END")


@query("cast_string", with_tickets(
    f"SELECT ticket_id, {_number_text_sql('fine_amount')} AS fine_amount, "
    f"{_number_text_sql('judgment_amount')} AS judgment_amount, "
    f"violation_street_number, zip_code FROM tickets"))
def q_cast_string(spark, sf):
    df = clean.cast_to_text(tickets(spark, sf), ["fine_amount", "judgment_amount",
                                                 "violation_street_number", "zip_code"])
    return df.select("ticket_id", "fine_amount", "judgment_amount", "violation_street_number",
                     "zip_code")


def _replace_sql(expr, rules):
    for old, new in rules:
        expr = f"replace({expr}, {_q(old)}, {_q(new)})"
    return expr


def _alias_sql(expr, aliases):
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in aliases.items())
    return f"CASE {expr} {whens} ELSE {expr} END"


def _city_sql(c, replacements, aliases):
    return _alias_sql(_replace_sql(f"upper({c})", replacements), aliases)


@query("city_normalise", with_tickets(f"""
SELECT p_partkey, {_city_sql('p_name', SCORING_CITY_REPLACEMENTS, SCORING_CITY_ALIASES)} AS city,
       {_city_sql('p_type', TRAIN_CITY_REPLACEMENTS, TRAIN_CITY_ALIASES)} AS city_train_rules
FROM part"""))
def q_city_normalise(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return part.select(
        "p_partkey",
        TX.normalise_city("p_name", SCORING_CITY_REPLACEMENTS, SCORING_CITY_ALIASES).alias("city"),
        TX.normalise_city("p_type", TRAIN_CITY_REPLACEMENTS, TRAIN_CITY_ALIASES).alias("city_train_rules"))


@query("alias_map", with_tickets(f"""
SELECT p_partkey, {_alias_sql("replace(upper(p_name), ' ', '')", SCORING_CITY_ALIASES)} AS city
FROM part"""))
def q_alias_map(spark, sf):
    part = read_table(spark, sf, "part").select(
        "p_partkey", F.replace(F.upper("p_name"), F.lit(" "), F.lit("")).alias("city"))
    return clean.apply_aliases(part, "city", SCORING_CITY_ALIASES)


ORG_SQL = _q("|".join(f"(?:{p})" for p in ORGANISATION_PATTERNS))


@query("entity_flag", f"""
SELECT 'document' AS source, doc_id AS id,
       CASE WHEN coalesce(regexp_matches(text, {ORG_SQL}), false) THEN 0 ELSE 1 END AS people
FROM documents
UNION ALL
SELECT 'customer', c_custkey,
       CASE WHEN coalesce(regexp_matches(c_name, {ORG_SQL}), false) THEN 0 ELSE 1 END
FROM customer
UNION ALL
SELECT 'part', p_partkey,
       CASE WHEN coalesce(regexp_matches(p_name, {ORG_SQL}), false) THEN 0 ELSE 1 END
FROM part""")
def q_entity_flag(spark, sf):
    docs = read_table(spark, sf, "documents").select(
        F.lit("document").alias("source"), F.col("doc_id").alias("id"),
        TX.person_flag("text").alias("people"))
    cust = read_table(spark, sf, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
        TX.person_flag("c_name").alias("people"))
    part = read_table(spark, sf, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
        TX.person_flag("p_name").alias("people"))
    return docs.unionByName(cust).unionByName(part)


@query("pobox_flag", f"""
SELECT doc_id, CASE WHEN coalesce(regexp_matches(text, {_q(PO_BOX_PATTERN)}), false) THEN 1 ELSE 0 END
  AS address_BOX FROM documents""")
def q_pobox_flag(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", TX.po_box_flag("text").alias("address_BOX"))


@query("mile_flag", f"""
SELECT doc_id, CASE WHEN coalesce(regexp_matches(text, {_q(MILE_PATTERN)}), false) THEN 1 ELSE 0 END
  AS address_MILE FROM documents""")
def q_mile_flag(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", TX.mile_flag("text").alias("address_MILE"))


DISPOSITION_VIEW_RULES = [("URGENT", "PRIORITY HIGH"), ("HIGH", "PRIORITY HIGH"), ("LOW", "PRIORITY LOW")]


def _last_wins_sql(c, rules, base):
    whens = " ".join(f"WHEN coalesce(contains({c}, {_q(p)}), false) THEN {_q(v)}"
                     for p, v in reversed(rules))
    return f"CASE {whens} ELSE {base} END"


@query("collapse_disposition", with_tickets(
    f"SELECT ticket_id, {_last_wins_sql('disposition', DISPOSITION_VIEW_RULES, 'disposition')} "
    "AS disposition FROM scoring_tickets"))
def q_collapse_disposition(spark, sf):
    return clean.collapse_categories(scoring_tickets(spark, sf), "disposition",
                                     DISPOSITION_VIEW_RULES).select("ticket_id", "disposition")


@query("country_from_city", f"""
SELECT p_partkey, {_last_wins_sql("upper(p_name)", COUNTRY_FROM_CITY, "'USA'")} AS country FROM part""")
def q_country_from_city(spark, sf):
    part = read_table(spark, sf, "part").select(
        "p_partkey", F.upper("p_name").alias("city"), F.lit("USA").alias("country"))
    return clean.country_from_city(part).select("p_partkey", "country")


# Spellings as clerks write them; every rule table has values that hit.
CITY_SPELLINGS = ["Detroit", "det roit", "Deteoit", "DETROIT,", "LOS ANGLES", "las vagas", "San Dieego", "Windsor Canada", "Sydney, Austria",
                  "London England", "TAIWAN", "Singaproe", "New Your", "Sterling Heights", None, "Cleve.land"]


def _address_sql() -> str:
    spelled = "(['" + "', '".join(c or "?" for c in CITY_SPELLINGS) + f"'])[c_custkey % {len(CITY_SPELLINGS)} + 1]"
    return f"""
WITH a AS (SELECT c_custkey, nullif({spelled}, '?') AS city,
  CASE c_custkey % 4 WHEN 0 THEN 'P.O. bOx ' || c_custkey WHEN 1 THEN c_custkey || ' Mile Rd' WHEN 2 THEN n_name END AS address
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, {_city_sql('city', TRAIN_CITY_REPLACEMENTS, TRAIN_CITY_ALIASES)} AS city_train,
  {_city_sql("coalesce(city, 'DETROIT')", SCORING_CITY_REPLACEMENTS, SCORING_CITY_ALIASES)} AS city_scoring,
  {_alias_sql("replace(upper(city), ' ', '')", SCORING_CITY_ALIASES)} AS city_alias,
  {_last_wins_sql("upper(city)", COUNTRY_FROM_CITY, "'USA'")} AS country,
  CASE WHEN coalesce(regexp_matches(address, {_q(PO_BOX_PATTERN)}), false) THEN 1 ELSE 0 END AS address_BOX,
  CASE WHEN coalesce(regexp_matches(address, {_q(MILE_PATTERN)}), false) THEN 1 ELSE 0 END AS address_MILE FROM a"""


@query("address_rules", _address_sql())
def q_address_rules(spark, sf):
    """City, alias, country, PO-box and mile rules on customers whose city and address are written in many ways."""
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key, spelled = F.col("c_custkey"), F.array(*map(F.lit, CITY_SPELLINGS))
    address = (F.when(key % 4 == 0, F.concat(F.lit("P.O. bOx "), key.cast("string")))
               .when(key % 4 == 1, F.concat(key.cast("string"), F.lit(" Mile Rd"))).when(key % 4 == 2, F.col("n_name")))
    a = customer.join(nation, "c_nationkey", "left").select(
        "c_custkey", F.get(spelled, (key % len(CITY_SPELLINGS)).cast("int")).alias("city"), address.alias("mailing_address_str_name"))
    a = a.withColumns({"city_train": F.col("city"), "city_scoring": F.col("city"), "country": F.lit("USA"),
                       "upper_city": F.upper("city"), "city_alias": F.replace(F.upper("city"), F.lit(" "), F.lit(""))})
    a = clean.normalise_city(a, "city_train", "train")
    a = clean.normalise_city(clean.fill_default(a, "city_scoring"), "city_scoring", "scoring")
    a = clean.country_from_city(clean.apply_aliases(a, "city_alias", SCORING_CITY_ALIASES), "upper_city")
    return clean.add_text_flags(a).select("c_custkey", "city_train", "city_scoring", "city_alias", "country", "address_BOX", "address_MILE")


# ===================================================================== time
@query("seconds_between", with_tickets(
    f"SELECT ticket_id, {TTH_SQL} AS time_to_hearing FROM tickets"))
def q_seconds_between(spark, sf):
    return filters.with_time_to_hearing(tickets(spark, sf)).select("ticket_id", "time_to_hearing")


@query("parse_timestamp", """
SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts_parsed,
       CAST(try_strptime(props, '%Y-%m-%d') AS TIMESTAMP) AS bad_parsed
FROM events""")
def q_parse_timestamp(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(
        "event_id",
        parse_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")
        .alias("ts_parsed"),
        # JSON text is not a date: ANSI-safe parsing gives null instead of failing
        parse_timestamp(F.col("props"), "yyyy-MM-dd").alias("bad_parsed"))


@query("sentinel_date", with_tickets(f"""
SELECT ticket_id, coalesce(hearing_date, TIMESTAMP '{SENTINEL_DATE}') AS hearing_date,
       coalesce(hearing_date, TIMESTAMP '{SENTINEL_DATE}') = TIMESTAMP '{SENTINEL_DATE}' AS undated
FROM tickets"""))
def q_sentinel_date(spark, sf):
    t = tickets(spark, sf).select("ticket_id", sentinel_date("hearing_date").alias("hearing_date"))
    return t.withColumn("undated", F.col("hearing_date") == F.lit(SENTINEL_DATE).cast("timestamp_ntz"))


@query("calendar_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour
FROM events""")
def q_calendar_parts(spark, sf):
    return read_table(spark, sf, "events").select("event_id", *calendar_parts("ts"))


@query("daypart_flags", "SELECT event_id, " + ", ".join(
    f"(hour(ts) >= {lo} AND hour(ts) < {hi}) AS {name}" for name, lo, hi in DAY_PARTS)
    + " FROM events")
def q_daypart_flags(spark, sf):
    return read_table(spark, sf, "events").select("event_id", *day_part_flags("ts"))


# ===================================================================== encoding
DISPOSITIONS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _dummy_sql(col, values):
    return ", ".join(f"CASE WHEN {col} = {_q(v)} THEN 1 ELSE 0 END AS \"{col}_{v}\"" for v in values)


@query("one_hot", with_tickets(
    f"SELECT ticket_id, {_dummy_sql('disposition', DISPOSITIONS)}, {_dummy_sql('agency_name', SEGMENTS)} FROM lt",
    LABELLED_CTE))
def q_one_hot(spark, sf):
    df = _labelled(spark, sf).select("ticket_id", "disposition", "agency_name")
    return encode.one_hot(df, ["disposition", "agency_name"])


ALIGNED = ["disposition_urgent_or_high", "disposition_3-MEDIUM", "disposition_5-LOW",
           "disposition_9-UNKNOWN"]


@query("one_hot_merge", with_tickets(f"""
SELECT ticket_id,
  greatest(CASE WHEN disposition = '1-URGENT' THEN 1 ELSE 0 END,
           CASE WHEN disposition = '2-HIGH' THEN 1 ELSE 0 END, 0) AS disposition_urgent_or_high,
  CASE WHEN disposition = '3-MEDIUM' THEN 1 ELSE 0 END AS "disposition_3-MEDIUM",
  CASE WHEN disposition = '5-LOW' THEN 1 ELSE 0 END AS "disposition_5-LOW",
  0 AS "disposition_9-UNKNOWN"
FROM scoring_tickets"""))
def q_one_hot_merge(spark, sf):
    df = scoring_tickets(spark, sf).select("ticket_id", "disposition")
    return encode.align_dummies(
        encode.one_hot(df, ["disposition"]), ["ticket_id"] + ALIGNED,
        merges={"disposition_urgent_or_high": ["disposition_1-URGENT", "disposition_2-HIGH"]})


# ===================================================================== the one-hot baseline as one pipeline
BASELINE_DUMMIES = ["disposition", "agency_name", "month", "weekday"]
BASELINE_MERGES = {"disposition": {"1-URGENT": "1-2 PRESSING", "2-HIGH": "1-2 PRESSING"}}
BASELINE_COLUMNS = ["ticket_id", "fine_amount", "judgment_amount", "agency_name", "ticket_issued_date", "disposition"]


def _baseline_dummies() -> list:
    return [dummies.CalendarFeatures(inputCol="ticket_issued_date"), dummies.SparseDummies(BASELINE_DUMMIES, "dummies", BASELINE_MERGES, "ticket_id")]


def _baseline_values_sql(src: str) -> str:
    value = {"disposition": "CASE WHEN disposition IN ('1-URGENT', '2-HIGH') THEN '1-2 PRESSING' ELSE disposition END", "agency_name": "agency_name",
             "month": "CAST(month(ticket_issued_date) AS VARCHAR)", "weekday": "CAST(isodow(ticket_issued_date) - 1 AS VARCHAR)"}
    return " UNION ALL ".join(f"SELECT ticket_id, {i} AS place, {value[a]} AS value FROM {src}" for i, a in enumerate(BASELINE_DUMMIES))


@query("one_hot_sparse", with_tickets("SELECT ticket_id, CAST(num AS INTEGER) AS dummy FROM scored JOIN vocabulary USING (place, value)", LABELLED_CTE + f""",
labelled AS ({_baseline_values_sql('lt')}), scored AS ({_baseline_values_sql('scoring_tickets')}),
vocabulary AS (SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS num FROM (SELECT DISTINCT place, value FROM labelled WHERE value IS NOT NULL))"""))
def q_one_hot_sparse(spark, sf):
    """Scoring tickets' sparse dummies as (ticket, place) pairs, aligned with the training vocabulary by the fitted stages."""
    fitted = Pipeline(stages=_baseline_dummies()).fit(_labelled(spark, sf).select(*BASELINE_COLUMNS))
    rows = fitted.transform(scoring_tickets(spark, sf).select(*BASELINE_COLUMNS))
    return rows.select("ticket_id", F.posexplode(vector_to_array("dummies")).alias("dummy", "v")).filter("v = 1").select("ticket_id", "dummy")


@query("one_hot_baseline")
def q_one_hot_baseline(spark, sf):
    """The one-hot baseline from raw tickets to scores as one pipeline: calendar parts, sparse dummies, forest."""
    train = materialize(models.with_label(_labelled(spark, sf)).select("label", *BASELINE_COLUMNS), "baseline_train", wide=True)
    numbers = ["fine_amount", "judgment_amount", *[name for name, _, _ in DAY_PARTS]]
    stages = [*_baseline_dummies(), models.assembler([*numbers, "dummies"]), models.forest(n_trees=FOREST_TREES_GRID, max_depth=10)]
    fitted = Pipeline(stages=stages).fit(train)
    scoring = fitted.transform(scoring_tickets(spark, sf).select(*BASELINE_COLUMNS))
    return models.positive_probability(scoring).select("ticket_id", "score")


ENCODE_VIEW = ["disposition", *VIEW_FOLD_ATTRIBUTES]


@query("label_encode", with_tickets("""
SELECT attribute, value, CAST(dense_rank() OVER (PARTITION BY attribute ORDER BY value) - 1 AS BIGINT) AS code
FROM (""" + "\nUNION\n".join(
    f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM t WHERE {a} IS NOT NULL "
    f"UNION SELECT '{a}', 'NaN'" for a in ENCODE_VIEW) + ")", NW_CTE))
def q_label_encode(spark, sf):
    t = _not_waived(_labelled(spark, sf))
    return encode.fit_label_codes(t, ENCODE_VIEW, always_include=["NaN"])


def _apply_codes_sql(attrs):
    joins, cols = [], []
    for i, a in enumerate(attrs):
        joins.append(f"LEFT JOIN (SELECT value, code FROM codes WHERE attribute = '{a}') c{i} "
                     f"ON CAST(s.{a} AS VARCHAR) = c{i}.value")
        cols.append(f"c{i}.code AS {a}")
    return f"SELECT s.ticket_id, {', '.join(cols)} FROM s\n" + "\n".join(joins)


@query("label_encode_apply", with_tickets(_apply_codes_sql(ENCODE_VIEW), NW_CTE + """,
codes AS (SELECT attribute, value, CAST(dense_rank() OVER (PARTITION BY attribute ORDER BY value) - 1 AS BIGINT) AS code
FROM (""" + "\nUNION\n".join(
    f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM t WHERE {a} IS NOT NULL "
    f"UNION SELECT '{a}', 'NaN'" for a in ENCODE_VIEW) + "))"))
def q_label_encode_apply(spark, sf):
    t = _not_waived(_labelled(spark, sf))
    s = _not_waived(scoring_tickets(spark, sf))
    codes = encode.fit_label_codes(t, ENCODE_VIEW, always_include=["NaN"])
    return encode.apply_label_codes(s, codes, ENCODE_VIEW, handle_unseen="null", key="ticket_id").select(
        "ticket_id", *ENCODE_VIEW)


# ===================================================================== segments and splits
@query("segment_split", with_tickets(f"""
SELECT ticket_id, CASE WHEN coalesce(contains(disposition, {_q(WAIVED_DISPOSITION)}), false) THEN 'waived'
                       WHEN hearing_date IS NULL THEN 'undated' ELSE 'dated' END AS segment
FROM scoring_tickets"""))
def q_segment_split(spark, sf):
    return segment.with_segment(scoring_tickets(spark, sf), [WAIVED_DISPOSITION]).select(
        "ticket_id", "segment")


@query("holdout_split", with_tickets(
    f"SELECT ticket_id, {unit_hash_sql('ticket_id', 0)} < 0.25 AS holdout FROM lt", LABELLED_CTE))
def q_holdout_split(spark, sf):
    return _labelled(spark, sf).select("ticket_id", segment.holdout_flag().alias("holdout"))


@query("fold_assign", with_tickets(
    f"SELECT ticket_id, CAST(least(floor({unit_hash_sql('ticket_id', 1)} * 5.0), 4) AS INTEGER) AS fold FROM lt",
    LABELLED_CTE))
def q_fold_assign(spark, sf):
    return _labelled(spark, sf).select("ticket_id", segment.fold_of().alias("fold"))


@query("fold_stratified", with_tickets("""
SELECT ticket_id, compliance, CAST((row_number() OVER (PARTITION BY compliance
  ORDER BY md5('1:' || CAST(ticket_id AS VARCHAR)), CAST(ticket_id AS VARCHAR)) - 1) % 5 AS INTEGER) AS fold FROM lt""", LABELLED_CTE))
def q_fold_stratified(spark, sf):
    labelled = _labelled(spark, sf).select("ticket_id", "compliance")
    return segment.stratified_folds(labelled, "compliance")


@query("roc_auc", with_tickets(metrics.roc_auc_sql("lt", "judgment_amount", "compliance"),
                               LABELLED_CTE))
def q_roc_auc(spark, sf):
    return metrics.roc_auc(_labelled(spark, sf), "judgment_amount", "compliance")


# ===================================================================== routing with fixed formulas
S1_SQL = "judgment_amount / (judgment_amount + 100000.0)"
S2_SQL = "late_fee / (late_fee + 20000.0)"


@query("score_union", with_tickets(f"""
SELECT ticket_id, 'waived' AS part, CAST(1.0 AS DOUBLE) AS compliance FROM scoring_tickets
  WHERE coalesce(contains(disposition, {_q(WAIVED_DISPOSITION)}), false)
UNION ALL
SELECT ticket_id, 'dated', {S1_SQL} FROM scoring_tickets
  WHERE NOT coalesce(contains(disposition, {_q(WAIVED_DISPOSITION)}), false) AND hearing_date IS NOT NULL
UNION ALL
SELECT ticket_id, 'undated', {S2_SQL} FROM scoring_tickets
  WHERE NOT coalesce(contains(disposition, {_q(WAIVED_DISPOSITION)}), false) AND hearing_date IS NULL"""))
def q_score_union(spark, sf):
    s = segment.with_segment(scoring_tickets(spark, sf), [WAIVED_DISPOSITION])
    s1 = F.col("judgment_amount") / (F.col("judgment_amount") + F.lit(100000.0))
    s2 = F.col("late_fee") / (F.col("late_fee") + F.lit(20000.0))
    return (s.filter(F.col("segment") == "waived").select("ticket_id", F.lit("waived").alias("part"),
                                                         F.lit(1.0).alias("compliance"))
            .unionByName(s.filter(F.col("segment") == "dated").select(
                "ticket_id", F.lit("dated").alias("part"), s1.alias("compliance")))
            .unionByName(s.filter(F.col("segment") == "undated").select(
                "ticket_id", F.lit("undated").alias("part"), s2.alias("compliance"))))


@query("ensemble_mean", with_tickets(
    f"SELECT ticket_id, (({S1_SQL}) + ({S2_SQL})) / 2.0 AS compliance FROM scoring_tickets"))
def q_ensemble_mean(spark, sf):
    s = scoring_tickets(spark, sf).select(
        "ticket_id",
        (F.col("judgment_amount") / (F.col("judgment_amount") + F.lit(100000.0))).alias("s1"),
        (F.col("late_fee") / (F.col("late_fee") + F.lit(20000.0))).alias("s2"))
    return clean.mean_of_columns(s, "compliance", ["s1", "s2"]).select("ticket_id", "compliance")


def _view_spec() -> RouteSpec:
    enc = ENCODE_VIEW
    return RouteSpec(
        fold_attributes=VIEW_FOLD_ATTRIBUTES, encoded_attributes=enc,
        dated_features=[*enc, "late_fee", "discount_amount", "judgment_amount", "time_to_hearing"],
        undated_features=[*enc, "fine_amount", "late_fee", "discount_amount", "judgment_amount"],
        train_waived=[WAIVED_DISPOSITION], scoring_waived=[WAIVED_DISPOSITION],
        collapse_rules=[], city_rules=True)


# A fixed formula in place of the models, over every encoded column: wrong folding, fitting, codes or seconds show.
MIX = [2, 3, 5, 7, 11, 13, 17]  # a factor for each encoded column
MIX_MOD = 1009


def _fixed_scorer(t_seg, s_seg, feats, seg):
    mixed = sum((F.col(a) * m for a, m in zip(ENCODE_VIEW[1:], MIX[1:])), F.col(ENCODE_VIEW[0]) * MIX[0])
    by_code = F.pmod(mixed, F.lit(MIX_MOD)).cast("double") / F.lit(float(MIX_MOD))
    time = F.col("time_to_hearing").cast("double")
    s2 = time / (F.abs(time) + F.lit(1000000.0)) if seg == "dated" else F.col("judgment_amount") / (
        F.col("judgment_amount") + F.lit(100000.0))
    return s_seg.select("ticket_id", ((by_code + s2) / F.lit(2.0)).alias("compliance"))


def _routed_sql() -> str:
    city = {side: _city_sql(c, r, a) for side, c, r, a in (
        ("t", "city", TRAIN_CITY_REPLACEMENTS, TRAIN_CITY_ALIASES),
        ("s", "coalesce(city, 'DETROIT')", SCORING_CITY_REPLACEMENTS, SCORING_CITY_ALIASES))}
    plain = [a for a in ENCODE_VIEW if a not in ("city", "zip_code")]
    ctes = [f"p{x} AS (SELECT ticket_id, hearing_date, judgment_amount, {TTH_SQL} AS tth, {city[x]} AS city, "
            f"coalesce(zip_code, 'NaN') AS zip_code, {', '.join(plain)} FROM {x})" for x in "ts"]
    for x, y in ("ts", "st"):
        folded = ", ".join(f"CASE WHEN {a} IN (SELECT {a} FROM p{y} WHERE {a} IS NOT NULL) THEN {a} ELSE 'NaN' END AS {a}"
                           for a in VIEW_FOLD_ATTRIBUTES)
        ctes.append(f"f{x} AS (SELECT ticket_id, hearing_date, judgment_amount, tth, disposition, {folded} FROM p{x})")
    values = " UNION ".join(f"SELECT '{a}' AS attribute, {a} AS value FROM ft UNION SELECT '{a}', 'NaN'" for a in ENCODE_VIEW)
    ctes.append(f"codes AS (SELECT attribute, value, dense_rank() OVER (PARTITION BY attribute ORDER BY value) - 1 AS code FROM ({values}))")
    joins = " ".join(f"JOIN codes c{i} ON c{i}.attribute = '{a}' AND c{i}.value = fs.{a}" for i, a in enumerate(ENCODE_VIEW))
    mixed = " + ".join(f"{m} * c{i}.code" for i, m in enumerate(MIX[:len(ENCODE_VIEW)]))
    ctes.append(f"m AS (SELECT fs.ticket_id, hearing_date, judgment_amount, CAST(tth AS DOUBLE) AS tth, "
                f"CAST(({mixed}) % {MIX_MOD} AS DOUBLE) / {MIX_MOD}.0 AS by_code FROM fs {joins})")
    return with_tickets(f"""
SELECT ticket_id, CAST(1.0 AS DOUBLE) AS compliance FROM scoring_tickets WHERE NOT ({NOT_WAIVED_SQL})
UNION ALL
SELECT ticket_id, (by_code + CASE WHEN hearing_date IS NOT NULL THEN tth / (abs(tth) + 1000000.0) ELSE {S1_SQL} END) / 2.0 FROM m""",
                        NW_CTE + ",\n" + ",\n".join(ctes))


@query("routed_score", _routed_sql())
def q_routed_score(spark, sf):
    tr, sc = both_periods(spark, sf)
    return routed_scores(tr, sc, _view_spec(), scorer=_fixed_scorer, inputs_materialized=True)


# ===================================================================== models (rows-only checks)
def model_frames(spark, sf):
    """Encoded training / scoring rows of the not-waived segment."""
    spec = _view_spec()
    tr, sc = both_periods(spark, sf)
    train = prepare_train(tr, spec)
    scoring = prepare_scoring(sc, spec)
    return encoded_segments(train, scoring, spec, materialize_inputs=False) + (spec,)


def _dated(spark, sf):
    t, s, spec = model_frames(spark, sf)
    t = t.filter(F.col("hearing_date").isNotNull())
    s = s.filter(F.col("hearing_date").isNotNull())
    return t, s, list(spec.dated_features)


def _fit_and_holdout(spark, sf, make, even=False):
    """``make(rows, bins)``: the estimator for so many rows, with a split point for each label code.  ``even``: its
    rows are dealt evenly over the cores."""
    t, _, feats = _dated(spark, sf)
    fit_part, hold = segment.holdout_split(t)
    if even:
        fit_part = in_one_wave(fit_part.select(models.LABEL, *dict.fromkeys(feats)), "fit_rows")
    model = models.fit(make(fit_part.count(), models.bins_for(fit_part, feats)), fit_part, feats)
    return models.score(model, hold).select("ticket_id", "score")


AMOUNTS_VIEW = ["fine_amount", "late_fee", "discount_amount", "judgment_amount"]
RAW_ATTRIBUTES = ["agency_name", "violator_name", "state", *ENCODE_VIEW]


@query("feature_importance")
def q_feature_importance(spark, sf):
    """Importances in forests of 100 fully grown trees, for the dated and the undated tickets, before cleaning (all
    labelled tickets, codes of the values as they are) and after it."""
    t, _, spec = model_frames(spark, sf)
    raw = filters.with_time_to_hearing(models.with_label(clean.fill_sentinel(_labelled(spark, sf), RAW_ATTRIBUTES)))
    raw = materialize(raw, "raw_tickets", wide=True)
    raw = encode.apply_label_codes(raw, encode.fit_label_codes(raw, RAW_ATTRIBUTES), RAW_ATTRIBUTES, key="ticket_id")
    dated = F.col("hearing_date").isNotNull()
    rows = []
    for name, df, features in (
            ("dated, before cleaning", raw.filter(dated), [*RAW_ATTRIBUTES, *AMOUNTS_VIEW, "time_to_hearing"]),
            ("undated, before cleaning", raw.filter(~dated), [*RAW_ATTRIBUTES, *AMOUNTS_VIEW]),
            ("dated, after cleaning", t.filter(dated), spec.dated_features),
            ("undated, after cleaning", t.filter(~dated), spec.undated_features)):
        rows += [(name, f, v) for f, v in deep_forest.fit_forest(df, list(features), FOREST_TREES_IMPORTANCE).importance()]
    return spark.createDataFrame(rows, "slice string, feature string, importance double").orderBy("slice", F.desc("importance"), "feature")


@query("rf_unlimited")
def q_rf_unlimited(spark, sf):
    """Hold-out scores of 50 fully grown trees."""
    t, _, feats = _dated(spark, sf)
    fit_part, hold = segment.holdout_split(t)
    return deep_forest.score(hold, deep_forest.fit_forest(fit_part, feats, FOREST_TREES_GRID)).select("ticket_id", "score")


@query("rf_model")
def q_rf_model(spark, sf):
    return _fit_and_holdout(spark, sf, lambda n, bins: models.forest(n_trees=50, max_depth=10, max_bins=bins))


@query("gbt_model")
def q_gbt_model(spark, sf):
    return _fit_and_holdout(spark, sf, lambda n, bins: models.boosted_trees(max_bins=bins), even=True)


@query("logreg_model")
def q_logreg_model(spark, sf):
    return _fit_and_holdout(spark, sf, lambda n, _: models.logistic(n_rows=n))


@query("linear_svc")
def q_linear_svc(spark, sf):
    return _fit_and_holdout(spark, sf, lambda n, _: models.linear_svc(1.0, n))


@query("rff_svc")
def q_rff_svc(spark, sf):
    t, _, feats = _dated(spark, sf)
    fit_part, hold = segment.holdout_split(t)
    scaler, svc = models.fit_rff_svc(fit_part, feats, c=1.0, gamma=0.1, n_components=64)
    return models.score_rff_svc(scaler, svc, hold, feats, gamma=0.1, n_components=64).select(
        "ticket_id", "score")


@query("gbt_grid")
def q_gbt_grid(spark, sf):
    t, _, feats = _dated(spark, sf)
    est = models.boosted_trees(n_trees=20)
    return models.grid_search(est, {"maxDepth": [3, 5], "minInstancesPerNode": [50, 85]}, t, feats, exact=True)


@query("grid_search")
def q_grid_search(spark, sf):
    t, _, feats = _dated(spark, sf)
    est = models.forest(n_trees=50)
    return models.grid_search(est, {"maxDepth": [5, 10, 15, 20, 30]}, t, feats)


@query("cv_scores")
def q_cv_scores(spark, sf):
    t, _, feats = _dated(spark, sf)
    return models.cv_scores(lambda n: models.logistic(n_rows=n), t, feats, stratified=True)


@query("gbt_staged")
def q_gbt_staged(spark, sf):
    """Held-out AUC after each of the analysis's tree counts, one boosted ensemble a fold: each fold's fit takes the
    time of its largest count."""
    t, _, feats = _dated(spark, sf)
    return models.staged_cv(models.boosted_trees(), t, feats, GBT_TREE_GRID, exact=True)


# ===================================================================== many logistic fits at once
GRADIENT_FEATURES = ["judgment_amount", "fine_amount", "discount_amount"]
# Intercept and weights of two fixed models, the second blind to tickets of the first fold.
GRADIENT_AT = [[0.25, -0.5], [0.000002, -0.000001], [0.00003, 0.0001], [-0.00002, 0.0]]


def _gradient_sql() -> str:
    rows = []
    for j, held in enumerate((None, 0)):
        margin = f"({GRADIENT_AT[0][j]}" + "".join(
            f" + {GRADIENT_AT[i + 1][j]} * {f}" for i, f in enumerate(GRADIENT_FEATURES)) + ")"
        seen = "TRUE" if held is None else f"fold <> {held}"
        off = f"(1.0 / (1.0 + exp(-{margin})) - compliance)"
        rows.append(f"SELECT {j} AS fit, 'loss' AS term, round(sum(ln(1.0 + exp({margin})) - compliance * {margin}), 4) AS value "
                    f"FROM g WHERE {seen}")
        for name, x in [("intercept", "1.0"), *[(f, f) for f in GRADIENT_FEATURES]]:
            rows.append(f"SELECT {j}, '{name}', round(sum({x} * {off}) / 100000.0, 4) FROM g WHERE {seen}")
    return "\nUNION ALL\n".join(rows)


@query("logistic_gradient", with_tickets(_gradient_sql(), LABELLED_CTE + """,
g AS (SELECT *, (row_number() OVER (PARTITION BY compliance
  ORDER BY md5('1:' || CAST(ticket_id AS VARCHAR)), CAST(ticket_id AS VARCHAR)) - 1) % 5 AS fold FROM lt)"""))
def q_logistic_gradient(spark, sf):
    """Loss and gradient (in 100,000s) of two logistic models in one pass: the step that fits a whole grid."""
    labelled = _labelled(spark, sf).select("ticket_id", "compliance", *GRADIENT_FEATURES)
    data = logistic_path.rows_for(segment.stratified_folds(labelled, "compliance"), GRADIENT_FEATURES, "compliance", "fold")
    loss, gradient = logistic_path.loss_and_gradient(data, np.array(GRADIENT_AT), [None, 0])
    rows = [(j, "loss", round(float(loss[j]), 4)) for j in range(2)]
    rows += [(j, name, round(float(gradient[i, j]) / 100000.0, 4))
             for j in range(2) for i, name in enumerate(["intercept", *GRADIENT_FEATURES])]
    return spark.createDataFrame(rows, "fit int, term string, value double")


@query("logistic_grid")
def q_logistic_grid(spark, sf):
    """Hold-out AUC of every inverse strength, penalty and fold, for the dated and the undated tickets; each
    segment's fits share their passes."""
    t, _, spec = model_frames(spark, sf)
    parts = [logistic_path.grid_scores(t.filter(hearing), list(features), strengths).select(F.lit(name).alias("segment"), "*")
             for name, hearing, features, strengths in (
                 ("dated", F.col("hearing_date").isNotNull(), spec.dated_features, LOGREG_C_GRID),
                 ("undated", F.col("hearing_date").isNull(), spec.undated_features, LOGREG_C_GRID_UNDATED))]
    return parts[0].unionByName(parts[1])


# ===================================================================== second-order boosting
HISTOGRAM_EDGES = {"judgment_amount": [50000.0, 100000.0, 150000.0, 200000.0, 300000.0], "fine_amount": [0.0, 2500.0, 5000.0, 7500.0],
                   "discount_amount": [0.0, 500.0]}


def _boosting_histogram_sql() -> str:
    parts = []
    for f, edges in HISTOGRAM_EDGES.items():
        place = " + ".join(f"CASE WHEN {f} > {e} THEN 1 ELSE 0 END" for e in edges)
        parts.append(f"SELECT '{f}' AS feature, CAST({place} AS INTEGER) AS bin, CAST(sum(floor((p - compliance) * 16777216.0 + 0.5)) AS BIGINT) AS g, "
                     f"CAST(sum(floor(p * (1.0 - p) * 16777216.0 + 0.5)) AS BIGINT) AS h FROM q GROUP BY 2")
    return "\nUNION ALL\n".join(parts)


@query("boosting_histogram", with_tickets(_boosting_histogram_sql(), LABELLED_CTE + """,
q AS (SELECT *, (SELECT avg(compliance) FROM lt) AS p FROM lt)"""))
def q_boosting_histogram(spark, sf):
    """Gradient and hessian sums of the first node of a boosted tree, by feature and bin: the step that grows trees."""
    names = list(HISTOGRAM_EDGES)
    data = boosting.rows_for(_labelled(spark, sf).select("ticket_id", "compliance", *names), names,
                             [np.array(e) for e in HISTOGRAM_EDGES.values()], "compliance")
    base = data.agg(F.avg("y")).first()[0]
    fit = boosting.Fit(boosting.Params(subsample=1.0))
    model = boosting.Ensemble(names, [np.array(e) for e in HISTOGRAM_EDGES.values()], fit, float(np.log(base / (1.0 - base))))
    sums = boosting.histograms(data, [model], [boosting.Tree(1)], 0, 0, [range(len(names))])
    return sums.select(F.element_at(F.array(*map(F.lit, names)), F.col("feature") + 1).alias("feature"), "bin", "g", "h")


@query("second_order_boosting")
def q_second_order_boosting(spark, sf):
    """Hold-out scores of regularised second-order boosting."""
    t, _, feats = _dated(spark, sf)
    fit_part, hold = segment.holdout_split(t)
    edges = boosting.bin_edges(fit_part, feats)
    params = boosting.Params(trees=10, max_depth=5, gamma=0.2, colsample=0.7, reg_alpha=0.1)
    (model,) = boosting.fit_many(boosting.rows_for(fit_part, feats, edges), feats, edges, [boosting.Fit(params)])
    return boosting.score(hold, model).select("ticket_id", "score")


@query("second_order_grid")
def q_second_order_grid(spark, sf):
    """Held-out AUC of one change at a time of the regularised boosting's parameters, all fits grown side by side."""
    t, _, feats = _dated(spark, sf)
    return boosting.grid_scores(t, feats, BOOSTING_GRID, boosting.Params(trees=4, max_depth=4))


@query("score_tickets")
def q_score_tickets(spark, sf):
    t, s, feats = _dated(spark, sf)
    model = models.fit(models.logistic(n_rows=t.count()), t, feats)
    return models.score(model, s).select("ticket_id", "score")


@query("final_scores")
def q_final_scores(spark, sf):
    tr, sc = both_periods(spark, sf)
    return routed_scores(tr, sc, _view_spec(), inputs_materialized=True)


@query("document_quality")
def q_document_quality(spark, sf):
    """The same modelling path on documents + labels.quality (FIXTURES: the
    classifier role with real signal): text flags on whole texts, label
    codes for language and source, key split, L1 logistic, exact hold-out
    AUC.  One row: auc, n_pos, n_neg."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = read_table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    df = docs.join(labels, "doc_id", "inner").select(
        F.col("doc_id").alias("ticket_id"), "label", "lang", "source",
        F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
        TX.person_flag("text").alias("people"),
        TX.po_box_flag("text").alias("address_BOX"),
        TX.mile_flag("text").alias("address_MILE"),
        (F.size(F.split(F.col("text"), "\n")) - F.size(F.array_distinct(F.split(F.col("text"), "\n"))))
        .alias("repeated_lines"))
    codes = encode.fit_label_codes(df, ["lang", "source"])
    data = encode.apply_label_codes(df, codes, ["lang", "source"])
    feats = ["lang", "source", "log_chars", "people", "address_BOX", "address_MILE", "repeated_lines"]
    fit_part, hold = segment.holdout_split(data)
    model = models.fit(models.logistic(c=1.0, n_rows=fit_part.count(), standardize=True),
                       fit_part, feats)
    return metrics.roc_auc(models.score(model, hold), "score", "label")
