"""Plan shape checks: the properties that matter at scale."""

from pyspark.sql import functions as F

from ledgerlens.operators import vocab
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.joins import lookup_join
from ledgerlens.sources.ticket_view import scoring_tickets, train_tickets

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_pushes_and_hash_aggregates(spark):
    plan = _plan(QUERIES["rate_by_attribute"](spark, SF001))
    # period filter reaches the orders scan; lineitem is read as 3 columns
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in plan
    assert "struct<l_orderkey:bigint,l_returnflag:string,l_linestatus:string>" in plan
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    # many attributes in one pass: one Expand feeding one aggregation
    assert plan.count("Expand") == 1


def test_scan_project_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["scan_project"](spark, SF001))
    orders_schema = [p for p in plan.split("ReadSchema: ") if p.startswith("struct<o_orderkey")]
    assert orders_schema and "o_totalprice" in orders_schema[0]
    assert "l_shipdate" not in plan  # the hearing date is not asked for, so not read


def test_vocabulary_lookup_is_broadcast_when_small(spark):
    t = train_tickets(spark, SF001)
    s = scoring_tickets(spark, SF001)
    common = vocab.shared(vocab.vocabulary(t, s, ["city"]))
    folded = vocab.fold_to_shared(t, common.checkpoint(), ["city"])
    assert "BroadcastHashJoin" in _plan(folded)


def test_large_lookup_is_salted_not_broadcast(spark):
    big = spark.range(1000).select(F.lit("HOT").alias("k"), F.col("id"))
    small = spark.createDataFrame([("HOT", 1)], "k string, v int")
    plan = _plan(lookup_join(big, small, "k", "left", max_broadcast_bytes=0))
    # only the table of hot keys, bounded by the tasks, is broadcast
    assert "SortMergeJoin" in plan and "_salt" in plan and plan.count("BroadcastHashJoin") <= 2
    assert all("v#" not in line for line in plan.split("BroadcastExchange")[1:] for line in line.splitlines()[:1])


def test_cleaning_is_one_codegen_stage_without_python(spark):
    from ledgerlens.plans.routing import RouteSpec, prepare_scoring
    plan = _plan(prepare_scoring(scoring_tickets(spark, SF001), RouteSpec()))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_salted_join_spreads_null_and_hot_keys(spark):
    """With 90 % null keys and one hot key no partition of the join gets over twice the mean."""
    from ledgerlens.plans.joins import lookup_join
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(40_000).select("id", F.when(F.col("id") % 10 == 0, F.when(F.col("id") % 30 == 0, "HOT").otherwise(
            F.concat(F.lit("k"), F.col("id").cast("string")))).alias("k"))
        small = big.filter("k is not null").select("k").distinct().withColumn("v", F.lit(1))
        out = lookup_join(big, small, "k", "left", max_broadcast_bytes=0)
        assert out.count() == 40_000 and out.filter("v = 1").count() == 4_000
        sizes = [r["count"] for r in out.filter("k is not null").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_pairs_are_one_expand_and_one_aggregate(spark):
    from ledgerlens.operators import profile
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 0.0), ("b", None, 1.0), (None, "x", None)], "k string, v string, compliance double")
    out = profile.rate_by_sets(df, [["k"], ["v"], ["k", "v"]])
    plan = _plan(out)
    assert plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 1
    rows = {(r["grouping"], r["value"]): (r["rate"], r["n"]) for r in out.collect()}
    assert rows == {("k", "a"): (0.5, 2), ("k", "b"): (1.0, 1), ("v", "x"): (1.0, 1), ("v", "y"): (0.0, 1),
                    ("k * v", "a * x"): (1.0, 1), ("k * v", "a * y"): (0.0, 1)}


def test_bucketed_tickets_meet_addresses_without_a_shuffle(spark):
    from ledgerlens.operators.geo import attach_coordinates
    from ledgerlens.session import bucketed
    tickets = spark.range(500).withColumnRenamed("id", "ticket_id")
    addresses = spark.range(0, 600, 2).select(F.col("id").alias("ticket_id"), (F.col("id") % 7).cast("string").alias("address"))
    latlons = spark.range(5).select(F.col("id").cast("string").alias("address"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach_coordinates(bucketed(tickets, "ticket_id", 4), bucketed(addresses, "ticket_id", 4), latlons)
        assert "Exchange hashpartitioning(ticket_id" not in _plan(out)
        shuffled = attach_coordinates(tickets, addresses, latlons)
        assert "Exchange hashpartitioning(ticket_id" in _plan(shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert sorted(out.collect(), key=repr) == sorted(shuffled.select(out.columns).collect(), key=repr)
    rows = {r["ticket_id"]: r["lat"] for r in out.collect()}
    assert len(rows) == 500 and rows[4] == 1.5 and rows[6] is None and rows[3] is None


def test_routed_score_shows_broken_folding_fitting_and_coding(spark, monkeypatch):
    from ledgerlens.operators import encode, filters
    from ledgerlens.plans import catalog, routing
    run = lambda: sorted(map(tuple, catalog.QUERIES["routed_score"](spark, SF001).collect()))
    right = run()
    fit, apply, seconds = encode.fit_folded_codes, encode.apply_folded_codes, filters.with_time_to_hearing
    broken = {
        "fold": (routing.encode, "fit_folded_codes", lambda voc, fold, enc, s: fit(voc.withColumn("n_right", F.col("n_left")), fold, enc, s)),
        "codes": (routing.encode, "fit_folded_codes", lambda *a: (fit(*a)[0].withColumn("code", F.col("code") + 1), fit(*a)[1])),
        "apply": (routing.encode, "apply_folded_codes", lambda df, c, enc, n, **k: apply(df, c, enc, n, **k).withColumn(enc[0], F.lit(0))),
        "time": (routing.filters, "with_time_to_hearing", lambda df: seconds(df).withColumn("time_to_hearing", F.lit(5)))}
    for what, (module, name, wrong) in broken.items():
        with monkeypatch.context() as m:
            m.setattr(module, name, wrong)
            try:
                assert run() != right, what
            except AssertionError:
                raise
            except Exception:  # noqa: BLE001 - an error is as good as a difference
                pass
