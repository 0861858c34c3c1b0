"""What large tables need: lookups past the broadcast bound, rows dealt over the cores, narrow caches."""

from pyspark.ml.tuning import CrossValidator

from ledgerlens.plans import joins, models
from ledgerlens.plans.joins import lookup_attributes
from ledgerlens.session import in_one_wave


def test_only_large_slices_leave_the_broadcast(spark, monkeypatch):
    """One attribute with many values doesn't send the rows' other attributes through the shuffle join."""
    rows = [(i, f"house {i % 50}" if i % 7 else None, "ab"[i % 2], None if i % 3 else "x") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, house string, side string, mark string")
    values = [("house", f"house {i}", i) for i in range(40)] + [("side", "a", 0), ("side", "b", 1), ("mark", "x", 5)]
    table = spark.createDataFrame(values, "attribute string, value string, code long")
    shuffled = []
    whole = joins.salted_join
    monkeypatch.setattr(joins, "salted_join", lambda big, *a: shuffled.extend(
        r[0] for r in big.select("attribute").distinct().collect()) or whole(big, *a))
    names = ["house", "side", "mark"]
    plain = lookup_attributes(df, table, names, "code", key="id")
    assert not shuffled
    for key, hot in (("id", None), (None, None), ("id", lambda: [("house", "house 1", 4), ("side", "a", 100)])):
        shuffled.clear()
        mixed = lookup_attributes(df, table, names, "code", key=key, hot=hot, max_broadcast_bytes=200)
        assert mixed.columns == plain.columns and mixed.dtypes == plain.dtypes
        assert sorted(map(str, mixed.collect())) == sorted(map(str, plain.collect()))
        assert shuffled == ["house"]


def test_slices_fill_the_bound_together(spark):
    table = spark.createDataFrame([("a", "x", 1), ("b", "x", 1), ("c", "xyz", 1)], "attribute string, value string, code long")
    assert joins._past_limit(table, ["c", "b", "a", "none"], 10_000) == []
    assert joins._past_limit(table, ["c", "b", "a", "none"], 50) == ["c"]  # 18, 18 and 20 bytes
    assert joins._past_limit(table, ["c", "b", "a", "none"], 30) == ["c", "a"]
    assert joins._past_limit(table, ["c", "b", "a", "none"], -1) == ["c", "b", "a", "none"]


def test_rows_are_dealt_into_one_wave(spark):
    cores = spark.sparkContext.defaultParallelism
    for parts, wanted in ((1, 1), (cores, cores), (cores + 1, cores), (4 * cores - 1, cores), (4 * cores, 4 * cores)):
        df = in_one_wave(spark.range(0, 1000, 1, parts))
        assert df.rdd.getNumPartitions() == wanted and df.count() == 1000
        assert max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= -(-1000 // wanted) + cores


def test_grid_folds_hold_the_model_columns_only(spark, monkeypatch):
    """The validator caches both parts of each fold: texts of the table are not among them."""
    seen = []
    monkeypatch.setattr(CrossValidator, "fit", lambda self, data, whole=CrossValidator.fit: seen.append(data.columns) or whole(self, data))
    df = spark.createDataFrame([(i, "long text" * 9, float(i % 5), float(i % 2)) for i in range(200)],
                               "ticket_id long, text string, x double, label double")
    out = models.grid_search(models.boosted_trees(n_trees=2, min_samples_leaf=1), {"maxDepth": [1, 2]}, df, ["x"], folds=2)
    assert out.count() == 2
    assert seen == [[models.FEATURES, models.LABEL, "_fold"]]
