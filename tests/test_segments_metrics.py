import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlens.constants import SCORING_WAIVED_PATTERNS
from ledgerlens.operators import segment
from ledgerlens.plans import metrics
from ledgerlens.plans.joins import hot_keys, lookup_join


def test_segments_disjoint_and_cover(spark, scoring_df):
    seg = segment.with_segment(scoring_df, SCORING_WAIVED_PATTERNS)
    got = {r["ticket_id"]: r["segment"] for r in seg.collect()}
    assert got == {101: "dated", 102: "waived", 103: "waived", 104: "undated", 105: "dated",
                   106: "dated"}


def test_holdout_and_folds(spark):
    df = spark.range(20000).withColumnRenamed("id", "ticket_id")
    share = df.select(F.avg(segment.holdout_flag().cast("double"))).first()[0]
    assert 0.23 < share < 0.27
    folds = df.select(segment.fold_of().alias("f")).groupBy("f").count().collect()
    assert sorted(r["f"] for r in folds) == [0, 1, 2, 3, 4]
    assert all(3600 < r["count"] < 4400 for r in folds)
    fit_part, hold = segment.holdout_split(df)
    assert fit_part.count() + hold.count() == 20000
    # same split when recomputed
    assert hold.select(F.sum("ticket_id")).first()[0] == hold.select(F.sum("ticket_id")).first()[0]


def _brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return u / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 30)), rnd.randint(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = metrics.roc_auc(df).first()
    want = _brute_auc(*zip(*rows))
    assert math.isclose(got["auc"], want, rel_tol=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert math.isclose(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))), want,
                        rel_tol=1e-9)
    assert (got["n_pos"], got["n_neg"]) == (sum(y for _, y in rows), sum(1 - y for _, y in rows))


def test_lookup_join_salted_path_equals_broadcast(spark):
    big = spark.createDataFrame([(i, "HOT" if i % 3 else f"k{i % 7}") for i in range(3000)],
                                "id int, key string")
    small = spark.createDataFrame([("HOT", 1), ("k0", 2), ("k3", 3)], "key string, code int")
    a = lookup_join(big, small, "key", "left").orderBy("id").collect()
    b = lookup_join(big, small, "key", "left", max_broadcast_bytes=0).orderBy("id").collect()
    assert a == b and len(a) == 3000
    # the key holding two thirds of the rows is the (only) hot key
    assert hot_keys(big, ["key"], partitions=8) == [("HOT",)]
    # composite keys take the same path
    big2 = big.withColumn("k2", F.lit(1))
    small2 = small.withColumn("k2", F.lit(1))
    c = lookup_join(big2, small2, ["key", "k2"], "inner", max_broadcast_bytes=0).count()
    assert c == sum(1 for r in a if r["code"] is not None)
