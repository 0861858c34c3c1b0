"""Operators that no query needs: complements of those that do."""

from ledgerlens.operators import encode, filters


def test_selection_and_threshold_complements(spark):
    df = spark.createDataFrame([(1, "a", 10.0), (2, "b", 5000.0), (3, None, 5000.5), (4, "a", None)], "id int, c string, judgment_amount double")
    assert filters.select_all_but(df, ["c"]).columns == ["id", "judgment_amount"]
    assert [r["id"] for r in filters.amount_above(df, 5000.0).collect()] == [3]
    assert [r["id"] for r in filters.amount_at_most(df, 5000.0).collect()] == [1, 2]
    wanted = spark.createDataFrame([("a",), ("a",), ("z",)], "v string")
    assert sorted(r["id"] for r in filters.isin_filter(df, "c", wanted, "v").collect()) == [1, 4]
    assert sorted(r["id"] for r in filters.isin_filter(df, "c", wanted, "v", keep=False).collect()) == [2, 3]


def test_codes_and_sparse_pairs(spark):
    df = spark.createDataFrame([(1, "y", "q"), (2, "x", None), (3, None, None)], "id int, c string, d string")
    encoded, codes = encode.label_encode(df, ["c", "d"])
    assert {(r["attribute"], r["value"]): r["code"] for r in codes.collect()} == {
        ("c", "NaN"): 0, ("c", "x"): 1, ("c", "y"): 2, ("d", "NaN"): 0, ("d", "q"): 1}
    assert sorted((r["id"], r["c"], r["d"]) for r in encoded.collect() if r["id"] < 3) == [(1, 2, 1), (2, 1, None)]
    pairs = {r["id"]: [tuple(p) for p in r["dummies"]] for r in encode.one_hot_sparse(df, ["c", "d"]).collect()}
    assert pairs == {1: [("c", 1), ("d", 0)], 2: [("c", 0)], 3: []}
