"""Sparse dummies as pipeline stages: alignment, merging, saving, the shuffled lookup."""

from datetime import datetime

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array

from ledgerlens.plans import dummies, joins

TRAIN = [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, None, "x")]
SCORING = [(11, "b", "q"), (12, "z", "y"), (13, None, None), (14, "c", "x"), (15, "a", "x")]


def _pairs(model, df):
    names = {r["index"]: f"{r['attribute']}={r['value']}" for r in model.stages[-1].dummies().collect()}
    rows = model.transform(df).select("id", "v", vector_to_array("v").alias("a")).collect()
    return {r["id"]: [names[i] for i, x in enumerate(r["a"]) if x] for r in rows}, names


def test_scoring_rows_get_the_training_dummies(spark, tmp_path, monkeypatch):
    train, scoring = (spark.createDataFrame(r, "id int, c string, d string") for r in (TRAIN, SCORING))
    for key in ("id", ""):
        stage = dummies.SparseDummies(["c", "d"], "v", {"c": {"a": "a or b", "b": "a or b"}}, key)
        model = Pipeline(stages=[stage]).fit(train)
        got, names = _pairs(model, scoring)
        assert sorted(names.values()) == ["c=a or b", "c=c", "d=x", "d=y"]
        want = {11: ["c=a or b"], 12: ["d=y"], 13: [], 14: ["c=c", "d=x"], 15: ["c=a or b", "d=x"]}
        assert got == want
        path = f"{tmp_path}/model{key}"
        model.write().overwrite().save(path)
        again = PipelineModel.load(path)
        assert again.stages[0].uid == model.stages[0].uid and _pairs(again, scoring)[0] == want
        with monkeypatch.context() as m:
            m.setattr(joins, "MAX_BROADCAST_BYTES", -1)
            assert _pairs(again, scoring)[0] == want
        Pipeline(stages=[stage]).write().overwrite().save(f"{path}-unfitted")
        assert Pipeline.load(f"{path}-unfitted").getStages()[0].getInputCols() == ["c", "d"]
    assert model.transform(scoring).columns == ["id", "c", "d", "v"]


def test_many_values_give_sparse_vectors(spark):
    df = spark.range(300).selectExpr("cast(id as int) id", "cast(id as string) c")
    (row,) = Pipeline(stages=[dummies.SparseDummies(["c"], "v", keyCol="id")]).fit(df).transform(df.filter("id = 7")).collect()
    assert type(row["v"]).__name__ == "SparseVector" and row["v"].size == 300 and row["v"].values.tolist() == [1.0]


def test_columns_without_values(spark):
    train = spark.createDataFrame([(1, "a", None), (2, None, None)], "id int, c string, d string")
    model = Pipeline(stages=[dummies.SparseDummies(["c", "d"], "v")]).fit(train)
    assert _pairs(model, train)[0] == {1: ["c=a"], 2: []}
    assert model.transform(train.filter("id > 9")).count() == 0
    with pytest.raises(ValueError, match="no value"):
        dummies.SparseDummies(["d"], "v").fit(train).transform(train)


def test_calendar_stage(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2005, 3, 21, 10, 30)), (2, None)], "id int, ticket_issued_date timestamp_ntz")
    stage = dummies.CalendarFeatures(inputCol="ticket_issued_date")
    stage.write().overwrite().save(f"{tmp_path}/calendar")
    rows = {r["id"]: r.asDict() for r in dummies.CalendarFeatures.load(f"{tmp_path}/calendar").transform(df).collect()}
    assert rows[1]["month"] == "3" and rows[1]["weekday"] == "0" and rows[1]["ticket_issued_morning"] == 1 and rows[1]["ticket_issued_night"] == 0
    assert rows[2]["month"] is None and rows[2]["ticket_issued_morning"] == 0
