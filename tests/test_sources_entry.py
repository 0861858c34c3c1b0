import pytest
import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.sources import csv_io
from ledgerlens.sources.ticket_view import scoring_tickets, tickets, train_tickets
from ledgerlens.streaming.tickets import clean_ticket_stream, read_ticket_stream

from conftest import SF001, SF01


def test_ticket_view_counts_sf001(spark):
    t = tickets(spark, SF01)
    r = t.agg(F.count("*").alias("n"), F.count("hearing_date").alias("dated"),
              F.sum(F.when(F.col("hearing_date") < F.col("ticket_issued_date"), 1)).alias("neg"),
              F.count("compliance").alias("labelled")).first()
    assert (r["n"], r["dated"], r["neg"], r["labelled"]) == (15000, 12981, 8407, 9912)
    assert train_tickets(spark, SF01).count() == 9020
    assert scoring_tickets(spark, SF01).count() == 5980
    assert "compliance" not in scoring_tickets(spark, SF01).columns


def test_csv_latin1_and_score_sink(spark):
    folder = tempfile.mkdtemp(prefix="ll-csv-")
    path = os.path.join(folder, "train.csv")
    header = ",".join(f.name for f in csv_io.TRAIN_SCHEMA.fields)
    values = {f.name: "" for f in csv_io.TRAIN_SCHEMA.fields}
    values.update(ticket_id="7", violator_name="BÉLANGER CAFÉ", city="MONTRÉAL",
                  ticket_issued_date="2005-03-21 10:30:00", fine_amount="250.0", compliance="1.0")
    line = ",".join(values[f.name] for f in csv_io.TRAIN_SCHEMA.fields)
    with open(path, "wb") as fh:
        fh.write((header + "\n" + line + "\n").encode("latin-1"))
    df = csv_io.read_train(spark, path)
    r = df.first()
    assert r["violator_name"] == "BÉLANGER CAFÉ" and r["city"] == "MONTRÉAL"
    assert r["fine_amount"] == 250.0 and str(r["ticket_issued_date"]) == "2005-03-21 10:30:00"
    out = os.path.join(folder, "scores")
    csv_io.write_scores_csv(df.select("ticket_id", F.lit(0.25).alias("compliance")), out)
    back = spark.read.option("header", "true").schema(csv_io.SCORE_SCHEMA).csv(out).collect()
    assert [(x["ticket_id"], x["compliance"]) for x in back] == [(7, 0.25)]


def test_entry_and_catalog_consistent(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["attribute", "value", "rate", "n"]
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 65


def test_stream_cleaning(spark, scoring_df):
    folder = tempfile.mkdtemp(prefix="ll-stream-")
    scoring_df.write.mode("overwrite").parquet(os.path.join(folder, "in"))
    stream = clean_ticket_stream(read_ticket_stream(spark, os.path.join(folder, "in")))
    q = stream.writeStream.format("memory").queryName("ll_clean_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["ticket_id"]: (r["segment"], r["city"]) for r in spark.sql("SELECT * FROM ll_clean_stream").collect()}
    assert got[102][0] == "waived" and got[104] == ("undated", "DETROIT")
    assert got[105][1] == "DETROIT" and got[106][1] == "NEWYORK"


def test_attach_coordinates_two_hops(spark, scoring_df):
    from ledgerlens.operators.geo import attach_coordinates
    addresses = spark.createDataFrame([(101, "2900 tyler"), (102, "4311 central"), (104, "1 nowhere")],
                                      "ticket_id long, address string")
    latlons = spark.createDataFrame([("2900 tyler", 42.39, -83.12), ("4311 central", 42.32, -83.14)],
                                    "address string, lat double, lon double")
    out = {r["ticket_id"]: (r["address"], r["lat"]) for r in
           attach_coordinates(scoring_df.select("ticket_id"), addresses, latlons).collect()}
    assert out[101] == ("2900 tyler", 42.39) and out[102] == ("4311 central", 42.32)
    assert out[104] == ("1 nowhere", None) and out[103] == (None, None)
    assert len(out) == 6


def test_score_ticket_files_end_to_end(spark, train_df, scoring_df):
    from ledgerlens.plans.routing import RouteSpec, score_ticket_files
    folder = tempfile.mkdtemp(prefix="ll-e2e-")

    def to_csv(df, name, enc):
        pdf = df.toPandas()
        for c in ("ticket_issued_date", "hearing_date", "payment_date"):
            if c in pdf:
                pdf[c] = pdf[c].dt.strftime("%Y-%m-%d %H:%M:%S")
        path = os.path.join(folder, name)
        pdf.to_csv(path, index=False, encoding=enc)
        return path

    train_csv = to_csv(train_df, "train.csv", "latin-1")
    test_csv = to_csv(scoring_df, "test.csv", "utf-8")
    spec = RouteSpec(dated_features=["city", "violation_code", "disposition", "judgment_amount",
                                     "time_to_hearing"],
                     undated_features=["city", "disposition", "judgment_amount"])
    scores = score_ticket_files(spark, train_csv, test_csv, os.path.join(folder, "out"), spec)
    rows = {r["ticket_id"]: r["compliance"] for r in scores.collect()}
    assert sorted(rows) == [101, 102, 103, 104, 105, 106]
    assert rows[102] == rows[103] == 1.0 and all(0 <= v <= 1 for v in rows.values())
    written = spark.read.option("header", "true").csv(os.path.join(folder, "out")).count()
    assert written == 6


def test_stream_to_files_with_checkpoint(spark, scoring_df):
    from ledgerlens.streaming.tickets import start_clean_stream
    folder = tempfile.mkdtemp(prefix="ll-stream-files-")
    src, out = os.path.join(folder, "in"), os.path.join(folder, "out")
    scoring_df.limit(3).write.parquet(os.path.join(src, "batch1"))
    q = start_clean_stream(spark, os.path.join(src, "*"), out,
                           checkpoint_location=os.path.join(folder, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    first = spark.read.parquet(out).count()
    # a restart with the same checkpoint only processes new files
    scoring_df.write.parquet(os.path.join(src, "batch2"))
    q = start_clean_stream(spark, os.path.join(src, "*"), out,
                           checkpoint_location=os.path.join(folder, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    assert first == 3 and spark.read.parquet(out).count() == 3 + 6


def test_csv_quotes_line_breaks_and_header_order(spark):
    """The four faults a plain reader has: doubled quotes, line breaks in
    fields, another column order, rows of another shape."""
    import pandas as pd
    from pyspark.sql import types as T
    from ledgerlens.sources.csv_io import bad_rows, read_csv
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("amount", T.DoubleType()), T.StructField("city", T.StringType())])
    folder = tempfile.mkdtemp(prefix="ll-csv-")
    path = os.path.join(folder, "t.csv")
    frame = pd.DataFrame({"city": ["A, B", "C\nD", "E"], "id": [1, 2, 3], "name": ['ACME "THE" INC, LLC', "x", "y"],
                          "amount": [1.5, 2.0, None]})
    frame.to_csv(path, index=False)
    got = [tuple(r) for r in read_csv(spark, path, schema).orderBy("id").collect()]
    assert got == [(1, 'ACME "THE" INC, LLC', 1.5, "A, B"), (2, "x", 2.0, "C\nD"), (3, "y", None, "E")]
    bad = os.path.join(folder, "bad.csv")
    with open(bad, "w") as f:
        f.write("id,name,amount,city\n1,a,oops,b\n2,a,1.0\n3,a,1.0,b\n")
    r = bad_rows(spark, bad, schema).first()
    assert (r["n_rows"], r["n_misshaped"], r["amount"], r["id"]) == (3, 1, 1, 0)
    with pytest.raises(ValueError, match="no column city"):
        read_csv(spark, _without_city(folder), schema)


def _without_city(folder):
    path = os.path.join(folder, "no_city.csv")
    with open(path, "w") as f:
        f.write("id,name,amount\n1,a,1.0\n")
    return path


def test_order_without_customer_or_date_is_one_scored_ticket(spark):
    from ledgerlens.sources.ticket_view import scoring_part, train_part
    from datetime import datetime
    t = spark.createDataFrame([(1, datetime(1998, 1, 1), None), (2, datetime(2000, 1, 1), None), (3, None, None)],
                              "ticket_id long, ticket_issued_date timestamp_ntz, compliance double").withColumn(
        "payment_status", F.lit("F"))
    assert [r[0] for r in train_part(t).select("ticket_id").collect()] == [1]
    assert sorted(r[0] for r in scoring_part(t).select("ticket_id").collect()) == [2, 3]


def test_line_breaks_in_fields_are_found(spark, tmp_path):
    """Files without them are read in blocks, others whole; a quote inside a field is doubled."""
    from pyspark.sql import types as T
    from ledgerlens.sources import csv_io
    schema = T.StructType.fromDDL("a long, b string")
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text("a,b\n" + "".join(f'{i},"say ""x"", {i}"\n' for i in range(3000)))
    broken.write_text('a,b\n1,"one\ntwo"\n2,three\n')
    assert not csv_io.has_line_breaks_in_fields(spark, str(plain)) and csv_io.has_line_breaks_in_fields(spark, str(broken))
    assert [tuple(r) for r in csv_io.read_csv(spark, str(broken), schema).collect()] == [(1, "one\ntwo"), (2, "three")]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        df = csv_io.read_csv(spark, str(plain), schema)
        assert df.rdd.getNumPartitions() > 3 and df.count() == 3000 and df.filter("b = concat('say \"x\", ', a)").count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
