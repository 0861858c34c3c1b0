from pyspark.sql import functions as F

from ledgerlens.functions import text as TX
from ledgerlens.operators import clean


def _col(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} string")


def _out(df, col):
    return [r[col] for r in df.orderBy("id").collect()]


def test_person_flag_regex_semantics(spark):
    names = ["JOHN SMITH", "ACME INC", None, "PRINCE HALL", "PARCEL 12", "First Church of God",
             "Abc inc", "Abc inc.", "O'NEIL", "BOB CO", "BOB COX", "L.L.C", "SMITH L-L-C-",
             "Big Bank", "Jones & Sons", "Mary Jane"]
    df = _col(spark, names).select("id", TX.person_flag("v").alias("people"))
    assert _out(df, "people") == [1, 0, 1, 0, 0, 0, 1, 0, 0, 1, 0, 1, 0, 0, 0, 1]


def test_dot_matches_carriage_return_like_python(spark):
    # "CO." must match "CO\r" (Python's "." only stops at "\n").
    df = _col(spark, ["ACO\rX", "ACO\n"]).select("id", TX.person_flag("v").alias("people"))
    assert _out(df, "people") == [0, 1]


def test_box_and_mile_flags(spark):
    df = _col(spark, ["PO BOX 12", "p.o. box", "8 MILE RD", "Smiley", None, "MAIN ST"])
    df = df.withColumnRenamed("v", "mailing_address_str_name")
    out = clean.add_text_flags(df, name_col="absent").orderBy("id").collect()
    assert [r["address_BOX"] for r in out] == [1, 1, 0, 0, 0, 0]
    assert [r["address_MILE"] for r in out] == [0, 0, 1, 1, 0, 0]


def test_city_rules_train(spark):
    cities = ["Deroit", "south field", "LOS ANGLES", "BUFFLAO", None, "det;roit", "St. Clair"]
    df = clean.normalise_city(_col(spark, cities, "city"), rules="train")
    assert _out(df, "city") == ["DETROIT", "SOUTHFIELD", "LOSANGELES", "BUFFALO", None,
                                "DETLROIT", "STCLAIR"]
    df = clean.normalise_city(_col(spark, [None], "city"), rules="train", null_as="nan")
    assert _out(df, "city") == ["nan"]


def test_city_rules_scoring_literal_brackets(spark):
    cities = ["Detroit1", "NEW YOUR", "A[0123456789]B", "SOUTHFILELD", "B-1_2"]
    df = clean.normalise_city(_col(spark, cities, "city"), rules="scoring")
    # "[0123456789]" and "[-_]" are literal text, not character classes
    assert _out(df, "city") == ["DETROIT", "NEWYORK", "AB", "SOUTHFIELD", "B-1_2"]


def test_default_then_scoring_rules(spark):
    df = clean.fill_default(_col(spark, [None, "x"], "city"))
    assert _out(df, "city") == ["DETROIT", "x"]


def test_collapse_later_rule_wins(spark):
    vals = ["Responsible - Compl/Adj by Determi", "Responsible - Compl/Adj by Default",
            "Default then Determi", "Responsible by Admission", None]
    df = clean.collapse_categories(_col(spark, vals, "disposition"))
    assert _out(df, "disposition") == ["Responsible by Determination", "Responsible by Default",
                                       "Responsible by Determination", "Responsible by Admission",
                                       None]


def test_country_from_city(spark):
    df = _col(spark, ["TORONTOCANADA", "SYDNEYAUSTRALIA", "CANADA AUSTRALIA", "DETROIT"], "city")
    df = df.withColumn("country", F.lit("USA"))
    assert _out(clean.country_from_city(df), "country") == ["Cana", "Aust", "Aust", "USA"]


def test_sentinel_and_text_cast(spark):
    df = spark.createDataFrame([(0, None, "12.0"), (1, "A", "12.5"), (2, "B", "ABC"),
                                (3, None, None)], "id int, state string, zip_code string")
    out = clean.cast_to_text(clean.fill_sentinel(df)).orderBy("id").collect()
    assert [r["state"] for r in out] == ["NaN", "A", "B", "NaN"]
    assert [r["zip_code"] for r in out] == ["12", "12.5", "ABC", "NaN"]


def test_or_and_mean_columns(spark):
    df = spark.createDataFrame([(0, 1, 0, 0.2, 0.4), (1, 0, 0, 0.5, 1.0)],
                               "id int, a int, b int, s1 double, s2 double")
    out = clean.mean_of_columns(clean.or_columns(df, "ab", ["a", "b"]), "m", ["s1", "s2"])
    rows = out.orderBy("id").collect()
    assert [r["ab"] for r in rows] == [1, 0]
    assert [round(r["m"], 9) for r in rows] == [0.3, 0.75]
    assert "a" not in out.columns
