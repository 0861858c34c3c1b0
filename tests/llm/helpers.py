"""Small tables with the awkward rows every operator must stand."""

import random

from pyspark.sql import functions as F

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, extra=()):
    """Null text, null key, empty and blank texts, ties, repeated rows, one very long text."""
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "delta", "été", "über", "x1", "non-stop", "the", "of"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    a, b = prose(80), prose(30)
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, a, "en", "s", 1), (3, None, "fr", None, None),
            (4, "", "fr", "s", 0), (5, " \n\t ", "en", "s", 4), (None, b, None, "s", 9), (None, b + " end", None, "s", 9),
            (6, prose(20_000), "en", "s", 2), (7, b + "\n" + a, "en", "s", 3), (8, "one", "de", "s", 3)]
    return spark.createDataFrame([*rows, *extra], ROWS)


def with_clashes(docs, *names):
    """Extra columns whose names an operator may use inside."""
    for n in names:
        docs = docs.withColumn(n, F.lit(7))
    return docs


def empty(docs):
    return docs.filter(F.lit(False))
