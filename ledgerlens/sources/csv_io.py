"""CSV ticket sources and the score sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ADDRESS_SCHEMA, LATLON_SCHEMA, SCORE_SCHEMA, SCORING_SCHEMA, TRAIN_SCHEMA  # noqa: F401


CORRUPT = "_corrupt_record"
_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


def has_line_breaks_in_fields(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field of the files goes over several lines: then a line holds an odd number of quotes.  Reads
    the files as lines, each in as many tasks as it has blocks; quotes are one byte in Latin-1 and UTF-8 alike."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _raw(spark: SparkSession, path: str, encoding: str, multi_line: bool | None, pruned: bool = True) -> DataFrame:
    """All columns of the files as text, in the files' order, plus the record
    itself where it doesn't have as many fields as the header (told only if
    not ``pruned``: else the parser skips columns nobody asks for)."""
    if multi_line is None:
        multi_line = has_line_breaks_in_fields(spark, path)

    def reader():
        return (spark.read.option("header", "true").option("encoding", encoding)
                .option("quote", '"').option("escape", '"').option("multiLine", str(multi_line).lower()))
    names = reader().csv(path).columns  # reads the header only
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (reader().schema(schema).option("mode", "PERMISSIVE").option("enforceSchema", "false")
            .option("columnPruning", str(pruned).lower()).option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def _parsed(field: T.StructField) -> Column:
    text = F.trim(F.col(field.name))
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.expr(f"cast(try_to_timestamp(trim(`{field.name}`), '{_TIMESTAMP}') as timestamp_ntz)")
    if isinstance(field.dataType, T.LongType):  # 12 and 12.0 are the same id
        return text.try_cast("decimal(38,4)").cast("long")
    return text.try_cast(field.dataType)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             encoding: str = "UTF-8", multi_line: bool | None = None) -> DataFrame:
    """Header CSV as the columns of ``schema`` (no inference pass).

    Columns are taken by their header name, whatever their order; a column the
    file lacks is an error, further columns are ignored.  Fields may be quoted
    with ``"`` (a quote inside is doubled) and hold commas and, with
    ``multi_line``, line breaks.  Such a file is read by one task, others in
    blocks; if not given, a pass over the files' lines tells which they are
    (see :func:`has_line_breaks_in_fields`).  ``encoding='ISO-8859-1'`` reads
    Latin-1 files.  A value that isn't of its type becomes null; see
    :func:`bad_rows` for their number.
    """
    raw = _raw(spark, path, encoding, multi_line)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[_parsed(f).alias(f.name) for f in schema])


def bad_rows(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8",
             multi_line: bool | None = None) -> DataFrame:
    """One row: ``n_rows``, ``n_misshaped`` (another number of fields than the
    header) and, by column, the values that are not of its type."""
    raw = _raw(spark, path, encoding, multi_line, pruned=False)
    wrong = [F.sum((F.col(f.name).isNotNull() & _parsed(f).isNull()).cast("long")).alias(f.name)
             for f in schema if f.name in raw.columns and not isinstance(f.dataType, T.StringType)]
    return raw.agg(F.count(F.lit(1)).alias("n_rows"), F.count(CORRUPT).alias("n_misshaped"), *wrong)


def read_train(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRAIN_SCHEMA, encoding="ISO-8859-1")


def read_scoring(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SCORING_SCHEMA)


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ADDRESS_SCHEMA)


def read_latlons(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, LATLON_SCHEMA)


def write_scores_csv(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``ticket_id, compliance`` as header CSV, one file per partition."""
    scores.select("ticket_id", "compliance").write.mode(mode).option("header", "true").csv(path)
