"""Stateless ticket steps on a stream.

The original is batch only.  Its per-row steps (sentinels, text casts,
flags, city rules, segment routing, the interval to the hearing) hold no
state, so the same functions run unchanged on a streaming DataFrame: a
scoring table that arrives as files is cleaned and routed as it lands.
Nothing here keeps state, so no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import with_time_to_hearing
from ..plans.routing import RouteSpec, prepare_scoring
from ..schema import SCORING_SCHEMA


def read_ticket_stream(spark: SparkSession, folder: str, fmt: str = "parquet",
                       max_files_per_trigger: int = 100) -> DataFrame:
    """Scoring tickets arriving as files in ``folder`` (explicit schema)."""
    reader = (spark.readStream.schema(SCORING_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(folder)


def clean_ticket_stream(stream: DataFrame, spec: RouteSpec | None = None) -> DataFrame:
    """Scoring-table cleaning and segment routing, row by row."""
    return with_time_to_hearing(prepare_scoring(stream, spec or RouteSpec()))


def start_clean_stream(spark: SparkSession, source_folder: str, sink_folder: str,
                       checkpoint_location: str | None = None, fmt: str = "parquet",
                       spec: RouteSpec | None = None, trigger_once: bool = False):
    """Clean and route tickets as files arrive; write parquet to
    ``sink_folder``.

    The file sink plus a checkpoint location gives exactly-once output that
    survives driver and executor restarts; by default the checkpoint lives
    under the cluster's shared ``spark.checkpoint.dir``.  Returns the
    ``StreamingQuery``.
    """
    import uuid

    from ..session import ensure_checkpoint_dir
    location = checkpoint_location or (
        f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlens/stream-{uuid.uuid4().hex}")
    cleaned = clean_ticket_stream(read_ticket_stream(spark, source_folder, fmt), spec)
    writer = (cleaned.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", location).option("path", sink_folder))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
