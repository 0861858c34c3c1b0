"""Join strategies for lookups against derived tables.

A lookup table here has unique keys (a vocabulary, an alias table, a
dimension).  Its size can grow with the data (vocabularies of free-text
columns do), so it is broadcast only after its size in bytes is checked; above
the bound the join is a shuffle join whose hot keys are salted, because one
value (``DETROIT``) may hold a third of all rows.  Rows with a null key match
nothing; they are salted too, so they spread over all tasks.

Many attributes of one table are looked up together (:func:`lookup_attributes`):
those whose values are past the bound become (row, attribute, value), meet the
lookup table in one join and are put together again, so they take two joins
however many there are; the others are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Bytes of a lookup table that are shipped to every executor at most; beyond
# it the shuffle join below gives the same rows.
MAX_BROADCAST_BYTES = 64 << 20
# Rows of a hot key that one task of the salted join gets, if no other figure
# follows from the key counts.
ROWS_PER_TASK = 1_000_000


def size_at_most(df: DataFrame, most_bytes: int) -> bool:
    """True when ``df`` takes at most ``most_bytes`` (:func:`row_bytes`).  One
    aggregate over ``df``: for tables that are cheap to read again, such as a
    materialized vocabulary."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= most_bytes


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of ``df``: texts by their length, maps, arrays and structs by that of their JSON, other values as 8."""
    def length(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(name), F.lit(0))
        if kind.startswith(("array", "map", "struct")):
            return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
        return F.lit(8)
    row = F.lit(8).cast("bigint")
    for name, kind in df.dtypes:
        row = row + length(name, kind)
    return row


def hot_keys(big: DataFrame, keys: list[str], partitions: int | None = None) -> list[tuple]:
    """The keys of :func:`hot_key_counts`, without their counts."""
    return [h[:-1] for h in hot_key_counts(big, keys, partitions)]


def hot_key_counts(big: DataFrame, keys: list[str], partitions: int | None = None) -> list[tuple]:
    """(key values..., rows) of the keys holding more than half a task's share of ``big``'s rows.

    Exact counts by a grouped aggregate (partial aggregation first, so the
    hot keys themselves are pre-summed on every mapper).  At most
    ``2 * partitions`` keys can pass the threshold, so the list collected to
    the driver is bounded by the partition count, not by the data.
    """
    parts = partitions or _tasks(big)
    known = big.dropna(subset=keys)
    counts = materialize(known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    threshold = max(total // (2 * parts), 1)
    return [tuple(r) for r in counts.filter(F.col("_n") > threshold).select(*keys, "_n").collect()]


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _salted(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``df`` with ``_salts``, the number of salts of the row's key: 1 if it isn't hot, null if a key is null."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.join(F.broadcast(hot), keys, "left").withColumn(
        "_salts", F.when(known, F.coalesce("_salts", F.lit(1))))


def _hot_table(big: DataFrame, keys: list[str], hot: list[tuple], schema) -> DataFrame:
    """(keys..., _salts) of the hot keys: a key's rows over the rows of a task.  At most twice as many rows as tasks."""
    tasks = _tasks(big)
    # keys given without their rows: as many salts as a third of the tasks
    hot = [h if len(h) > len(keys) else (*h, ROWS_PER_TASK * max(2, tasks // 3)) for h in hot]
    share = sum(h[-1] for h in hot) // tasks if hot else 0
    rows = max(1, min(ROWS_PER_TASK, share))
    fields = [T.StructField(k, schema[k].dataType) for k in keys] + [T.StructField("_salts", T.IntegerType())]
    return big.sparkSession.createDataFrame([(*h[:-1], max(2, -(-h[-1] // rows))) for h in hot], T.StructType(fields))


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str, hot: list[tuple],
                salt_by: Column) -> DataFrame:
    """Shuffle join whose hot keys (``hot``: (key..., rows)) are split by the hash ``salt_by`` of the row.

    ``big`` is read once.  Rows with a null key get one of as many salts as there
    are tasks, and ``small`` has no such row."""
    table = _hot_table(big, keys, hot, small.schema)
    spread = F.coalesce(F.col("_salts"), F.lit(_tasks(big)))
    left = _salted(big, keys, table).withColumn("_salt", F.pmod(salt_by, spread).cast("int")).drop("_salts")
    right = _salted(small, keys, table).filter(F.col("_salts").isNotNull()).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left",
                max_broadcast_bytes: int | None = None,
                small_is_bounded: bool = False,
                hot: list[tuple] | Callable[[], list[tuple]] | None = None) -> DataFrame:
    """Join ``big`` to a unique-keyed ``small`` table (``how``: left or inner).

    * ``small_is_bounded`` (a literal table, a size the caller checked) or a
      checked size under ``max_broadcast_bytes``: broadcast hash join, no
      shuffle of ``big`` at all.
    * otherwise: shuffle join with hot keys salted.  Rows whose key is hot
      (``hot`` — (key..., rows) tuples, or a function giving them only when
      this path is taken — or found by ``hot_keys``) get a deterministic salt,
      as many salts as the key's rows need tasks; the matching ``small`` rows
      are replicated once per salt, all other rows keep salt 0.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small_is_bounded or size_at_most(small, MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes):
        return big.join(F.broadcast(small), keys, how)
    hot = hot_key_counts(big, keys) if hot is None else (hot() if callable(hot) else hot)
    return salted_join(big, small, keys, how, hot, F.xxhash64(*[F.col(c) for c in big.columns]))


def lookup_attributes(df: DataFrame, table: DataFrame, attributes: Sequence[str], found: str,
                      prefix: str = "_found_", key: str | None = None,
                      max_broadcast_bytes: int | None = None,
                      hot: Callable[[], list[tuple]] | None = None) -> DataFrame:
    """``df`` with a column ``prefix + attribute`` for each attribute: the ``found`` column of the row of
    ``table`` (attribute, value, ``found``; unique) that holds the attribute's value as text, else null.

    * attributes whose slices of ``table`` take at most ``max_broadcast_bytes`` together, smallest first:
      broadcast, a hash join for each slice, no shuffle.
    * for the others every row becomes one (row, attribute, value) for each of them that isn't null.  These meet
      ``table`` in one join, in which hot values (``hot``: (attribute, value, rows), found by counting if not
      given) are split, are grouped by row again and joined back to the rows.  Rows are told apart by ``key``,
      which must be unique and not null, or by a number given while ``df`` is written to the shared folder.
      ``df`` is read twice with a ``key`` (the attributes alone, then all columns) and once without, however
      many attributes there are.
    """
    limit = MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    attributes = list(dict.fromkeys(attributes))
    columns = [*df.columns, *[prefix + a for a in attributes]]
    large = _past_limit(table, attributes, limit)
    if large:
        df = _looked_up_by_row(df, table, large, found, prefix, key, hot)
    for a in attributes:
        if a not in large:
            part = table.filter(F.col("attribute") == a).select(F.col("value").alias("_value"), F.col(found).alias(prefix + a))
            df = df.withColumn("_value", F.col(a).cast("string")).join(F.broadcast(part), "_value", "left").drop("_value")
    named = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return df.select(*named) if 0 < len(large) < len(attributes) else df


def _past_limit(table: DataFrame, attributes: list[str], limit: int) -> list[str]:
    """The attributes whose slices of ``table`` don't fit into ``limit`` bytes, the smaller slices having gone first."""
    own = table.filter(F.col("attribute").isin(attributes))
    sizes = {r["attribute"]: r["n"] for r in own.groupBy("attribute").agg(F.sum(row_bytes(own)).alias("n")).collect()}
    large, total = set(), 0
    for a in sorted(attributes, key=lambda a: sizes.get(a, 0)):
        total += sizes.get(a, 0)
        if total > limit:
            large.add(a)
    return [a for a in attributes if a in large]


def _looked_up_by_row(df: DataFrame, table: DataFrame, attributes: list[str], found: str, prefix: str, key: str | None,
                      hot: Callable[[], list[tuple]] | None) -> DataFrame:
    """:func:`lookup_attributes` for slices that are too large to broadcast."""
    row = key or "_row"
    if key is None:
        df = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows", wide=True)
    named = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    long = df.select(F.col(row).alias("_id"), F.explode(F.filter(named, lambda v: v["value"].isNotNull())).alias("_v")).select(
        "_id", "_v.attribute", "_v.value")
    slices = table.filter(F.col("attribute").isin(attributes)).select("attribute", "value", F.col(found).alias("_found"))
    counts = [h for h in hot() if h[0] in attributes] if hot else hot_key_counts(long, ["attribute", "value"])
    met = salted_join(long, slices, ["attribute", "value"], "inner", counts, F.xxhash64("_id"))
    whole = met.groupBy("_id").agg(*[F.max(F.when(F.col("attribute") == a, F.col("_found"))).alias(prefix + a) for a in attributes])
    out = df.join(whole, df[row] == whole["_id"], "left").drop("_id")
    return out.drop("_row") if key is None else out
