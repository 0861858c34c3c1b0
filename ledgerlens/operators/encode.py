"""Encoding operators (59-63): label codes, one-hot dummies, dummy alignment.

Label codes are the rank of the value in the sorted vocabulary (0-based),
fitted on one table and applied to another.  The fitted vocabulary is a
DataFrame ``(attribute, value, code)`` joined back with the size-checked
lookup join, so a vocabulary larger than driver memory still works.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import NULL_SENTINEL
from ..plans.joins import lookup_attributes
from ..plans.ranking import ordered_positions
from ..session import materialize
from .profile import unpivot_as_text


def fit_label_codes(df: DataFrame, attributes: Sequence[str],
                    always_include: Sequence[str] = (), persist: bool = True) -> DataFrame:
    """Vocabulary ``(attribute, value, code)``; code = rank among the sorted
    distinct values (binary string order, as a sorted Python list)."""
    values = (unpivot_as_text(df, attributes).filter(F.col("value").isNotNull())
              .select("attribute", "value"))
    if always_include:
        spark = df.sparkSession
        extra = spark.createDataFrame([(a, v) for a in attributes for v in always_include],
                                      "attribute string, value string")
        values = values.unionByName(extra)
    distinct = values.distinct()
    # position in the sorted vocabulary, ranked across balanced range
    # partitions (a vocabulary may be too big for one task)
    codes = ordered_positions(distinct, ["attribute"], "value").select(
        "attribute", "value", F.col("_start").cast("bigint").alias("code"))
    return materialize(codes, "label_codes") if persist else codes


def apply_label_codes(df: DataFrame, codes: DataFrame, attributes: Sequence[str],
                      handle_unseen: str = "error", suffix: str = "",
                      hot_for: Callable[[], list[tuple]] | None = None,
                      key: str | None = None) -> DataFrame:
    """Replace each attribute by its code (or add ``attribute+suffix``).

    ``handle_unseen``: ``'error'`` fails the job on a value the vocabulary
    lacks (a fitted encoder's default), ``'keep'`` gives it the code
    ``len(vocabulary)``, ``'null'`` gives null.  A null value stays null.
    All attributes are looked up together (``plans.joins.lookup_attributes``; ``key``: see
    there); ``hot_for()`` may supply the hot (attribute, value, rows), asked for only when
    the codes are too big to broadcast.
    """
    if handle_unseen not in ("error", "keep", "null"):
        raise ValueError(handle_unseen)
    sizes = {}
    if handle_unseen == "keep":
        sizes = {r["attribute"]: r["n"] for r in
                 codes.groupBy("attribute").agg(F.count("*").alias("n")).collect()}
    out = lookup_attributes(df, codes, attributes, "code", "_code_", key=key, hot=hot_for)

    def coded(a: str):
        code, unseen = F.col(f"_code_{a}"), F.col(f"_code_{a}").isNull() & F.col(a).isNotNull()
        if handle_unseen == "error":
            message = F.concat(F.lit(f"unseen label in {a}: "), F.col(a).cast("string"))
            return F.when(unseen, F.raise_error(message).cast("bigint")).otherwise(code)
        return F.when(unseen, F.lit(int(sizes.get(a, 0)))).otherwise(code) if handle_unseen == "keep" else code

    return out.withColumns({a + suffix: coded(a) for a in attributes}).drop(*[f"_code_{a}" for a in attributes])


def decode_label_codes(df: DataFrame, codes: DataFrame, attributes: Sequence[str], key: str | None = None) -> DataFrame:
    """Inverse of ``apply_label_codes``: codes back to their values."""
    backwards = codes.select("attribute", F.col("code").cast("string").alias("value"), F.col("value").alias("text"))
    out = lookup_attributes(df, backwards, attributes, "text", "_text_", key=key)
    return out.withColumns({a: F.col(f"_text_{a}") for a in attributes}).drop(*[f"_text_{a}" for a in attributes])


def label_encode(df: DataFrame, attributes: Sequence[str],
                 always_include: Sequence[str] = (NULL_SENTINEL,)) -> tuple[DataFrame, DataFrame]:
    """Fit on ``df`` and encode it; returns (encoded, vocabulary)."""
    codes = fit_label_codes(df, attributes, always_include)
    return apply_label_codes(df, codes, attributes), codes


def dummy_vocabulary(df: DataFrame, column: str, max_values: int | None = None) -> list[str]:
    """Sorted distinct values of a low-cardinality column.

    Dummy columns are schema, so their names must be known when the plan is
    built; use :func:`one_hot_sparse` for columns with many values.  With
    ``max_values`` more values than that are an error.
    """
    distinct = df.select(F.col(column).cast("string").alias("v")).filter(F.col("v").isNotNull()).distinct()
    if max_values is not None and distinct.limit(max_values + 1).count() > max_values:
        raise ValueError(f"{column} has more than {max_values} values; use label codes")
    return sorted(r["v"] for r in distinct.collect())


def one_hot(df: DataFrame, columns: Sequence[str],
            vocabularies: Mapping[str, Sequence[str]] | None = None,
            drop_original: bool = True) -> DataFrame:
    """``column_value`` 0/1 dummies, one per vocabulary value; a null gives
    all zeros.  Map-side only: no shuffle, no pivot."""
    vocabularies = dict(vocabularies or {})
    new_cols = {}
    for c in columns:
        vocab = vocabularies.get(c) or dummy_vocabulary(df, c)
        for v in vocab:
            new_cols[f"{c}_{v}"] = F.when(F.col(c).cast("string") == F.lit(v), 1).otherwise(0)
    out = df.withColumns(new_cols)
    return out.drop(*columns) if drop_original else out


def one_hot_sparse(df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None,
                   out: str = "dummies") -> DataFrame:
    """``out``: array of (attribute, code) of the dummies that are 1, for any
    number of values; a null or (with given ``codes``) unseen value has none.
    The columns stay a single array however many values there are."""
    codes = fit_label_codes(df, columns) if codes is None else codes
    coded = apply_label_codes(df, codes, columns, handle_unseen="null", suffix="_code")
    hot = F.array(*[F.when(F.col(f"{c}_code").isNotNull(), F.struct(
        F.lit(c).alias("attribute"), F.col(f"{c}_code").alias("code"))) for c in columns])
    return coded.withColumn(out, F.filter(hot, lambda d: d.isNotNull())).drop(*[f"{c}_code" for c in columns])


def align_dummies(df: DataFrame, reference_columns: Sequence[str],
                  merges: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Project onto the training dummy schema: merge listed dummies by OR,
    add missing ones as 0, drop dummies the reference does not have."""
    out = df
    for target, sources in (merges or {}).items():
        present = [s for s in sources if s in out.columns]
        if present:
            out = out.withColumn(target, F.greatest(*[F.col(s) for s in present] + [F.lit(0)]))
    cols = [F.col(c) if c in out.columns else F.lit(0).alias(c) for c in reference_columns]
    return out.select(*cols)


def fit_folded_codes(vocab: DataFrame, fold_attributes: Sequence[str],
                     encoded_attributes: Sequence[str],
                     sentinel: str = NULL_SENTINEL) -> tuple[DataFrame, dict[str, int]]:
    """Label codes of the folded training table, fitted from a vocabulary
    table ``(attribute, value, n_left, n_right)`` alone (no pass over rows).

    After folding, a folded attribute's training values are the shared
    values plus the sentinel; another encoded attribute keeps its training
    values (plus the sentinel).  Returns the lookup ``(attribute, value,
    code)`` covering EVERY observed value — for folded attributes an
    unshared value already carries the sentinel's code — and the sentinel
    code per folded attribute (for nulls)."""
    fold = set(fold_attributes)
    spark = vocab.sparkSession
    is_fold = F.col("attribute").isin(list(fold)) if fold else F.lit(False)
    kept = vocab.filter(F.col("attribute").isin(list(encoded_attributes)) & F.when(
        is_fold, (F.col("n_left") > 0) & (F.col("n_right") > 0)).otherwise(F.col("n_left") > 0))
    extra = spark.createDataFrame([(a, sentinel) for a in encoded_attributes],
                                  "attribute string, value string")
    code_vocab = kept.select("attribute", "value").unionByName(extra).distinct()
    codes = materialize(ordered_positions(code_vocab, ["attribute"], "value").select(
        "attribute", "value", F.col("_start").cast("bigint").alias("code")), "label_codes")
    sentinel_codes = {r["attribute"]: int(r["code"]) for r in
                      codes.filter(F.col("value") == F.lit(sentinel)).collect()}
    folded_enc = [a for a in encoded_attributes if a in fold]
    if folded_enc:
        nan_code = F.create_map(*[x for a in folded_enc for x in (F.lit(a), F.lit(sentinel_codes[a]))])
        unshared = (vocab.filter(F.col("attribute").isin(folded_enc))
                    .join(codes, ["attribute", "value"], "left_anti")
                    .select("attribute", "value",
                            F.element_at(nan_code, F.col("attribute")).alias("code")))
        codes = materialize(codes.unionByName(unshared), "folded_codes")
    return codes, {a: sentinel_codes[a] for a in folded_enc}


def apply_folded_codes(df: DataFrame, codes: DataFrame, encoded_attributes: Sequence[str],
                       sentinel_codes: dict[str, int],
                       hot_for: Callable[[], list[tuple]] | None = None,
                       key: str | None = None) -> DataFrame:
    """Folded attributes map any value (and null) to its folded code; other
    attributes fail on an unseen value.  ``hot_for``, ``key``: see :func:`apply_label_codes`."""
    out = apply_label_codes(df, codes, encoded_attributes, handle_unseen="error",
                            hot_for=hot_for, key=key)
    fixes = {a: F.coalesce(F.col(a), F.lit(code)) for a, code in sentinel_codes.items()}
    return out.withColumns(fixes) if fixes else out
