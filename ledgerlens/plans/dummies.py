"""Sparse dummies and calendar features as pipeline stages (55, 56, 62, 63).

A fitted stage keeps the training vocabulary as a table, so any table it
transforms gets the same dummies: a value that training didn't have has none,
one that only training had is never set, and values listed as one share a
dummy.  Dummies are ML sparse vectors, however many values there are, and
stages can be saved with the pipeline they are in.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import calendar_parts, day_part_flags
from ..operators.encode import fit_label_codes
from .joins import lookup_attributes


class CalendarFeatures(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Month and weekday as text and the day-part flags of a timestamp column; null timestamps give null texts and 0."""

    @keyword_only
    def __init__(self, *, inputCol: str = "ticket_issued_date"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        at = self.getInputCol()
        texts = [c.cast("string").alias(n) for c, n in zip(calendar_parts(at), ("year", "month", "weekday", "hour")) if n in ("month", "weekday")]
        names = dataset.select(*day_part_flags(at)).columns
        flags = [F.coalesce(c.cast("int"), F.lit(0)).alias(n) for c, n in zip(day_part_flags(at), names)]
        taken = {"month", "weekday", *names}
        return dataset.select(*[c for c in dataset.columns if c not in taken], *texts, *flags)


class _DummyParams(HasInputCols, HasOutputCol):
    merges = Param(Params._dummy(), "merges", "JSON: column -> value -> value whose dummy it shares", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "unique column without nulls, or empty", TypeConverters.toString)

    def _merged(self, c: str) -> Column:
        text = F.col(c).cast("string")
        pairs = json.loads(self.getOrDefault(self.merges)).get(c, {})
        for value, into in pairs.items():
            text = F.when(F.col(c).cast("string") == value, F.lit(into)).otherwise(text)
        return text


class SparseDummies(Estimator, _DummyParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the vocabularies of text columns; null is no value."""

    def __init__(self, inputCols: Sequence[str] = (), outputCol: str = "dummies", merges: Mapping[str, Mapping[str, str]] | None = None,
                 keyCol: str = ""):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCol=outputCol, merges=json.dumps(merges or {}), keyCol=keyCol)

    def _fit(self, dataset: DataFrame) -> SparseDummiesModel:
        columns = self.getInputCols()
        vocabulary = fit_label_codes(dataset.select(*[self._merged(c).alias(c) for c in columns]), columns)
        return self._copyValues(SparseDummiesModel(vocabulary))


class _Writer(MLWriter):
    def __init__(self, model: SparseDummiesModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.vocabulary.write.parquet(f"{path}/vocabulary")


class _Reader(MLReader):
    def load(self, path: str) -> SparseDummiesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = SparseDummiesModel(self.sparkSession.read.parquet(f"{path}/vocabulary"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class SparseDummiesModel(Model, _DummyParams, MLWritable, MLReadable):
    """``vocabulary``: (attribute, value, code), codes from 0 in the order of the values."""

    def __init__(self, vocabulary: DataFrame | None = None) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self._known: dict[str, int] | None = None

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    @property
    def sizes(self) -> dict[str, int]:
        """Number of dummies of each column that has any, in the columns' order."""
        if self._known is None:
            found = {r["attribute"]: r["n"] for r in self.vocabulary.groupBy("attribute").agg(F.count("*").alias("n")).collect()}
            self._known = {c: found[c] for c in self.getInputCols() if found.get(c)}
        return self._known

    def dummies(self) -> DataFrame:
        """(index, attribute, value): what each place of the vectors stands for."""
        first, start = {}, 0
        for c, n in self.sizes.items():
            first[c], start = start, start + n
        base = F.create_map(*[x for c, n in first.items() for x in (F.lit(c), F.lit(n))]) if first else F.create_map().cast("map<string,int>")
        return self.vocabulary.select((F.element_at(base, F.col("attribute")) + F.col("code")).cast("int").alias("index"), "attribute", "value")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, sizes = self.getOutputCol(), self.sizes
        if not sizes:
            raise ValueError("training had no value in any column")
        columns = list(sizes)
        texts = {f"_text_{c}": self._merged(c) for c in columns}
        table = self.vocabulary.withColumn("attribute", F.concat(F.lit("_text_"), F.col("attribute")))
        coded = lookup_attributes(dataset.withColumns(texts), table, list(texts), "code", "_code",
                                  key=self.getOrDefault(self.keyCol) or None)
        # a value that is not in the vocabulary takes the place past the last one, which the encoder drops
        places = {f"_place_{c}": F.coalesce(F.col(f"_code_text_{c}"), F.lit(n)).cast("double") for c, n in sizes.items()}
        last = dataset.sparkSession.createDataFrame([[float(n - 1) for n in sizes.values()]], ", ".join(f"`_place_{c}` double" for c in columns))
        encoder = OneHotEncoder(inputCols=list(places), outputCols=[f"_dummy_{c}" for c in columns], dropLast=True, handleInvalid="keep").fit(last)
        joined = VectorAssembler(inputCols=[f"_dummy_{c}" for c in columns], outputCol=out)
        done = joined.transform(encoder.transform(coded.withColumns(places)))
        return done.select(*[c for c in dataset.columns if c != out], out)
