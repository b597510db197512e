"""Feature stages that Spark ML lacks, as ordinary saveable ML classes."""

from __future__ import annotations

import json

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, HashingTF, IDF, Normalizer,
                                StopWordsRemover, VectorAssembler)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lopside.functions.text import with_terms
from lopside.operators.encode import categories, dummies, dummy_names, moments, scaled
from lopside.session import durable


ALL_TERMS = (1 << 31) - 1  # CountVectorizer wants a number; vectors cannot be longer
WORD_TASK_BYTES = 2 << 20  # text that one task makes terms of
ENTRIES_A_WIDTH = 16
TASK_ENTRIES = 4 << 20  # of sparse vectors, 12 bytes each
CHAR_TASK_BYTES = 512 << 10  # character n-grams take several times the room of words


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def dealt(df: DataFrame, row_id: str, text: str, analyzer: str = "word") -> DataFrame:
    """The rows dealt out by their id, so that no task makes the terms of much more text than another.

    A table in one file is read by one or two tasks, however many cores there are. Tables that have enough
    partitions for their text already come back as they are.
    """
    held = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = -(-held // (WORD_TASK_BYTES if analyzer == "word" else CHAR_TASK_BYTES))
    if parts <= df.rdd.getNumPartitions():
        return df
    return df.repartition(parts, row_id).sortWithinPartitions(row_id)


def merged(rows: DataFrame, features: str) -> DataFrame:
    """The rows of vectors in few partitions, at most one a core, for solvers that run a job a step.

    Every task of a step makes and sends a sum as wide as the model, so it should hold many more entries than that.
    """
    x = F.unwrap_udt(features)
    entries, width = rows.agg(F.sum(F.size(x["values"])), F.max(F.coalesce(x["size"], F.size(x["values"])))).first()
    parts = max(1, (entries or 0) // (ENTRIES_A_WIDTH * max(1, width or 0)), -(-(entries or 0) // TASK_ENTRIES))
    return rows.coalesce(min(parts, rows.sparkSession.sparkContext.defaultParallelism))


def term_totals(narrow: DataFrame, terms: str, min_df: int) -> DataFrame:
    """(term, n, df) of an array column: how often and in how many rows a term stands, if in ``min_df`` at least."""
    ordered = narrow.select(F.sort_array(terms).alias("_sorted"))
    marked = ordered.select(F.explode(F.transform("_sorted", lambda term, i: F.struct(
        term.alias("term"), F.when((i > 0) & (F.get("_sorted", i - 1) == term), 0).otherwise(1).alias("first")))).alias("t"))
    return marked.groupBy("t.term").agg(F.count("*").alias("n"), F.sum("t.first").alias("df")).filter(F.col("df") >= min_df)


def counter_of(vocabulary: DataFrame, terms: str, out: str) -> CountVectorizerModel:
    """A count model of the one column's terms, in their order. They stay in the JVM: as Python texts they take several times the room."""
    context = vocabulary.sparkSession.sparkContext
    encoder = context._jvm.org.apache.spark.sql.Encoders.STRING()
    made = JavaWrapper._new_java_obj("org.apache.spark.ml.feature.CountVectorizerModel", getattr(vocabulary._jdf, "as")(encoder).collect())
    return CountVectorizerModel(made).setInputCol(terms).setOutputCol(out)


class TermsOf(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Text column to an array of terms (words, word n-grams or char_wb n-grams)."""

    spec = Param(Params._dummy(), "spec", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = "{}"):
        super().__init__()
        self._set(spec=spec)

    @staticmethod
    def of(text: str, out: str, **terms) -> TermsOf:
        if "ngram_range" in terms:
            terms["ngram_range"] = list(terms["ngram_range"])
        return TermsOf(spec=json.dumps({"text": text, "out": out, "terms": terms}))

    def _transform(self, df: DataFrame) -> DataFrame:
        spec = json.loads(self.getOrDefault(self.spec))
        terms = dict(spec["terms"])
        if "ngram_range" in terms:
            terms["ngram_range"] = tuple(terms["ngram_range"])
        return with_terms(df, spec["text"], spec["out"], **terms)


class SublinearTf(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Term counts to ``1 + ln(count)``, inside the JVM.

    The vector is opened as a struct, its values are mapped by an SQL lambda, and
    it is closed again through the vector type's own JSON form, which keeps every
    double exactly.
    """

    inputCol = Param(Params._dummy(), "inputCol", "counts", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "result", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "tf", outputCol: str = "log_tf"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        opened, out = "_opened", self.getOrDefault(self.outputCol)
        shape = T.StructType([T.StructField("v", VectorUDT())])
        df = df.withColumn(opened, F.unwrap_udt(self.getOrDefault(self.inputCol)))
        mapped = F.struct(F.struct(
            F.lit(0).alias("type"), F.col(f"{opened}.size").alias("size"),
            F.col(f"{opened}.indices").alias("indices"),
            F.transform(f"{opened}.values", lambda v: 1 + F.log(v)).alias("values")).alias("v"))
        return df.withColumn(out, F.from_json(F.to_json(mapped), shape)["v"]).drop(opened)


class TextTfidf(Estimator):
    """TF-IDF vectors with idf ``ln((1+N)/(1+df)) + 1`` and unit length.

    The fitted model is a pipeline of Spark ML stages. The vocabulary is part of
    the model and must fit in memory; no term is dropped. One grouped count gives the
    vocabulary, the most frequent terms first, and the document frequencies; only terms of at
    least ``min_df`` documents reach the driver. For larger vocabularies
    ``hashed=`` gives vectors of a fixed size, and the long form has no limit.
    """

    def __init__(self, text: str, out: str = "features", *, min_df: int = 1, sublinear: bool = True,
                 hashed: int | None = None, **terms):
        super().__init__()
        self.text, self.out, self.min_df, self.sublinear = text, out, min_df, sublinear
        self.hashed, self.terms = hashed, terms

    def dealt(self, df: DataFrame, row_id: str) -> DataFrame:
        return dealt(df, row_id, self.text, self.terms.get("analyzer", "word"))

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages = [TermsOf.of(self.text, "_terms", **self.terms)]
        narrow = stages[0].transform(df.select(self.text))
        if self.hashed:
            stages.append(HashingTF(numFeatures=self.hashed, inputCol="_terms", outputCol="_tf"))
            idf = IDF(inputCol="_tf", outputCol="_idf").fit(stages[-1].transform(narrow)).idf.toArray()
        else:
            found = term_totals(narrow, "_terms", self.min_df).orderBy(F.desc("n"), "term").select("term", "df")
            found = durable(found)
            if found.isEmpty():
                raise ValueError(f"no term stands in {self.min_df} rows; lower min_df")
            stages.append(counter_of(found.select("term"), "_terms", "_tf"))
            idf = np.log((df.count() + 1.0) / (found.select("df").toArrow()["df"].to_numpy() + 1.0))
        idf = idf + 1.0
        source = "_tf"
        if self.sublinear:
            stages.append(SublinearTf(inputCol="_tf", outputCol="_log_tf"))
            source = "_log_tf"
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=source, outputCol="_weighted"))
        stages.append(Normalizer(p=2.0, inputCol="_weighted", outputCol=self.out))
        stages.append(DropColumns(columns=["_terms", "_tf", "_log_tf", "_weighted"]))
        return PipelineModel(stages)


def vocabulary_size(model: PipelineModel) -> int:
    for stage in model.stages:
        if isinstance(stage, CountVectorizerModel):
            return len(stage._java_obj.vocabulary())
    raise ValueError("no vocabulary in this model")


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "names to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(columns=columns or [])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.columns))


class TabularEncoder(Estimator):
    """One-hot without the first category, population-scaled numbers, one vector."""

    def __init__(self, categorical: list[str], numeric: list[str], out: str = "features"):
        super().__init__()
        self.categorical, self.numeric, self.out = list(categorical), list(numeric), out

    def _fit(self, df: DataFrame) -> TabularModel:
        found = categories(df, self.categorical) if self.categorical else {}
        rows = moments(df, self.numeric).collect() if self.numeric else []
        scale = {r["column"]: [r["mean"], r["std"]] for r in rows}
        return TabularModel(spec=json.dumps({
            "categories": [[c, found[c]] for c in self.categorical],
            "scale": [[c, *scale[c]] for c in self.numeric], "out": self.out}))


class TabularModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    spec = Param(Params._dummy(), "spec", "fitted values as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = "{}"):
        super().__init__()
        self._set(spec=spec)

    def _read(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))

    @property
    def feature_names(self) -> list[str]:
        spec = self._read()
        return [n for c, values in spec["categories"] for n in dummy_names(c, values)] + [
            c for c, _, _ in spec["scale"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        spec = self._read()
        made = [d for c, values in spec["categories"] for d in dummies(c, values)]
        made += [scaled(c, m, s).alias(c) for c, m, s in spec["scale"]]
        names = self.feature_names
        temporary = [f"_f_{n}" for n in names]
        wide = df.withColumns(dict(zip(temporary, made)))
        assembled = VectorAssembler(inputCols=temporary, outputCol=spec["out"]).transform(wide)
        return assembled.drop(*temporary)

    def unknown_counts(self, df: DataFrame) -> DataFrame:
        """Rows per categorical column whose value was never seen in training."""
        spec = self._read()
        return df.agg(*[
            F.coalesce(F.sum(F.when(~F.col(c).isin(values), 1)), F.lit(0)).cast("bigint").alias(c)
            for c, values in spec["categories"]])
