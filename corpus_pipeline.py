"""From raw documents to packed sequences: each stage applies one operator to all that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lopside.llm import dart, decontaminate, lines, packing, toxicity
from lopside.llm.common import given_back, guarded, read, stored
from lopside.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows among them, does not call toxic."""
    model = toxicity.train(docs, read(spark, folder, "labels"))
    given, names = guarded(docs, "doc_id", "text")
    return given_back(toxicity.score(given, model).filter("score < 0.5"), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of the least id of each near-duplicate class."""
    given, names = guarded(docs, "doc_id", "text")
    return given_back(dart.first_of_each(given), names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without paragraphs, lines, sentences and stretches that stand earlier; ``n_chars`` follows the text, emptied documents go."""
    given, names = guarded(docs, "doc_id", "text", "n_chars")
    out = lines.dedup(given).filter("size(removed) = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", lines.changed_length(docs.schema["n_chars"].dataType))
    return given_back(out, names)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    given, names = guarded(docs, "doc_id", "text")
    return given_back(decontaminate.clean(given, read(spark, folder, "benchmark")), names)


def pack_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens."""
    return packing.piece_rows(packing.pack(docs, vocabulary("byte_bpe_50k.json")))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("line_dedup", drop_repeated_lines),
          ("decontamination", drop_leaks), ("packing", pack_documents)]

# Learning, sketches and token ids cannot be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
