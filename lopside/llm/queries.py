"""The operators applied to their whole tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lopside.llm import (chat, dart, decontaminate, lattice, lines, negatives, packing, pages, substrings, tokens, topk,
                         toxicity, whitening)
from lopside.llm.common import read, stored

QUERIES: dict = {}
SQL: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def registered(f):
    QUERIES[f.__name__] = f
    return f


@registered
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.piece_rows(packing.pack(read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json")))


@registered
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    return toxicity.classified(read(spark, folder, "documents"), read(spark, folder, "labels"))


@registered
def op3_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best inner products of every hundredth vector against all others."""
    vectors = topk.quantised(read(spark, folder, "embeddings"))
    return topk.top_k(vectors, topk.every(vectors, 100))


SQL["op3_maxscore"] = topk.SQL


@registered
def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted, and what can be read back from them."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(chat.trap(rows))
    return chat.read_back(chat.format_chats(rows, vocabulary("byte_bpe_50k.json")))


@registered
def op7_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the paragraphs, lines and sentences that stand earlier."""
    return lines.digest_rows(lines.dedup(read(spark, folder, "documents")))


@registered
def op2_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    rows = pages.main_text(read(spark, folder, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@registered
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents contain which benchmark items."""
    return decontaminate.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("_key")


SQL["op9_decontaminate"] = decontaminate.SQL


@registered
def op4_dartminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the least id of its near-duplicate class."""
    return dart.near_duplicates(read(spark, folder, "documents")).select("doc_id", "class_id")


@registered
def op1_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """The log10 probability of every document, learned from six sevenths of them."""
    return lattice.score(read(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@registered
def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return substrings.digest_rows(substrings.dedup(docs).drop("text"))


@registered
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' token ids written as packed files in the order of their ids, and read back."""
    return tokens.decoded(stored(tokens.encoded(read(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))))


@registered
def op12_slicing(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors projected on up to 32 leading components, each of variance one."""
    return whitening.component_rows(read(spark, folder, "embeddings"))


@registered
def op13_zones(spark: SparkSession, folder: str) -> DataFrame:
    """For every hundredth vector's five positives, the ten best rows of other labels within their windows."""
    return negatives.mined(negatives.quantised(read(spark, folder, "embeddings")))


SQL["op13_zones"] = negatives.SQL
