"""Text expressions: repair, measures, tokens, n-grams. Only accent stripping needs Python."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed patterns that the results depend on. (?U) gives Python's Unicode meaning
# of \s and \w, (?d) its meaning of "." and "$".
TRAILING_PARENTHETICAL = r"(?Ud)\s*\(.*\)\s*$"
WORD = r"[\p{L}\p{N}_]{2,}"  # Python's \w: letters, numbers of every kind, no combining marks
EDGE_SPACE = r"(?U)^\s+|\s+$"
SPACE_RUN = r"(?U)\s+"


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_SPACE, "")


def strip_parenthetical(c: Column) -> Column:
    """Drop from the first ``(`` on when the text ends with ``)``."""
    return F.regexp_replace(c, TRAILING_PARENTHETICAL, "")


def build_text(title: Column | None, body: Column) -> Column:
    """``title . body``, or the body alone; null if a part is null.

    Training and scoring share this function, so they build the same text.
    """
    if title is None:
        return body
    return F.concat(strip_parenthetical(title), F.lit(" . "), body)


def join_parts(first: Column, *rest: Column) -> Column:
    """Re-join a text that was cut at its commas, skipping empty (null) parts."""
    return F.concat_ws(",", first, *rest)


def words(c: Column) -> Column:
    return F.filter(F.split(c, SPACE_RUN), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def shorten(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


@F.pandas_udf(StringType())
def _unmarked(texts: pd.Series) -> pd.Series:
    def bare(text: str | None) -> str | None:
        if text is None or text.isascii():
            return text
        return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))

    return texts.map(bare, na_action="ignore")


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and drop the combining marks, in every script.

    Spark has no normal forms, so this runs in Arrow batches; ASCII texts pass through.
    """
    return _unmarked(c)


def word_tokens(c: Column, accents: bool = True) -> Column:
    """Lower-cased runs of two or more word characters."""
    text = F.lower(c)
    return F.regexp_extract_all(text if accents else strip_accents(text), F.lit(WORD), 0)


def without(tokens: Column, stop_words: Iterable[str]) -> Column:
    stop = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens


def _joined(tokens: Column, n: int):
    return lambda first, i: F.concat_ws(" ", first, *[tokens[i + k] for k in range(1, n)])


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` tokens, joined by a space.

    ``tokens`` should be a stored column: the expression is used several times.
    """
    parts = []
    for n in range(low, high + 1):
        if n == 1:
            parts.append(tokens)
            continue
        starts = F.slice(tokens, 1, F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        parts.append(F.transform(starts, _joined(tokens, n)))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_wb_ngrams(c: Column, low: int, high: int) -> Column:
    """Character n-grams inside words, each word padded with one space per side.

    A word no longer than n gives itself once and no larger n.
    """
    padded = F.transform(words(F.lower(c)), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(word: Column) -> Column:
        length = F.length(word)
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.greatest(length, F.lit(low))))
        return F.flatten(F.transform(sizes, lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1))),
            lambda i: F.substring(word, i, n))))

    return F.flatten(F.transform(padded, grams))


def with_terms(df: DataFrame, text: str, out: str = "terms", analyzer: str = "word",
               ngram_range: tuple[int, int] = (1, 1), stop_words: Iterable[str] = (),
               accents: bool = True) -> DataFrame:
    """Add the array of terms of a text column.

    ``accents=False`` strips accents. Each step is its own projection, so a token
    list is made once and not again for every n-gram.
    """
    if analyzer == "char_wb":
        source = F.col(text) if accents else strip_accents(F.lower(F.col(text)))
        return df.withColumn(out, char_wb_ngrams(source, *ngram_range))
    if analyzer != "word":
        raise ValueError(f"unknown analyzer {analyzer!r}")
    df = df.withColumn(out, without(word_tokens(F.col(text), accents), stop_words))
    if ngram_range == (1, 1):
        return df
    return df.withColumn(out, ngrams(F.col(out), *ngram_range))


def message_measures(c: Column) -> dict[str, Column]:
    """Obfuscation-proof measures of a message."""
    length = F.length(c)
    digits = F.regexp_count(c, F.lit("[0-9]"))
    return {
        "n_chars": length,
        "n_digits": digits,
        "digit_ratio": F.coalesce(F.try_divide(digits.cast("double"), length.cast("double")),
                                  F.lit(0.0)),
        "uppercase_runs": F.regexp_count(c, F.lit("[A-Z]{2,}")),
        "has_url": c.rlike(r"(?i)(https?://|www\.)").cast("int"),
        "has_long_number": c.rlike("[0-9]{5,}").cast("int"),
    }
