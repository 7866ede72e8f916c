"""Term counts of free text (complaint reasons, documents).

Whole texts are tokenised JVM-side (lower + regex split), exploded, counted
per (group, term) with a partial aggregate, and the top-k terms per group
come from a per-group row_number <= k, which Spark limits per partition
before the shuffle. No text is truncated and no group is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: token separator: any run of characters that are not letters or digits
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"

#: our own short stop-word list (Spanish and English function words)
STOP_WORDS = (
    "a", "al", "and", "as", "at", "be", "by", "con", "de", "del", "el", "en", "es", "for", "from",
    "in", "is", "it", "la", "las", "lo", "los", "no", "of", "on", "or", "para", "por", "que", "se",
    "su", "the", "to", "un", "una", "was", "with", "y",
)


def tokens(df: DataFrame, text: str, keep: Sequence[str] = (), min_len: int = 2,
           stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """One row per token occurrence: (*keep, termino)."""
    t = df.select(*keep, F.explode(F.split(F.lower(F.col(text)), TOKEN_SPLIT)).alias("termino"))
    return t.filter((F.length("termino") >= min_len) & ~F.col("termino").isin(*stop_words))


def term_counts(df: DataFrame, text: str, group: str, top_k: int = 10,
                stop_words: Sequence[str] = STOP_WORDS, min_len: int = 2) -> DataFrame:
    """(group, termino, frecuencia, posicion) for the top_k terms of each
    group (ties by term)."""
    c = (tokens(df, text, [group], min_len, stop_words)
         .groupBy(group, "termino").agg(F.count(F.lit(1)).alias("frecuencia")))
    w = Window.partitionBy(group).orderBy(F.col("frecuencia").desc(), F.col("termino").asc())
    return c.withColumn("posicion", F.row_number().over(w)).filter(F.col("posicion") <= top_k)
