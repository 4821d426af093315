"""Quality rules: per-text word and repetition rules, and cross-document line frequency per host.

A line is normalised (blanks stripped, A-Z lower-cased) and hashed with 128 bits; lines of at
least ``min_chars`` code points found in more than ``max_docs`` documents of one host are
boilerplate of that host and are removed from all its documents, and the other lines are put together by position.  A document that keeps less
than ``min_kept`` of its words is depleted and rejected, as is one that fails the rules on its
own text.

Defined cases: a null text has no words and fails; a null host and an empty one are the same
host; rows without an id are not counted as documents, but lose boilerplate like any other; rows that
repeat an id and text count once; input columns called as the output are replaced; an empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import WORD_BREAK, cut, hash128, line_key

SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, window):  # renumbered after each step, so that codes stay below len(words) ** 2
        code = np.unique(code * len(number) + ids[k:k + n], return_inverse=True)[1].astype(np.int64)
    twice = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:k + n] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # breaks at [\x20\x09-\x0D] only
    lines = [x for x in text.split("\n") if x.strip(BLANK_CHARS)]
    return (len(words), len(text) - sum(map(text.count, BLANK_CHARS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def measures_column(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measures(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES))

    return measures(text)


def count_words(col: Column) -> Column:
    return F.size(F.filter(F.split(col, WORD_BREAK), lambda w: w != ""))


def boilerplate_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(host, hash) of the lines in more than ``max_docs`` documents of a host."""
    return (lines.groupBy("__host", "__h1", "__h2").agg(F.count_distinct("__id", "__th").alias("__n"))
            .where(F.col("__n") > max_docs).drop("__n"))


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    max_docs: int = 10, min_chars: int = 20, min_kept: float = 0.5, min_words: int = 50,
                    max_repeat_percent: int = 50) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, the measures (before), n_boilerplate_words, base_failed, kept.

    Texts without boilerplate come back as they are.  Who selects no text shuffles numbers only.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the input row travels as single columns under names of its own, so that Spark can prune them
    rows = docs.select(*[F.col(c).alias(f"__in_{c}") for c in docs.columns], F.col(id_col).alias("__id"),
                       F.coalesce(F.col(host_col), F.lit("")).alias("__host"), text.alias("__t"), F.xxhash64(text).alias("__th"))
    lines = (rows.select("__id", "__host", "__th", F.posexplode(F.split("__t", "\n", -1)).alias("__pos", "__line"))
             .withColumn("__key", line_key(F.col("__line")))
             .where(F.char_length("__key") >= min_chars)
             .select("__id", "__host", "__th", "__pos", count_words(F.col("__line")).alias("__words"),
                     *[h.alias(n) for h, n in zip(hash128(F.col("__key")), ("__h1", "__h2"))]))
    # written, so that the join below has a shuffle of its own, in which a line of very many documents can be split
    frequent = cut(boilerplate_lines(lines.where("__id is not null"), max_docs), "boilerplate")
    # equal rows hold equal lines at equal positions: the set holds each once
    lost = (lines.join(frequent, ["__host", "__h1", "__h2"])
            .groupBy(F.col("__id").alias("__id1"), F.col("__host").alias("__host1"), F.col("__th").alias("__th1"))
            .agg(F.collect_set(F.struct("__pos", "__words")).alias("__gone")))
    same = F.col("__id").eqNullSafe(F.col("__id1")) & (F.col("__host") == F.col("__host1")) & (F.col("__th") == F.col("__th1"))
    n_lost = F.coalesce(F.aggregate("__gone", F.lit(0).cast("long"), lambda n, x: n + x["__words"]), F.lit(0).cast("long"))
    arr = F.split(F.col("__t"), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(arr) - 1), F.col("__gone")["__pos"])
    cleaned = F.when(F.col("__gone").isNull(), F.col(f"__in_{text_col}")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(arr, i)), "\n"))
    n_words, n_repeat = F.col("__m.n_words"), F.col("__m.n_repeat_words")
    failed = (n_words < min_words) | (100 * n_repeat > max_repeat_percent * n_words)
    results = {**{m: F.col(f"__m.{m}") for m in MEASURES}, "n_boilerplate_words": n_lost, "base_failed": failed,
               "kept": ~failed & (n_words - n_lost >= min_kept * n_words)}
    return (rows.withColumn("__m", measures_column(F.col("__t"))).join(lost, same, "left")
            .select(*[(cleaned if c == text_col else F.col(f"__in_{c}")).alias(c) for c in docs.columns if c not in results],
                    *[v.alias(k) for k, v in results.items()]))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_docs: int = 10, min_chars: int = 20, min_kept: float = 0.5, min_words: int = 50,
                  max_repeat_percent: int = 50) -> DataFrame:
    """One row per document: id, the measures, n_boilerplate_words, base_failed, kept."""
    clean = clean_documents(docs, id_col, text_col, host_col, max_docs, min_chars, min_kept, min_words, max_repeat_percent)
    return clean.select(id_col, *MEASURES, "n_boilerplate_words", "base_failed", "kept")
