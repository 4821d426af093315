"""Line dedup: drop lines whose normalised form stands in too many documents.

Lines are exploded, normalised and hashed (128 bits); the documents of each hash are counted
without repeats; lines of frequent hashes go from every document but the one with the largest
id; the rest is reassembled by position.

Defined cases: a null or empty text is one empty line and comes back as ''; a row without an id
is no document that can be counted and keeps its lines; rows that repeat an id count once, and
each is cleaned; input columns called ``n_lines`` or ``n_dropped`` are replaced; an empty table
gives an empty table.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import cut, hash128, line_key


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with cleaned ``text_col``, ``n_lines`` (before) and ``n_dropped``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a row is known by its id and its text: equal rows hold equal lines at equal positions
    lines = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__text"),
                     F.posexplode(F.split(text, "\n", -1)).alias("__pos", "__line"))
             .withColumn("__key", line_key(F.col("__line")))
             .where(F.char_length("__key") >= min_chars)
             .select("__id", "__text", "__pos", *[h.alias(n) for h, n in zip(hash128(F.col("__key")), ("__h1", "__h2"))]))
    # count(distinct) aggregates by (hash, id) first, so a line of a third of all documents is
    # spread over all tasks and only partial counts meet
    # and written, so that the join below may split a frequent hash or broadcast the measured table
    frequent = cut(lines.groupBy("__h1", "__h2")
                   .agg(F.count_distinct("__id").alias("__n"), F.max("__id").alias("__keeper"))
                   .where(F.col("__n") >= min_docs).drop("__n"), "frequent")
    drops = (lines.join(frequent, ["__h1", "__h2"]).where(F.col("__id") != F.col("__keeper"))
             .groupBy("__id", "__text").agg(F.collect_set("__pos").alias("__drop")))
    # the input row travels as one struct, so its column names cannot clash
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__doc"), F.col(id_col).alias("__doc_id"),
                       text.alias("__whole"), F.xxhash64(text).alias("__doc_text"))
    arr = F.split(F.col("__whole"), "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(arr) - 1), F.col("__drop")),
                       lambda i: F.get(arr, i))
    cleaned = F.when(F.col("__drop").isNull(), F.col("__whole")).otherwise(F.array_join(kept, "\n"))
    return (rows.join(drops, (F.col("__doc_id") == F.col("__id")) & (F.col("__doc_text") == F.col("__text")), "left")
            .select(*[cleaned.alias(c) if c == text_col else F.col("__doc")[c].alias(c)
                      for c in docs.columns if c not in ("n_lines", "n_dropped")],
                    F.size(arr).cast("long").alias("n_lines"),
                    F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped")))
