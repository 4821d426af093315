"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams (1 to 3 letters, words
padded with a blank).  A document's own list is compared with each profile by the out-of-place
distance: the sum over the document's n-grams of how far the rank is off, or the full list
length where the profile lacks the n-gram.  The smallest distance wins.

Profiles are learnt from a bounded sample of labelled documents (``sample_docs`` per language, in
expectation, chosen by a hash of the id; whole texts).  Everything else covers all rows.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a tie between
languages goes to the first in alphabetical order; with nothing to learn from, every text is
``und``; rows without an id are never learnt from and not held out; input columns called as the
output are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.llm.common import fresh

UNKNOWN = "und"
ORDERS = (1, 2, 3)
CHUNK = 1 << 20


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters as one blank (32), padded."""
    lowered = text.lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = (points >= 97) & (points <= 122)
    other = points > 127
    if other.any():
        known = {p: chr(p).isalpha() for p in np.unique(points[other]).tolist()}
        alpha = np.array(sorted(p for p, ok in known.items() if ok), np.int64)
        is_letter |= np.isin(points, alpha)
    points = np.where(is_letter, points, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first blank after a letter
    return np.concatenate(([32], points[keep], [32] if keep.size and is_letter[-1] else [])).astype(np.int64)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes (21 bits a character) and counts of all n-grams that hold a letter; chunked for long texts."""
    points = _letters(text or "")
    if len(points) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, counts = [], []
    for i in range(0, len(points), CHUNK):
        part = points[i:i + CHUNK + ORDERS[-1] - 1]
        for n in ORDERS:
            size = min(CHUNK, len(points) - i - n + 1)
            if size <= 0:
                continue
            code = part[:size].copy()
            for k in range(1, n):
                code = (code << 21) | part[k:k + size]
            c, m = np.unique(code, return_counts=True)
            codes.append(c)
            counts.append(m)
    codes, where = np.unique(np.concatenate(codes), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)
    real = codes != 32
    return codes[real], counts[real]


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, ties by code."""
    return codes[np.lexsort((codes, -counts))[:size]]


def learn_profiles(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   size: int = 400, sample_docs: int = 2000, max_languages: int = 1000) -> dict[str, np.ndarray]:
    """Profiles of every language among the rows given: at most ``max_languages`` lists of ``size`` codes.

    More languages than that raise: the profiles travel to every task.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    have = {r[0]: r[1] for r in rows.groupBy(lang_col).count().limit(max_languages + 1).collect()}
    if len(have) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages or merge labels")
    if not have:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(have.items()) for x in (lang, min(1.0, sample_docs / n))])
    chance = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id_col)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = rows.where(chance < F.element_at(share, F.col(lang_col))).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                parts = [ngram_counts(t) for t in texts]
                codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes))
                yield pd.DataFrame({"lang": lang, "code": codes, "n": n.astype(np.int64)})

    sums = sample.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    # at most max_languages * size rows come to the driver
    top = sums.withColumn("rank", rank).where(F.col("rank") <= size).collect()
    profiles: dict[str, list] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return {lang: np.array(codes, np.int64) for lang, codes in profiles.items()}


def distances(codes: np.ndarray, sorted_profiles: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Out-of-place distance of a ranked list to each (sorted codes, their ranks), as a share of the worst."""
    ranks = np.arange(len(codes))
    out = []
    for known, known_rank in sorted_profiles:
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        off = np.where(known[at] == codes, np.abs(known_rank[at] - ranks), size)
        out.append(off.sum() / (size * len(codes)))
    return np.array(out)


def classify(text: str | None, languages: list[str], sorted_profiles: list, size: int) -> tuple[str, float]:
    """Language and score: 1 - distance share of the nearest profile."""
    codes, counts = ngram_counts(text)
    if not len(codes) or not languages:
        return UNKNOWN, 0.0
    d = distances(ranked(codes, counts, size), sorted_profiles, size)
    best = int(np.argmin(d))
    return languages[best], float(min(1.0, max(0.0, 1.0 - d[best])))


def language_column(text: Column, profiles: dict[str, np.ndarray], size: int = 400) -> Column:
    """A struct (lang_pred, score) per text."""
    languages = sorted(profiles)
    prepared = [(np.sort(profiles[x]), np.argsort(profiles[x], kind="stable")) for x in languages]

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([classify(t, languages, prepared, size) for t in texts], columns=["lang_pred", "score"])

    return identify(text)


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       size: int = 400, sample_docs: int = 2000) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``; learnt from the rows that are not held out."""
    profiles = learn_profiles(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col, size, sample_docs)
    out = ("held_out", "lang_pred", "score")
    lang = fresh(docs, "__lang")
    return (docs.withColumn(lang, language_column(F.col(text_col), profiles, size))
            .select(*[c for c in docs.columns if c not in out], held_out(F.col(id_col)).alias("held_out"),
                    F.col(lang)["lang_pred"].alias("lang_pred"), F.col(lang)["score"].alias("score")))
