"""Plain-Python counterparts of the operators, written from their contracts, and small fixtures."""

from __future__ import annotations

import re
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **columns):
    """Documents with ids 0.. from a list of texts; other columns by keyword, as lists."""
    rows = [(i, t, columns.get("lang", {}).get(i, "en"), columns.get("source", {}).get(i, "src0"), None if t is None else len(t))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(UPPER)


def crc(data):
    return zlib.crc32(data)


AWKWARD = [None, "", " ", "\n", "\n\n\n", "\t \x0b\x0c\r", "a", "É ß İ ſ", "x" * 5000, "word " * 20000, "line one is long enough\n" * 50,
           "\U0001F600 emoji \U0001F600", "tab\tand\u00a0nbsp \x1c sep", "<|endoftext|> special", "0" * 64]
