"""Phrase collocation mining with stripes.

A stripe is the counter of the words that follow one prefix.  Tasks build stripes for their texts and pass them on as
one row per prefix and block of next words; rows of one prefix and block meet in one task, which merges
them elementwise.  Everything comes out of the merged stripes: their entries are the phrases one word longer than
the prefix, the entry without a next word is the prefix's total, and the largest entry of a stripe (and, by the last words of
its phrases, of the stripes before it) is the longer phrase that may subsume the prefix.  A stripe is cut into ``BLOCKS``
blocks by a hash of the next word, so the stripe of a very common prefix meets in no single task.

Two rounds: prefixes of no and one word first; then longer ones, only where every pair of neighbouring words of the phrase is
frequent, as each part of a frequent phrase is.  Which pairs are is told to the tasks by a bit filter of fixed size
(``FILTER_BITS``): pairs it lets through by chance cost work, not correctness, as counts stay exact.

Phrases stay within pieces (texts cut at ``.,;:!?`` and line ends) and are counted per language.  A candidate of up to
``max_words`` words stands at least ``min_count`` times; its score is that of its weakest cut.

Defined cases: a null language is ``und``; a null or empty text has no words; repeated rows count each; a text of any
length is counted in chunks that overlap by the words of one phrase; equal scores and counts are ordered by the
phrase's bytes; an empty table gives an empty table; only language and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.llm.common import cut, partitions

UNKNOWN = "und"
#: bytes that end a piece, and the token that stands for any of them
BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"."
_TO_BREAK = bytes.maketrans(BREAKS, BREAK * len(BREAKS))
_GAP = re.compile(rb"[ \t.]")
BLOCKS = 8
FILTER_BITS = 1 << 26
#: words counted at once by a task, and bytes of a text split at once
CHUNK_WORDS = 1 << 21
SLICE_BYTES = 1 << 22
STRIPE = "lang string, prefix string, block int, words array<string>, counts array<long>"


# -- inside a task ------------------------------------------------------------------------------

def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two words from their hashes; the order counts."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + ((second << np.uint64(31)) | (second >> np.uint64(33)))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, zlib.crc32(lang.encode()))


def _filter_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(h % np.uint64(bits)).astype(np.int64) for h in (hashes, (hashes >> np.uint64(20)) * np.uint64(0x94D049BB133111EB))]


class Chunk:
    """Word numbers of a run of texts; 0 ends a piece.  Words of different languages have different numbers."""

    def __init__(self) -> None:
        self.number = itertools.count(1)
        self.vocabulary: dict[str, defaultdict] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.carry = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        known = self.vocabulary.get(lang)
        if known is None:
            known = self.vocabulary[lang] = defaultdict(self.number.__next__)
            known[BREAK] = 0
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.parts.append(ids)
        self.size += len(ids)


def _chunks(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[Chunk]:
    """Chunks of about ``CHUNK_WORDS`` words.  A text that goes on in the next chunk leaves it its last ``overlap`` words."""
    chunk = Chunk()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole, start = memoryview(text.as_buffer()), 0
            tail: list[bytes] = []
            while start < len(whole):
                end = start + SLICE_BYTES
                piece = bytes(whole[start:end]).lower().translate(_TO_BREAK)
                if end < len(whole):  # go on to the end of the word
                    rest = bytes(whole[end:end + SLICE_BYTES]).lower().translate(_TO_BREAK)
                    gap = _GAP.search(rest)
                    while gap is None and end + len(rest) < len(whole):
                        rest += bytes(whole[end + len(rest):end + len(rest) + SLICE_BYTES]).lower().translate(_TO_BREAK)
                        gap = _GAP.search(rest)
                    word_end = gap.start() if gap else len(rest)
                    piece, end = piece + rest[:word_end], end + word_end
                start = end
                words = piece.replace(BREAK, b" . ").split()
                chunk.add(lang, words)
                tail = [*tail, *words[-overlap:]][-overlap:]
                if chunk.size >= CHUNK_WORDS and start < len(whole):
                    yield chunk
                    chunk = Chunk()
                    chunk.add(lang, tail)
                    chunk.carry = len(tail)
            chunk.parts.append(np.zeros(1, np.int64))
            chunk.size += 1
            if chunk.size >= CHUNK_WORDS:
                yield chunk
                chunk = Chunk()
    if chunk.size:
        yield chunk


class Counter:
    """Counts of the phrases of one chunk, by length."""

    def __init__(self, chunk: Chunk) -> None:
        self.ids = np.concatenate(chunk.parts)
        self.carry = chunk.carry
        pairs = [(n, w, lang) for lang, known in chunk.vocabulary.items() for w, n in known.items() if n]
        pairs.sort()
        words = [BREAK, *(w for _, w, _ in pairs)]
        langs = ["", *(x for _, _, x in pairs)]
        self.words, self.langs = pa.array(words, pa.binary()).cast(pa.string()), pa.array(langs, pa.string())
        self.lang_names = list(dict.fromkeys(langs))
        code = {x: k for k, x in enumerate(self.lang_names)}
        self.lang_codes = np.array([code[x] for x in langs])
        self.hashes = np.array([_word_hash(x, w) for x, w in zip(langs, words)], np.uint64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions that start a phrase of two words, the number of each one's phrase, and the phrases' keys."""
        ids = self.ids
        at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        code, keys = pd.factorize(ids[at] * len(self.words) + ids[at + 1])
        return at, code, keys

    def counts(self, at: np.ndarray, code: np.ndarray, length: int, n: int) -> np.ndarray:
        """Phrases counted, without those that lie wholly in what the chunk before has counted."""
        return np.bincount(code[at + length > self.carry] if self.carry else code, minlength=n)

    def stripes(self, prefix: list[np.ndarray], following: np.ndarray, counts: np.ndarray, prefix_code: np.ndarray) -> pa.RecordBatch | None:
        """Rows of stripes from phrases: the word numbers of their prefix, their last word and count."""
        held = np.flatnonzero(counts > 0)
        if not len(held):
            return None
        block = (self.hashes[following[held]] % np.uint64(BLOCKS)).astype(np.int64)
        group = prefix_code[held].astype(np.int64) * BLOCKS + block
        order = np.argsort(group, kind="stable")
        held, group = held[order], group[order]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        offsets = pa.array(np.r_[starts, len(held)].astype(np.int32))
        lead = [self.words.take(pa.array(p[held[starts]])) for p in prefix]
        return pa.RecordBatch.from_arrays([
            self.langs.take(pa.array(prefix[0][held[starts]])),
            pc.binary_join_element_wise(*lead, " ") if len(lead) > 1 else lead[0],
            pa.array((group[starts] % BLOCKS).astype(np.int32)),
            pa.ListArray.from_arrays(offsets, self.words.take(pa.array(following[held]))),
            pa.ListArray.from_arrays(offsets, pa.array(counts[held].astype(np.int64))),
        ], ["lang", "prefix", "block", "words", "counts"])

    def totals(self) -> Iterator[pa.RecordBatch]:
        """The entry without a next word: of each one-word prefix its count, of the empty prefix the language's words."""
        each = np.bincount(self.ids[self.carry:], minlength=len(self.words))
        each[0] = 0
        per_lang = np.bincount(self.lang_codes, each, len(self.lang_names)).astype(np.int64)
        held = np.flatnonzero(each)
        for langs, prefixes, counts in ((self.langs.take(pa.array(held)), self.words.take(pa.array(held)), each[held]),
                                        (pa.array(self.lang_names), pa.array([""] * len(self.lang_names)), per_lang)):
            ends = pa.array(np.arange(len(counts) + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([
                langs, prefixes, pa.array(np.zeros(len(counts), np.int32)),
                pa.ListArray.from_arrays(ends, pa.nulls(len(counts), pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int64))),
            ], ["lang", "prefix", "block", "words", "counts"])


def _short_stripes(max_words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, max_words - 1):
            c = Counter(chunk)
            yield from c.totals()
            at, code, keys = c.pairs()
            size = len(c.words)
            rows = c.stripes([keys // size], keys % size, c.counts(at, code, 2, len(keys)), keys // size)
            if rows is not None:
                yield rows
    return build


def _long_stripes(max_words: int, frequent, bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(frequent.value, np.uint8)
        for chunk in _chunks(batches, max_words - 1):
            c = Counter(chunk)
            size = len(c.words)
            at, code, keys = c.pairs()
            first, second = keys // size, keys % size
            passes = np.ones(len(keys), bool)
            for place in _filter_places(_mixed(c.hashes[first], c.hashes[second]), bits):
                passes &= (seen[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            # number + 1 of the phrase that starts at a position, 0 for none
            pair_at = np.zeros(len(c.ids) + 1, np.int64)
            pair_at[at] = np.where(passes[code], code + 1, 0)
            phrase_at, parts = pair_at, [first, second]
            for length in range(3, max_words + 1):
                at = np.flatnonzero((phrase_at[:-length + 1] > 0) & (pair_at[length - 2:-1] > 0))
                code, keys = pd.factorize((phrase_at[at] - 1) * size + c.ids[at + length - 1])
                prefix_code, following = keys // size, keys % size
                prefix = [p[prefix_code] for p in parts]
                rows = c.stripes(prefix, following, c.counts(at, code, length, len(keys)), prefix_code)
                if rows is not None:
                    yield rows
                phrase_at = np.zeros(len(c.ids) + 1, np.int64)
                phrase_at[at] = code + 1
                parts = [*prefix, following]
    return build


# -- over the table -----------------------------------------------------------------------------

def _merged(stripes: DataFrame, min_count: int) -> DataFrame:
    """Stripes merged elementwise: (lang, prefix, word, n), entries of at least ``min_count``, and the totals of all languages.

    The rows of one prefix and block meet once; the elementwise sum needs no further shuffle.
    """
    # dealt by the columns the aggregate groups by first, so that it needs no exchange of its own
    dealt = stripes.repartition(partitions(stripes.sparkSession), "lang", "prefix", "block")
    return (dealt.select("lang", "prefix", "block", F.inline(F.arrays_zip("words", "counts")))
            .groupBy("lang", "prefix", "block", F.col("words").alias("word")).agg(F.sum("counts").alias("n"))
            .where((F.col("n") >= min_count) | (F.col("prefix") == "")).drop("block"))


def _pair_filter(pairs: DataFrame, bits: int) -> bytes:
    """A bit filter of the given pairs (lang, prefix, word); ``bits`` bits whatever the number of pairs."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                lang, first, second = (b.column(k).to_pylist() for k in range(3))
                h1 = np.array([_word_hash(x, w.encode()) for x, w in zip(lang, first)], np.uint64)
                h2 = np.array([_word_hash(x, w.encode()) for x, w in zip(lang, second)], np.uint64)
                at = np.unique(np.concatenate(_filter_places(_mixed(h1, h2), bits)))
                yield pa.RecordBatch.from_arrays([pa.array((at >> 5).astype(np.int32)), pa.array(1 << (at & 31))], ["slot", "bits"])

    slots = (pairs.select("lang", "prefix", "word").mapInArrow(place, "slot int, bits long")
             .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow())  # at most bits / 32 rows
    out = np.zeros(bits // 32, "<u4")
    out[slots["slot"].to_numpy()] = slots["bits"].to_numpy().astype(np.uint32)
    return out.tobytes()


def _whole(col: Column) -> Column:
    """Room for products beyond 64 bits."""
    return col.cast("decimal(20,0)")


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 4, min_count: int = 30,
                 top: int = 2000, weight: int = 2_000_000, subsumed_percent: int = 80, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's ``top`` phrases.

    ``max_words`` is at least 2.
    """
    spark = docs.sparkSession
    texts = (docs.where(F.octet_length(text_col) > 0)
             .select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("binary").alias("text")))
    short = cut(_merged(texts.mapInArrow(_short_stripes(max_words), STRIPE), min_count), "short-stripes")
    pairs = short.where(F.col("word").isNotNull())
    phrase = F.concat_ws(" ", "prefix", "word").alias("phrase")
    found = pairs.select("lang", phrase, F.col("n").alias("f"))
    if max_words > 2:
        frequent = spark.sparkContext.broadcast(_pair_filter(pairs, filter_bits))
        longer = cut(_merged(texts.mapInArrow(_long_stripes(max_words, frequent, filter_bits), STRIPE), min_count), "long-stripes")
        found = found.unionByName(longer.select("lang", phrase, F.col("n").alias("f")))
    words = short.where(F.col("word").isNull() & (F.col("prefix") != "")).select("lang", F.col("prefix").alias("phrase"), F.col("n").alias("f"))
    size = short.where(F.col("prefix") == "").select("lang", "n")
    # counts of all frequent phrases and words; written, so that very common parts can be split below
    counts = cut(found.unionByName(words), "phrases")
    found = counts.where(F.instr("phrase", " ") > 0)

    # the largest count of a phrase one word longer, at either end; a longer one that holds the phrase is in one of those
    shorter = F.array(F.expr("substring_index(phrase, ' ', size(split(phrase, ' ')) - 1)"), F.expr("substr(phrase, instr(phrase, ' ') + 1)"))
    around = found.select("lang", F.explode(shorter).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    alone = (found.join(cut(around, "longer"), ["lang", "phrase"], "left")
             .where(F.coalesce(_whole(F.col("most")) * 100 < _whole(F.col("f")) * subsumed_percent, F.lit(True))))

    # every cut of every phrase left, with the counts of both its parts
    parts = F.split("phrase", " ")
    cuts = (alone.select("lang", "phrase", F.col("f").alias("a"), parts.alias("w"),
                         F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest")))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    cuts = (cuts.join(known.select("lang", F.col("part").alias("first"), F.col("count").alias("l")), ["lang", "first"])
            .join(known.select("lang", F.col("part").alias("rest"), F.col("count").alias("r")), ["lang", "rest"]))
    scored = cuts.withColumn("score", F.expr(f"cast(cast(a as decimal(20,0)) * {weight} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w")).select(
        "lang", "phrase", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), F.col("w.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
