"""Benchmark decontamination: BM25 over an inverted index of the test items, pruned as block-max WAND does.

Items are dealt to length classes (powers of two, in words), and every document is cut into overlapping passages
once per class, as long as two items of the class, so that an item's matches depend neither on the length of
other items nor on the blocks below.  Each passage is a query that retrieves every test item of the class
whose BM25 score reaches ``min_score`` of the item's score for its own text.
Impacts are divided by that limit when the index is built, so the limit is 1 for all items.
Per passage:

1. WAND: if the upper bounds of its terms add up to less than 1, no item can reach the limit;
2. block-max: items stand in blocks, every term has its greatest impact per block, and only blocks
   whose bounds add up to 1 go on;
3. the items of those blocks get their full score.

Retrieved pairs are verified in words: at least ``min_question`` of the five-word shingles of the
question, and at least ``min_answer`` of the words of the answer, stand in the passage.  If the table has no
question and answer columns, an item's last sentence is its answer (none if it is the only one).  A
question of under five words is verified together with its answer, and one of under twenty in shorter shingles (a
quarter of its words), so that one changed word does not hide it.

The item statistics (N, document frequencies, mean length) are computed by Spark over all items.  Items of equal
question and answer are indexed once and joined back to their ids.  The index is built and broadcast in blocks
of about ``block_bytes`` of different items' text each (one item may be larger), so what is broadcast is bounded however many items or
copies there are.  With more than one block the documents are cut into words once and every block reads those.

Words are runs of letters, digits and underscores, lower-cased; a script written without blanks has one word per run, so its
items are found where a whole run agrees.  A text of any length is looked up ``GROUP`` passages at a time.  Defined cases: a null or empty text has no
passage; an item without words is found nowhere; repeated documents and items each give their rows; null ids are carried; an empty
table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import cut

WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.?!][\s\"')]*\s|\n+")
GROUP = 64  # passages looked up at once: bounds the memory of a very long text
MATCH = "array<struct<item_id:bigint,score:double,question:double,answer:double,start:bigint,end:bigint>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence, and the last one; one sentence is all question."""
    ends = [m.end() for m in SENTENCE_END.finditer(text.rstrip())]
    return (text[:ends[-1]], text[ends[-1]:]) if ends else (text, "")


def shingles(words: list[str], size: int) -> set[tuple]:
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if size else set()


def length_class(n_words: int, least: int = 32) -> int:
    """The power of two, ``least`` or more, that ``n_words`` words fit in."""
    return max(least, 1 << max(0, n_words - 1).bit_length())


class Index:
    """Inverted index of the items of one length class in a block, with impacts scaled so that every item's limit is 1."""

    def __init__(self, items: list[tuple], stride: int, n_items: int, mean_length: float, frequency: dict[str, int],
                 min_score: float, shingle: int, block_items: int = 4, k1: float = 1.2, b: float = 0.75):
        self.shingle, self.stride, self.items = shingle, stride, []
        self.vocabulary: dict[str, int] = {}
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for item_id, question, answer in items:
            q, a = words_of(question), words_of(answer)
            words = q + a
            if len(q) < shingle:  # too short to be told from chance: verified as one
                q, a = words, []
            if not words:
                continue
            counts: dict[str, int] = defaultdict(int)
            for w in words:
                counts[w] += 1
            norm = k1 * (1 - b + b * len(words) / mean_length)
            impact = {w: np.log1p((n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (k1 + 1) / (n + norm)
                      for w, n in counts.items()}
            limit = min_score * sum(impact.values())
            at = len(self.items)
            for w, x in impact.items():
                postings[self.vocabulary.setdefault(w, len(self.vocabulary))].append((at, x / limit))
            self.items.append((item_id, shingles(q, min(shingle, max(2, len(q) // 4))), shingles(a, 1)))
        n_terms = len(self.vocabulary)
        self.n_blocks = -(-len(self.items) // block_items)
        self.block_items = block_items
        self.bound = np.zeros(n_terms + 1)  # the last: words outside the index
        blocks_of, items_of = [], []
        for t in range(n_terms):
            at = np.array([p[0] for p in postings[t]], np.int64)
            x = np.array([p[1] for p in postings[t]])
            blocks, where = np.unique(at // block_items, return_inverse=True)
            most = np.zeros(len(blocks))
            np.maximum.at(most, where, x)
            blocks_of.append((blocks, most))
            items_of.append((at, x))
            self.bound[t] = x.max()
        self.blocks, self.postings = _Lists(blocks_of), _Lists(items_of)

    def live_blocks(self, window: np.ndarray, term: np.ndarray, n_windows: int) -> np.ndarray:
        """(window, block) pairs whose bounds reach the limit, as a boolean matrix."""
        bounds = np.bincount(window, self.bound[term], n_windows)
        able = bounds[window] >= 1 - 1e-9  # WAND: the others cannot reach the limit in any block
        at, block, most = self.blocks.gather(term[able])
        sums = np.bincount(window[able][at] * self.n_blocks + block, most, n_windows * self.n_blocks)
        return sums.reshape(n_windows, self.n_blocks) >= 1 - 1e-9

    def scores(self, terms: np.ndarray, live: np.ndarray) -> list[tuple[int, float]]:
        """(item position, score) of the items of live blocks that reach their limit, for distinct ``terms``."""
        _, item, impact = self.postings.gather(terms)
        keep = live[item // self.block_items]
        sums = np.bincount(item[keep], impact[keep], len(self.items))
        return [(int(i), float(sums[i])) for i in np.flatnonzero(sums >= 1 - 1e-9)]

    def matches(self, words: list[str], min_question: float, min_answer: float) -> list[tuple]:
        """Verified matches of the words of a text: per item the best passage (item_id, score, question, answer, start, end)."""
        outside = len(self.vocabulary)
        get = self.vocabulary.get
        terms = np.fromiter((get(w, outside) for w in words), np.int64, len(words))
        # any run of ``stride`` words lies whole in one passage of two strides
        stride = self.stride
        n_passages = max(1, -(-(len(words) - stride) // stride))
        best: dict[int, tuple] = {}
        for first in range(0, n_passages, GROUP):
            many = min(GROUP, n_passages - first)
            part = terms[first * stride:(first + many + 1) * stride]
            place = np.flatnonzero(part < outside)
            chunk = place // stride  # a chunk is the first half of its passage and the second of the one before
            pairs = np.unique(np.concatenate([(c * (outside + 1) + part[place])[(c >= 0) & (c < many)] for c in (chunk, chunk - 1)]))
            window, term = pairs // (outside + 1), pairs % (outside + 1)
            live = self.live_blocks(window, term, many)
            for k in np.flatnonzero(live.any(axis=1)).tolist():
                found = self.scores(term[window == k], live[k])
                if found:
                    start = (first + k) * stride
                    self.verify(words[start:start + 2 * stride], start, found, min_question, min_answer, best)
        return [best[at] for at in sorted(best)]

    def verify(self, passage: list[str], start: int, found: list[tuple[int, float]], min_question: float, min_answer: float,
               best: dict[int, tuple]) -> None:
        """Adds the found items whose question and answer stand in the passage, if better than before."""
        vocabulary, by_size = set(passage), {}
        for at, score in found:
            item_id, question, answer = self.items[at]
            size = len(next(iter(question))) if question else 0
            if size not in by_size:
                by_size[size] = shingles(passage, size)
            q = len(question & by_size[size]) / len(question) if question else 1.0
            a = sum(w[0] in vocabulary for w in answer) / len(answer) if answer else 1.0
            if q >= min_question and a >= min_answer and (at not in best or (q, a, score) > (best[at][2], best[at][3], best[at][1])):
                best[at] = (item_id, score, q, a, start, start + len(passage))


class _Lists:
    """Lists of (number, weight) per term, end to end."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]]):
        self.start = np.concatenate(([0], np.cumsum([len(x) for x, _ in lists]))).astype(np.int64)
        self.number = np.concatenate([np.empty(0, np.int64), *[x for x, _ in lists]])
        self.weight = np.concatenate([np.empty(0), *[w for _, w in lists]])

    def gather(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The lists of ``terms`` end to end: place in ``terms``, number, weight."""
        size = self.start[terms + 1] - self.start[terms]
        at = np.repeat(np.arange(len(terms)), size)
        entry = np.arange(len(at)) - np.repeat(np.cumsum(size) - size - self.start[terms], size)
        return at, self.number[entry], self.weight[entry]


def _matches_column(text: Column, indexes, min_question: float, min_answer: float) -> Column:
    """Matches of a text, or of its words."""
    @F.pandas_udf(MATCH)
    def match(texts: pd.Series) -> pd.Series:
        return pd.Series([[m for index in indexes.value for m in index.matches(words, min_question, min_answer)]
                          for words in (words_of(t) if t is None or isinstance(t, str) else list(t) for t in texts)])

    return match(text)


def _item_texts(items: DataFrame, id_col: str, text_col: str, question_col: str, answer_col: str) -> DataFrame:
    """(item_id, question, answer) of every item."""
    if question_col in items.columns and answer_col in items.columns:
        return items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(question_col, F.lit("")).alias("question"),
                            F.coalesce(answer_col, F.lit("")).alias("answer"))

    @F.pandas_udf("question string, answer string")
    def split(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([question_and_answer(t or "") for t in texts], columns=["question", "answer"])

    return (items.withColumn("__qa", split(F.col(text_col)))
            .select(F.col(id_col).cast("long").alias("item_id"), "__qa.question", "__qa.answer"))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", question_col: str = "question", answer_col: str = "answer", min_score: float = 0.5,
               min_question: float = 0.3, min_answer: float = 0.5, shingle: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """One row per (document, test item) found: id, item_id, score, question, answer (shares found), start, end (in words)."""
    spark = docs.sparkSession

    @F.pandas_udf("array<string>")
    def split_words(texts: pd.Series) -> pd.Series:
        return texts.map(words_of)

    known = cut(_item_texts(items, item_id_col, item_text_col, question_col, answer_col), "items")
    # equal items are one entry of the index; their number counts in the statistics
    entries = cut(known.groupBy("question", "answer").agg(F.count(F.lit(1)).alias("copies"))
                  .withColumn("words", split_words(F.concat_ws("\n", "question", "answer"))).where(F.size("words") > 0)
                  .withColumn("entry", F.monotonically_increasing_id()), "entries")
    n, total, size = entries.agg(F.sum("copies"), F.sum(F.size("words") * F.col("copies")),
                                 F.sum(F.octet_length("question") + F.octet_length("answer"))).first()
    if not n:
        return docs.limit(0).select(F.col(id_col), F.explode(F.expr(f"cast(array() as {MATCH})")).alias("__m")).select(id_col, "__m.*")
    n_blocks = -(-size // block_bytes)
    entries = entries.withColumn("block", F.pmod(F.xxhash64("question", "answer"), F.lit(n_blocks)))
    frequency = cut(entries.select("copies", F.explode(F.array_distinct("words")).alias("word"))
                    .groupBy("word").agg(F.sum("copies").alias("df")), "frequency")
    texts = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    if n_blocks > 1:
        texts = cut(texts.withColumn("__text", split_words("__text")), "words")
    found = []
    for block in range(n_blocks):
        here = entries.where(F.col("block") == block)
        # one block: its texts are about block_bytes, and so are its words
        df = dict(here.select(F.explode("words").alias("word")).distinct().join(frequency, "word").select("word", "df").collect())
        rows = sorted(((r[0], r[1], r[2]) for r in here.select("entry", "question", "answer").collect()), key=lambda r: r[1:])
        by_class = defaultdict(list)
        for row in rows:
            by_class[length_class(len(words_of(row[1])) + len(words_of(row[2])))].append(row)
        indexes = spark.sparkContext.broadcast([Index(by_class[k], k, n, total / n, df, min_score, shingle) for k in sorted(by_class)])
        matches = _matches_column(F.col("__text"), indexes, min_question, min_answer)
        found.append(texts.select(F.col(id_col).alias("__doc"), F.explode(matches).alias("__m")).select("__doc", "__m.*"))
    ids = known.join(entries.select("question", "answer", "entry"), ["question", "answer"]).select(F.col("entry").alias("__entry"), F.col("item_id").alias("__item"))
    return (reduce(DataFrame.unionByName, found).join(ids, F.col("item_id") == F.col("__entry"))
            .select(F.col("__doc").alias(id_col), F.col("__item").alias("item_id"), "score", "question", "answer", "start", "end"))
