"""Best-fit packing of tokenized documents by linear grouping.

Documents become token ids; those longer than a sequence are cut into full pieces and a rest.
Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver, where

1. lengths over ``capacity / 3`` are sorted, split into groups of equal cardinality, and every group is
   rounded up to its longest length,
2. the few sizes are packed by configurations: the linear programme over all ways to fill a sequence, solved by
   column generation (a knapsack finds the next configuration), rounded down,
3. the actual lengths take the rounded ones' places, and
4. what is left over, and all small pieces, go best-fit by decreasing length.

All four work on runs of equal lengths, so the plan is a bounded table of rules "the k-th piece of
length l goes there"; Spark ranks the pieces of each length and joins the rules.  No piece, text or
token passes the driver.

Defined cases: a null or empty text is the end id alone; repeated rows are packed one by one; rows without an id are packed like any
other; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import warnings
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import cut, with_rank

PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint,ids:binary>>"
CACHE_PARTS, CACHE_WORDS, CACHE_LENGTH = 400_000, 200_000, 64  # under 300 MB a task with both generations full

#: the tokenizer's own word pattern, over lower-cased text of the characters of ``UNUSUAL``'s complement
WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: characters whose normal form or class may need more than ``str.lower``: anything but ASCII and the Latin letters up to U+024F
UNUSUAL = re.compile("[^ -~\u00a1-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u024f]|<\\|")


_tokenizers: dict = {}

#: fixed values: the normaliser and pre-tokenizer that ``WORD``, ``UNUSUAL`` and the split at blanks are the short form of
KNOWN_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
KNOWN_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def splits_as_known(tokenizer) -> bool:
    """True if the tokenizer prepares texts as this module's short cut does; others encode whole texts."""
    spec = json.loads(tokenizer.to_str())
    return (spec["normalizer"] == KNOWN_NORMALIZER and spec["pre_tokenizer"] == KNOWN_PRE_TOKENIZER
            and all(t["content"].startswith("<|") for t in spec["added_tokens"]))


class WordCache:
    """Ids of a text, part by part: the tokenizer never joins characters across a blank, so the ids
    of a text are those of its space-separated parts, and those of a part are those of its words.
    Frequent parts and words are looked up; a part with an unusual character goes to the tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        if path not in _tokenizers:  # the bare tokenizer stays with the worker
            tokenizer = Tokenizer.from_file(path)
            _tokenizers[path] = tokenizer, splits_as_known(tokenizer)
        self.tokenizer, self.known = _tokenizers[path]
        self.model = self.tokenizer.model
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # two generations each: a full one becomes the old one, so that frequent entries survive
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.old_words.get(word)
            if found is None:
                letters = word if word.isascii() else self.letters.pre_tokenize_str(word)[0][0]
                found = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(word) <= CACHE_LENGTH:
                if len(self.words) >= CACHE_WORDS:
                    self.old_words, self.words = self.words, {}
                self.words[word] = found
        return found

    def part(self, part: str) -> bytes:
        """Ids of a part of lower-cased usual characters."""
        found = self.old_parts.get(part)
        if found is None:
            get, word = self.words.get, self.word
            found = b"".join([get(w) or word(w) for w in WORD.findall(part)])
        if len(part) <= CACHE_LENGTH:
            if len(self.parts) >= CACHE_PARTS:
                self.old_parts, self.parts = self.parts, {}
            self.parts[part] = found
        return found

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.known:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.replace("\n", " ")
        if UNUSUAL.search(text):  # part by part: only the unusual ones need the whole tokenizer
            return b"".join([array("I", self.tokenizer.encode(p, add_special_tokens=False).ids).tobytes() if UNUSUAL.search(p)
                             else self.part(p.lower()) for p in text.split(" ")])
        parts = text.lower().split(" ")
        found = list(map(self.parts.get, parts))
        if None in found:
            found = [self.part(p) if f is None else f for p, f in zip(parts, found)]
        return b"".join(found)


def pieces_of(ids: bytes, capacity: int, keep_ids: bool) -> list[tuple]:
    out = []
    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at:at + 4 * capacity]
        out.append((k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
    return out


def pieces_column(text: Column, tokenizer_path: str, capacity: int, end_id: int, keep_ids: bool) -> Column:
    end = np.array([end_id], "<u4").tobytes()

    @F.pandas_udf(PIECE)
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        words = WordCache(tokenizer_path)  # per task, so that a reused worker holds no cache in between
        for texts in batches:
            yield pd.Series([pieces_of((words.ids(t) if t else b"") + end, capacity, keep_ids) for t in texts])

    return tokenize(text)


def _best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits the capacity (integer knapsack)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int16)
    for i, (size, value) in enumerate(zip(sizes, values)):
        if value <= 0:
            continue
        base = best.copy()
        for k in range(1, capacity // size + 1):
            gain = base[:capacity + 1 - k * size] + k * value
            better = gain > best[k * size:] + 1e-12
            best[k * size:][better] = gain[better]
            taken[i, k * size:][better] = k
    pattern, room = np.zeros(len(sizes)), capacity
    for i in reversed(range(len(sizes))):
        pattern[i] = taken[i, room]
        room -= int(pattern[i]) * sizes[i]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """(pattern, times): the linear programme's configurations, rounded down.

    Pivots until no pattern is worth more than its price, i.e. to the optimum.  If ``rounds`` pivots do not get there, the
    configurations found so far are used (they pack everything all the same) and a warning names the gap.
    """
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(rounds):
        amounts = np.linalg.solve(basis, need)
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, pattern = _best_pattern(sizes, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, pattern)
        ratio = np.where(change > 1e-9, np.maximum(amounts, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = pattern
    else:
        total = float(np.linalg.solve(basis, need).sum())
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, _ = _best_pattern(sizes, prices, capacity)
        # prices / worth are feasible for the dual programme, which bounds the optimum from below
        warnings.warn(f"{rounds} pivots: {total:.1f} sequences planned, the optimum is at least {total / max(1.0, worth):.1f}", stacklevel=2)
    amounts = np.linalg.solve(basis, need)
    return [(basis[:, i].astype(int), int(np.floor(a + 1e-6))) for i, a in enumerate(amounts) if a >= 1 - 1e-6]


class Plan:
    """Rules (length, first rank, count, per sequence, first sequence, offset) and open sequences."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(histogram)
        self.next_rank: dict[int, int] = defaultdict(int)
        self.rules: list[tuple] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> [(first sequence, how many)]
        self.rooms: list[int] = []  # sorted

    def put(self, length: int, count: int, each: int, first: int, offset: int) -> None:
        self.rules.append((length, self.next_rank[length], count, each, first, offset))
        self.next_rank[length] += count
        self.left[length] -= count

    def leave_open(self, room: int, first: int, many: int) -> None:
        if room > 0 and many > 0:
            if not self.open[room]:
                bisect.insort(self.rooms, room)
            self.open[room].append((first, many))

    def take_open(self, length: int) -> tuple[int, int, int] | None:
        """Sequences with the least room that holds ``length``."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, many = self.open[room].pop()
        if not self.open[room]:
            self.rooms.pop(at)
        return room, first, many

    def best_fit(self, length: int) -> None:
        while self.left[length] > 0:
            found = self.take_open(length)
            if found is None:
                many = -(-self.left[length] // (self.capacity // length))
                found = (self.capacity, self.sequences, many)
                self.sequences += many
            room, first, many = found
            each, count = room // length, self.left[length]
            full = min(many, count // each)
            if full:
                self.put(length, full * each, each, first, self.capacity - room)
                self.leave_open(room - each * length, first, full)
            rest = self.left[length] if full < many else 0
            if rest:  # fewer than a sequence takes
                self.put(length, rest, rest, first + full, self.capacity - room)
                self.leave_open(room - rest * length, first + full, 1)
                full += 1
            self.leave_open(room, first + full, many - full)

    def fill(self, pattern: np.ndarray, times: int, groups: list[list[list[int]]]) -> None:
        """``times`` sequences of a configuration: each place takes actual lengths of its group, in order."""
        blocks = [(self.sequences, times, 0)]
        self.sequences += times
        for group, copies in zip(groups, pattern):
            for _ in range(copies):
                after = []
                for first, many, used in blocks:
                    while many and group:
                        length, have = group[0]
                        n = min(many, have)
                        self.put(length, n, 1, first, used)
                        after.append((first, n, used + length))
                        first, many = first + n, many - n
                        group[0][1] -= n
                        if not group[0][1]:
                            group.pop(0)
                    if many:  # the group is used up: the place stays free
                        after.append((first, many, used))
                blocks = after
        for first, many, used in blocks:
            self.leave_open(self.capacity - used, first, many)


def plan_packing(histogram: dict[int, int], capacity: int, n_groups: int = 192, large: int = 3) -> tuple[list[tuple], int]:
    """Rules for every length of the histogram, and the number of sequences."""
    plan = Plan(histogram, capacity)
    longs = sorted((n for n in histogram if capacity // large < n < capacity), reverse=True)
    total = sum(histogram[n] for n in longs)
    if total:
        per_group = -(-total // min(n_groups, total))
        groups: list[list[list[int]]] = [[]]
        room = per_group
        for length in longs:
            have = histogram[length]
            while have:
                if not room:
                    groups.append([])
                    room = per_group
                n = min(room, have)
                groups[-1].append([length, n])
                room, have = room - n, have - n
        by_size: dict[int, list] = {}  # groups rounded to the same size are one size
        for g in groups:
            by_size.setdefault(g[0][0], []).extend(g)
        sizes = list(by_size)
        demand = [sum(n for _, n in by_size[s]) for s in sizes]
        queues = [[list(run) for run in by_size[s]] for s in sizes]
        for pattern, times in configurations(sizes, demand, capacity):
            plan.fill(pattern, times, queues)
    for length in sorted(histogram, reverse=True):
        plan.best_fit(length)
    return plan.rules, plan.sequences


RULE = "length long, __from long, __count long, __each long, __first long, __offset long"


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
         end_id: int = 1, n_groups: int = 192, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids`` if kept)."""
    spark = docs.sparkSession
    pieces = cut(docs.select(F.col(id_col).alias("__id"), F.explode(pieces_column(
        F.col(text_col), tokenizer_path, capacity, end_id, keep_ids)).alias("__p")).select("__id", "__p.*"), "pieces")
    if not keep_ids:
        pieces = pieces.drop("ids")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    rules, _ = plan_packing(histogram, capacity, n_groups)
    rules = spark.createDataFrame(rules, RULE) if rules else spark.createDataFrame([], RULE)
    ranked = with_rank(pieces, ["length"], ["__id", "piece", "start", "ids_crc32"], name="lengths")
    step = F.col("__rank") - F.col("__from")
    # the rules are bounded by the number of lengths and configurations, not by the documents
    return (ranked.join(F.broadcast(rules.withColumnRenamed("length", "__length")),
                        (F.col("length") == F.col("__length")) & step.between(0, F.col("__count") - 1))
            .select(F.col("__id").alias(id_col), "piece", "start", "length", "ids_crc32",
                    (F.col("__first") + F.floor(step / F.col("__each"))).cast("long").alias("sequence_id"),
                    (F.col("__offset") + (step % F.col("__each")) * F.col("length")).cast("long").alias("offset"),
                    *(["ids"] if keep_ids else [])))
