"""Every operator over awkward texts: columns that carry its own names, repeated rows and empty tables."""

from __future__ import annotations

import inspect
import re
from collections import Counter, defaultdict

import pytest
from helpers import AWKWARD, crc, documents
from pyspark.sql import functions as F

from recordforge.llm import (collocations, common, decontaminate, language_id, line_dedup, multi_index, packing, quality_rules, queries,
                             secrets, sharding, simhash, tool_calls, url_filter, vectors, whitening)
from recordforge.llm.common import table

SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"

PLAIN = ["The quick brown fox jumps over the lazy dog and runs away from it\nthis line stands in several documents"] * 4
VECTORS = [[1.0, 2.0, 3.0], [3.0, 1.0, 2.0], [2.5, 2.5, 0.5], [0.0, 0.0, 0.0], [], [1.0, float("nan"), 0.0], [1.0, 2.0, 3.0], None]


def texts(spark):
    docs = documents(spark, AWKWARD + PLAIN)
    return docs.unionByName(docs.where("doc_id in (3, 16)"))


def pages(spark):
    link = '<a href="http://b.example.net/x">b</a>'
    rows = [(i, u, link) for i, u in enumerate([*AWKWARD, "http://Example.org/es/a", "http://fr.com/fr/?q", "http://b.example.net", "://"])]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def messages(spark):
    said = [*AWKWARD, '{"tool_calls": [{"id": "a", "name": "search", "arguments": {"query": "x"}}]}', "{", "[]"]
    return spark.createDataFrame([(i // 3, i % 3, "assistant", t) for i, t in enumerate(said)], "conv_id long, turn int, role string, text string")


def embeddings(spark):
    return spark.createDataFrame(list(enumerate(VECTORS)), "vec_id long, embedding array<double>")


#: name: (input, operator, modules whose column names the clashing columns take)
OPERATORS = {
    "decontamination": (texts, lambda d: decontaminate.find_leaks(d, table(d.sparkSession, SMALL, "benchmark")), [decontaminate]),
    "line_dedup": (texts, line_dedup.dedup_lines, [line_dedup]),
    "secret_scan": (texts, secrets.find_secrets, [secrets]),
    "simhash": (texts, simhash.near_duplicates, [simhash]),
    "url_filter": (pages, lambda d: url_filter.judge_urls(d, queries.URL_RULES), [url_filter]),
    "quality_rules": (texts, quality_rules.clean_documents, [quality_rules]),
    "language_id": (texts, language_id.identify_languages, [language_id]),
    "packing": (texts, lambda d: packing.pack(d, queries.tokenizer_path()), [packing]),
    "tool_calls": (messages, lambda d: tool_calls.link_tool_calls(d, queries.TOOL_SCHEMAS), [tool_calls]),
    "sharding": (texts, sharding.shard_by_bytes, [sharding]),
    "collocations": (texts, lambda d: collocations.mine_phrases(d, min_count=2), [collocations]),
    "nearest_neighbours": (embeddings, multi_index.nearest_neighbours, [multi_index, vectors]),
    "whitening": (embeddings, whitening.whiten, [whitening, vectors]),
}
#: columns that name a place, which may differ between runs on equal rows
FREE = {"sequence_id", "offset", "slot", "shard"}


def rows(df, columns):
    return sorted(map(repr, df.select(*[c for c in columns if c not in FREE]).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_and_empty_table(spark, name):
    make, operator, modules = OPERATORS[name]
    plain = make(spark)
    result = operator(plain)
    own = {x for m in [*modules, common] for x in re.findall(r'["(.](__\w+)', inspect.getsource(m))} | set(result.columns)
    taken = {c.lower() for c in plain.columns}
    clash = {c.lower(): c for c in sorted(own) if c.lower() not in taken}
    crowded = plain.withColumns({c: F.lit("clash") for c in clash.values()})
    assert len(clash) > 3 and rows(operator(crowded), result.columns) == rows(result, result.columns)
    nothing = operator(plain.limit(0))
    assert nothing.schema.simpleString() == result.schema.simpleString() and nothing.count() == 0


# ---- language ID: the whole query

def brute_grams(text):
    """1- to 3-grams of the letters, runs of other characters as one blank, a blank at both ends."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = f" {' '.join(words)} " if words else ""
    return Counter(g for n in (1, 2, 3) for g in (line[i:i + n] for i in range(len(line) - n + 1)) if g != " ")


def brute_top(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]


def test_language_query_matches_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang").collect()
    assert len(docs) < 2000  # below the sample's bound every labelled row is learnt from
    grams = {r["doc_id"]: brute_grams(r["text"]) for r in docs}
    learnt = defaultdict(Counter)
    for r in docs:
        if r["lang"] is not None and crc(str(r["doc_id"]).encode()) % 3 != 1:
            learnt[r["lang"]].update(grams[r["doc_id"]])
    size = 400
    profiles = {lang: {g: i for i, g in enumerate(brute_top(c, size))} for lang, c in learnt.items()}
    want = {}
    for r in docs:
        own = brute_top(grams[r["doc_id"]], size)
        far = {lang: sum(abs(known[g] - i) if g in known else size for i, g in enumerate(own)) for lang, known in profiles.items()}
        best = min(sorted(far), key=far.get) if own else "und"
        want[r["doc_id"]] = (best, 1 - far[best] / (size * len(own)) if own else 0.0)
    got = queries.op7_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(max(0.0, score), abs=1e-12)
