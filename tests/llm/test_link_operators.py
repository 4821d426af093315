"""SimHash, decontamination, URL filter, tool calls and the pipeline against plain Python."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict

import xxhash
from helpers import AWKWARD, documents, lower, words
from pyspark.sql import functions as F

import corpus_pipeline
from recordforge.llm import common, decontaminate, queries, simhash, tool_calls, url_filter
from recordforge.llm.common import table

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


# ---- SimHash

def brute_print(text):
    w = words(lower(text))
    grams = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Union of all pairs within 4 bits: list of (id, fingerprint) to {position: smallest id}."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 4:
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return [(i, f"{p:016x}", low.get(find(k))) for k, (i, p) in enumerate(prints)]


def test_fingerprints_match_brute_force(spark):
    for text in [*AWKWARD, "one two three", "a b c d e", "A É b c d e f g h i j " * 9]:
        assert simhash.fingerprint(text) == brute_print(text)
    # the same hash as Spark's own
    assert spark.sql("select xxhash64('héllo wörld')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest("héllo wörld".encode(), 42)


def test_simhash_query(spark):
    prints = [(r["doc_id"], brute_print(r["text"])) for r in table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, queries.op4_simhash_dedup(spark, SF).collect())) == sorted(brute_components(prints))


def test_links_are_complete_for_dense_and_chained_fingerprints(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(12):  # a cloud around a centre: members up to 10 bits apart
        centre = rng.getrandbits(64)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    chain = rng.getrandbits(64)
    for k in range(15):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        prints.add(chain)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p, 1 + k % 3) for k, p in enumerate(signed)], "__fp long, __docs long")
    got = defaultdict(set)
    for r in simhash.link_fingerprints(nodes).collect():
        got[r["__root"]].add(r["__fp"] % (1 << 64))
    want = defaultdict(set)
    for (i, _, low), p in zip(brute_components(list(enumerate(prints))), prints):
        want[low].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_simhash_edge_cases(spark):
    docs = documents(spark, AWKWARD)
    docs = docs.unionByName(docs.where("doc_id = 8")).unionByName(spark.createDataFrame([(None, "x" * 5000, "en", "s", 1)], docs.schema))
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == sorted(brute_components(rows), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# ---- decontamination

def brute_leaks(docs, items, min_score=0.5, min_question=0.3, min_answer=0.5):
    """Every passage against every item with a plain BM25 sum."""
    from math import log1p

    parts = []
    for i, t in items:
        q, a = decontaminate.question_and_answer(t or "")
        parts.append((i, decontaminate.words_of(q), decontaminate.words_of(a)))
    parts = [p for p in parts if p[1] + p[2]]
    n, mean = len(parts), sum(len(q + a) for _, q, a in parts) / max(1, len(parts))
    df = defaultdict(int)
    for _, q, a in parts:
        for w in set(q + a):
            df[w] += 1
    out = set()
    stride = max(32, max((len(q + a) for _, q, a in parts), default=0))
    for d, t in docs:
        w = decontaminate.words_of(t)
        for s in range(0, max(1, len(w) - stride), stride):
            passage = w[s:s + 2 * stride]
            for i, q, a in parts:
                words_here = q + a
                norm = 1.2 * (0.25 + 0.75 * len(words_here) / mean)
                score = {x: log1p((n - df[x] + 0.5) / (df[x] + 0.5)) * words_here.count(x) * 2.2 / (words_here.count(x) + norm)
                         for x in set(words_here)}
                if sum(score[x] for x in set(passage) & set(score)) < (min_score - 1e-9) * sum(score.values()):
                    continue
                if len(q) < 5:
                    q, a = words_here, []
                k = min(len(q), 5, max(2, len(q) // 4))
                grams = {tuple(q[j:j + k]) for j in range(len(q) - k + 1)} if k else set()
                here = {tuple(passage[j:j + k]) for j in range(len(passage) - k + 1)} if k else set()
                if (not grams or len(grams & here) >= min_question * len(grams)) and (
                        not a or len(set(a) & set(passage)) >= min_answer * len(set(a))):
                    out.add((d, i))
    return out


def test_leaks_match_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    got = queries.op1_decontamination(spark, SMALL).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_leaks(docs, items) and got
    blocks = decontaminate.find_leaks(table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark"), block_bytes=2000)
    assert sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in blocks.collect()) == sorted(
        (r["doc_id"], r["item_id"], round(r["score"], 9)) for r in got)


def test_planted_passages_are_found_and_others_left(spark):
    items = table(spark, SF, "benchmark")
    texts = [r["text"] for r in items.orderBy("item_id").collect()]
    filler = " ".join(f"unrelated{k}" for k in range(300))
    planted = [f"{filler} {t} {filler}" for t in texts] + [t.upper().replace(" ", "  ") for t in texts]
    edited = []
    for t in texts:
        w = t.split()
        w[len(w) // 3] = "changed"
        edited.append(" ".join(w))
    clean = [filler] + [" ".join(reversed(t.split())) for t in texts]
    docs = documents(spark, planted + edited + clean)
    found = {r["doc_id"] for r in decontaminate.find_leaks(docs, items).collect()}
    assert found >= set(range(len(planted) + len(edited)))
    assert not found & set(range(len(planted) + len(edited), len(planted + edited + clean)))


def test_a_long_item_changes_no_match_of_the_others(spark):
    rng = random.Random(6)
    some = lambda n: " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))
    short = [(k, f"{some(8)}.", some(6)) for k in range(30)]
    long = (99, " ".join(f"long{k}" for k in range(10_000)) + ".", "an answer")
    schema = "item_id long, question string, answer string"
    docs = documents(spark, [some(15_000) for _ in range(4)] + [f"{some(100)} {q} {a} {some(100)}" for _, q, a in short] + [long[1] + long[2]])
    found = lambda items, **k: {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in decontaminate.find_leaks(
        docs, spark.createDataFrame(items, schema), **k).collect()}
    got = found([*short, long])
    assert {(d, i) for d, i, _, _ in got if d >= 4} >= {(4 + k, k) for k in range(30)} | {(34, 99)}
    assert all(e - s <= 64 for _, i, s, e in got if i != 99)
    assert not any(d < 4 for d, *_ in got)
    assert found([*short, long], block_bytes=30_000) == got


def test_leak_edge_cases(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "alpha beta gamma delta epsilon zeta. The answer is forty two."), (3, "..."), (None, "one")],
                                  "item_id long, text string")
    docs = documents(spark, [*AWKWARD, "Alpha beta gamma delta epsilon zeta! the answer is forty two"])
    got = decontaminate.find_leaks(docs, items).collect()
    assert (len(AWKWARD), 3) in {(r["doc_id"], r["item_id"]) for r in got}
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_copies_of_items_are_indexed_once_and_all_reported(spark):
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    many = items + [(1000 + k, items[k % 2][1]) for k in range(400)] + [(items[0][0], items[0][1]), (None, items[1][1])]
    docs = [(k, f"before {t} after") for k, (_, t) in enumerate(items[:4])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit("x"), "__text": F.lit(1), "__m": F.lit(2)})
    found = {}
    for size in (16 << 20, 500):  # one block of the distinct items, and many
        rows = decontaminate.find_leaks(frame, spark.createDataFrame(many, "item_id long, text string"), block_bytes=size).collect()
        found[size] = sorted(((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in rows), key=repr)
    assert found[500] == found[16 << 20]
    pairs = Counter((d, i) for d, i, _ in found[500])
    for doc in range(2):
        want = Counter(i for i, t in many if t == items[doc][1])
        assert Counter({i: n for (d, i), n in pairs.items() if d == doc and i in want}) == want


# ---- URL filter

RULES = queries.URL_RULES


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = lower(rest[:cut]), rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, None)


def test_urls_match_brute_force(spark):
    pages = table(spark, SF, "pages")
    urls = [None, "", "no scheme", "http://", "HTTP://ORG/x", "https://a.EXAMPLE.org/es/1?x", "https://example.org/en/17#t", "ftp://x.com/fr/",
            "http://x.com?/fr/", "http://notorg/", "a://b://c/d", "http://x.org", "http://x.com/de/\nq"]
    extra = spark.createDataFrame([(100000 + k, u, None) for k, u in enumerate(urls)], pages.schema)
    got = url_filter.judge_urls(pages.unionByName(extra), RULES).collect()
    want = {r["page_id"]: r["url"] for r in pages.unionByName(extra).collect()}
    assert len(got) == len(want)
    for r in got:
        host, path, rule, verdict = brute_url(want[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or verdict is None and r["verdict"] in ("allow", "block")


def test_trust_and_distrust_follow_links(spark):
    page = lambda k, host, *links: (k, f"http://{host}/x", "".join(f'<a href="{x}">' for x in links))
    rules = [("allow", "good.net", "/"), ("block", "bad.net", "/")]
    rows = [page(1, "good.net", "http://friend.net/a", "/own"), page(2, "friend.net", "//far.net/b"), page(3, "far.net"),
            page(4, "spam.net", "http://bad.net/", "HTTP://BAD.net/2", "http://far.net/"), page(5, "bad.net", "http://good.net/"),
            page(6, "feeder.net", "http://spam.net/z"), page(7, "lonely.net"), (8, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {1: ("good.net/", "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: (None, "block"), 5: ("bad.net/", "block"),
                   6: (None, "block"), 7: (None, "allow"), 8: (None, "allow")}
    edges = [("good.net", "friend.net", 1), ("friend.net", "far.net", 1), ("spam.net", "bad.net", 2), ("spam.net", "far.net", 1),
             ("bad.net", "good.net", 1), ("feeder.net", "spam.net", 1)]
    assert sorted(map(tuple, url_filter.host_edges(pages, url_filter.url_host(F.col("url")), F.col("html")).collect())) == sorted(edges)
    ranks = {("trust", "good.net"): 1.0}
    seeds = dict(ranks)
    for _ in range(60):
        out = defaultdict(int)
        for a, b, n in edges:
            out[a] += n
        new = defaultdict(float)
        for k, s in seeds.items():
            new[k] += 0.15 * s
        for a, b, n in edges:
            new["trust", b] += 0.85 * ranks.get(("trust", a), 0) * n / out[a]
        ranks = new
    spark_ranks = url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, n long"),
                                       spark.createDataFrame([("trust", "good.net", 1.0)], "kind string, host string, seed double"), rounds=60, tolerance=1e-12)
    for r in spark_ranks.where("kind = 'trust'").collect():
        assert abs(r["rank"] - ranks.get(("trust", r["host"]), 0)) < 1e-9
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    rows = [(k, f"http://h{k}.net/", f'<a href="http://{f"h{k - 1}" if k else "bad"}.net/">') for k in range(33)]
    got = url_filter.judge_urls(spark.createDataFrame(rows + [(99, "http://bad.net/", None)], "page_id long, url string, html string"),
                                [("block", "bad.net", "/")]).collect()
    assert {r["page_id"]: (r["verdict"], r["distrust"]) for r in got} == {**{k: ("block", 1.0) for k in range(33)}, 99: ("block", 1.0)}


def test_propagation_over_linked_hosts_matches_the_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(11)
    hosts = ["a.org", "b.org", "example.org", "x.com", "y.com", *(f"h{k}.net" for k in range(40))]
    rows = []
    for k in range(300):
        links = [f"https://{rng.choice(hosts)}/{rng.randrange(9)}" for _ in range(rng.randrange(4))] + ["/own", "//B.org/z"][:rng.randrange(3)]
        path = rng.choice(["/", "/es/1", "/en/1", "/de/2", "/fr/3", "?q"])
        rows.append((k, f"http://{rng.choice(hosts)}{path}", " ".join(f"<a HREF='{x}'>" for x in links) if k % 7 else None))
    rows += [(1000 + k, f"http://far{k}.net/", f'<img src="http://far{k + 1}.net/">') for k in range(20)]
    rows += [(2000, "http://far20.net/", '<a href="http://x.com/de/">'), (2001, None, None), (2002, "no url", "<a href=http://x.com/>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r.asDict() for r in queries.op5_url_filter(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    rel = con.sql(queries.ORACLE["op5_url_filter"])
    want = {r[0]: dict(zip(rel.columns, r)) for r in rel.fetchall()}
    assert set(got) == set(want) == {r[0] for r in rows}
    for k, r in got.items():
        mine, theirs = r.pop("distrust"), want[k].pop("distrust")
        assert (mine is None) == (theirs is None) and abs((mine or 0) - (theirs or 0)) < 1e-5 and r == want[k]
    propagated = Counter(r["verdict"] for r in got.values() if r["rule"] is None)
    assert propagated["block"] > 20 and propagated["allow"] > 20


# ---- tool calls

def test_calls_are_linked_ordered_checked_and_canonical(spark):
    call = lambda *cs: json.dumps({"tool_calls": list(cs), "content": None})
    rows = [
        (1, 0, "user", 'say "hi"\n'),
        (1, 1, "tool", '{"tool_call_id": "b", "content": {"z": 1, "a": [2, "é"]}}'),  # before its call
        (1, 2, "assistant", call({"id": "a", "name": "search", "arguments": {"query": "x", "limit": 3}},
                                 {"id": "b", "name": "weather", "arguments": {"unit": "kelvin", "place": "Ulm"}})),
        (1, 3, "tool", '{"content": "ok", "tool_call_id": "a"}'),
        (1, 4, "tool", '{"tool_call_id": "zzz", "content": 1}'),
        (2, 0, "assistant", call({"id": "a", "name": "nope", "arguments": {}}, {"id": "c", "name": "search", "arguments": {"limit": "3"}},
                                 {"id": "d", "name": "search", "arguments": {"query": "q"}}, {"id": "e", "name": "search"})),
        (2, 1, "user", "{not json"), (2, None, None, None), (None, 1, "user", "alone"), (2, 1, "user", "{not json")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("clash"))
    got = sorted(tool_calls.link_tool_calls(df, queries.TOOL_SCHEMAS).collect(), key=lambda r: (r["conv_id"] or 0, r["position"]))
    one = [r for r in got if r["conv_id"] == 1]
    assert [(r["position"], r["turn"], r["kind"]) for r in one] == [
        (0, 0, "message"), (1, 2, "call"), (2, 1, "result"), (3, 3, "result"), (4, 4, "orphan")]
    assert (one[1]["n_calls"], one[1]["n_answered"], one[1]["n_valid"]) == (2, 2, 1)
    assert one[0]["json"] == '{"content":"say \\"hi\\"\\n","role":"user"}'
    assert one[2]["json"] == '{"content":{"a":[2,"é"],"z":1},"role":"tool","tool_call_id":"b"}'
    assert one[1]["json"] == ('{"content":null,"role":"assistant","tool_calls":[{"arguments":{"limit":3,"query":"x"},"id":"a","name":"search"},'
                              '{"arguments":{"place":"Ulm","unit":"kelvin"},"id":"b","name":"weather"}]}')
    two = [r for r in got if r["conv_id"] == 2]
    assert [r["turn"] for r in two] == [None, 0, 1, 1] and two[1]["n_valid"] == 1 and two[1]["n_answered"] == 0
    for r in got:
        assert json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
    assert tool_calls.link_tool_calls(df.limit(0), queries.TOOL_SCHEMAS).count() == 0


def test_results_follow_moved_calls_and_keep_all_fields(spark):
    both = lambda answer, *ids: json.dumps({"tool_call_id": answer, "tool_calls": [{"id": i} for i in ids]})
    nested = ('{"id":"n","function":{"name":"search","arguments":{"query":"q"}},"type":"function"}')
    rows = [(1, 1, "tool", both("a", "b")), (1, 2, "tool", both("b", "c")), (1, 3, "tool", '{"tool_call_id":"c","name":"t","x":{"b":1,"a":null}}'),
            (1, 5, "assistant", '{"tool_calls":[{"id":"a"}],"role":"old"}'), (1, 6, "user", "end"),
            (2, 0, "tool", both("y", "x")), (2, 1, "tool", both("x", "y")), (2, 2, "tool", both("s", "s")),
            (3, 0, None, '{"tool_calls":[' + nested + ',{"id":"n"}],"role":"own"}'), (3, 1, "assistant", '{"tool_calls":[{"id":"n"},{"id":"m"}]}')]
    rows += [(4, k, "tool", both(f"k{k + 1}", f"k{k}")) for k in range(20)] + [(4, 20, "assistant", '{"tool_calls":[{"id":"k20"}]}')]
    got = defaultdict(list)
    for r in tool_calls.link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"),
                                        queries.TOOL_SCHEMAS).orderBy("conv_id", "position").collect():
        got[r["conv_id"]].append(r)
    assert [r["turn"] for r in got[1]] == [5, 1, 2, 3, 6]
    assert [r["json"] for r in got[1][:4]] == [
        '{"role":"assistant","tool_calls":[{"id":"a"}]}', '{"role":"tool","tool_call_id":"a","tool_calls":[{"id":"b"}]}',
        '{"role":"tool","tool_call_id":"b","tool_calls":[{"id":"c"}]}', '{"name":"t","role":"tool","tool_call_id":"c","x":{"a":null,"b":1}}']
    assert [r["turn"] for r in got[2]] == [0, 1, 2]  # rings open at their first message
    assert [(r["n_valid"], r["n_duplicate"]) for r in got[3]] == [(1, 1), (0, 1)]
    assert got[3][0]["json"] == ('{"role":"own","tool_calls":[{"function":{"arguments":{"query":"q"},"name":"search"},"id":"n","type":"function"},{"id":"n"}]}')
    assert [r["turn"] for r in got[4]] == [20, *range(19, -1, -1)]


SCHEMAS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": ["integer", "null"]}, "any": {}}, "required": ["query"]},
    "order": {"type": "object", "additionalProperties": False, "required": ["a.b", "items"], "properties": {
        "a.b": {"type": "number", "enum": [1, 2.5]},
        "items": {"type": "array", "items": {"type": "object", "required": ["sku"], "properties": {"sku": {"type": "string", "enum": ["x", "é\"y"]}}}},
        "to": {"type": "object", "properties": {"zip": {"type": "string"}}, "additionalProperties": False}}},
}


def python_fits(value, rule):
    kinds = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}

    def is_a(kind):
        if kind in ("integer", "number"):
            return not isinstance(value, bool) and isinstance(value, int if kind == "integer" else (int, float))
        return isinstance(value, kinds[kind])

    wanted = rule.get("type", [])
    if wanted and not any(map(is_a, [wanted] if isinstance(wanted, str) else wanted)):
        return False
    if "enum" in rule and value not in rule["enum"]:
        return False
    if isinstance(value, dict):
        known = rule.get("properties", {})
        return (all(python_fits(value[n], r) for n, r in known.items() if n in value) and all(n in value for n in rule.get("required", []))
                and (rule.get("additionalProperties") is not False or set(value) <= set(known)))
    return not isinstance(value, list) or all(python_fits(x, rule.get("items", {})) for x in value)


def random_arguments(rng):
    sku = lambda: rng.choice([{"sku": "x"}, {"sku": 'é"y'}, {"sku": "z"}, {}, {"sku": 1}, "x"])
    return rng.choice([
        {"query": "x", "limit": rng.choice([1, None, "1", 1.5, True])}, {"query": 1}, {"limit": 1}, {"query": "", "any": [1, {"a": None}], "more": 1},
        {"a.b": rng.choice([1, 2.5, 2, "1", None]), "items": [sku() for _ in range(rng.randint(0, 3))]},
        {"a.b": 1, "items": rng.choice([[], {}, None]), "to": rng.choice([{"zip": "1"}, {"zip": 1}, {"zap": "1"}, {}, []])},
        {"a.b": 1, "items": [], "other": 1}, {"items": []}, [], "text", 3, None])


def test_arguments_match_a_plain_validator(spark):
    rng = random.Random(8)
    calls = []
    for k in range(300):
        arguments = random_arguments(rng)
        fitting = "search" if isinstance(arguments, dict) and "query" in arguments else "order"
        tool = fitting if rng.random() < 0.8 else rng.choice(["search", "order", "unknown"])
        held = arguments if k % 3 else json.dumps(arguments)  # as a text, as chat data hold them
        call = {"id": str(k), "name": tool, "arguments": held} if k % 2 else {"id": str(k), "type": "function", "function": {"name": tool, "arguments": held}}
        calls.append((call, isinstance(arguments, dict) and tool in SCHEMAS and python_fits(arguments, SCHEMAS[tool])))
    rows = [(1, k, "assistant", json.dumps({"tool_calls": [c]})) for k, (c, _) in enumerate(calls)]
    got = tool_calls.link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), SCHEMAS)
    assert {r["turn"]: r["n_valid"] for r in got.collect()} == {k: int(v) for k, (_, v) in enumerate(calls)}
    assert 20 < sum(v for _, v in calls) < 280
    broken = [(1, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "function": {"name": "search", "arguments": "{\"query\":"}}]}))]
    got = tool_calls.link_tool_calls(spark.createDataFrame(broken, "conv_id long, turn long, role string, text string"), SCHEMAS)
    assert got.first()["n_valid"] == 0


def brute_links(rows):
    """position of each row, and its kind, calls, answered and duplicate calls; no rings."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(k, r[1], json.loads(r[3])) for k, r in enumerate(rows) if r[0] == conv]
        first, duplicates = {}, Counter()
        for k, turn, m in sorted(mine, key=lambda x: x[1::-1]):
            for no, c in enumerate(m.get("tool_calls", [])):
                if c["id"] in first:
                    duplicates[k] += 1
                else:
                    first[c["id"]] = (turn, k, no)
        answers = {k: first[m["tool_call_id"]] for k, _, m in mine if m.get("tool_call_id") in first}
        turns = {k: turn for k, turn, _ in mine}

        def way(k):
            """Turn and step count of the messages on the way from a result over its call and on."""
            steps = [(turns[k], 0)]
            while k in answers:
                k = answers[k][1]
                steps.append((turns[k], len(steps)))
            return max(steps)

        order = sorted(mine, key=lambda x: (*way(x[0]), answers.get(x[0], ()), x[1], x[0]))
        answered = Counter()
        for c in set(answers.values()):
            answered[c[1]] += 1
        for position, (k, _, m) in enumerate(order):
            n = len(m.get("tool_calls", []))
            kind = "call" if n else "result" if k in answers else "orphan" if "tool_call_id" in m else "message"
            out[conv, turns[k], position] = (kind, n, answered[k], duplicates[k])
    return out


def test_linking_of_random_conversations_matches_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for conv in range(12):
        order = list(range(rng.randint(1, 25)))
        for no, turn in enumerate(rng.sample(order, len(order))):  # calls of message no are answered by later numbers only: no rings
            m = {"content": no}
            if rng.random() < 0.5:
                m["tool_calls"] = [{"id": f"c{no}.{i}" if rng.random() < 0.9 else "twice"} for i in range(rng.randint(1, 3))]
            if no and rng.random() < 0.6:
                m["tool_call_id"] = f"c{rng.randrange(no)}.{rng.randrange(3)}"
            rows.append((conv, turn, "assistant", json.dumps(m)))
    got = tool_calls.link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), {})
    assert {(r["conv_id"], r["turn"], r["position"]): (r["kind"], r["n_calls"], r["n_answered"], r["n_duplicate"]) for r in got.collect()} == brute_links(rows)


def test_tool_call_query_serialises_every_message(spark):
    want = defaultdict(list)
    for r in sorted(table(spark, SF, "conversations").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        want[r["conv_id"]].append(json.dumps({"content": r["text"], "role": r["role"]}, ensure_ascii=False, separators=(",", ":")))
    got = defaultdict(list)
    for r in sorted(queries.op9_tool_call_linking(spark, SF).collect(), key=lambda r: (r["conv_id"], r["position"])):
        assert r["position"] == len(got[r["conv_id"]])
        got[r["conv_id"]].append(r["json"])
    assert got == want


# ---- pipeline

def test_pipeline_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = common.cut(stage(spark, docs, SF), name)
        assert docs.columns == table(spark, SF, "documents").columns
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "language_id":
            # only texts without prose go
            assert all(len(before[i]["text"] or "") < 200 or sum(c.isalpha() or c == " " for c in before[i]["text"]) < 0.8 * len(before[i]["text"]) for i in gone)
        elif name == "line_dedup":
            assert not gone and all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "near_dedup":
            parts = brute_components([(i, brute_print(r["text"])) for i, r in before.items()])
            assert set(after) == {low for _, _, low in parts}
        else:
            items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
            assert gone == {d for d, _ in brute_leaks([(i, r["text"]) for i, r in before.items()], items)}


def test_pipeline_runs_with_awkward_rows(spark):
    docs = documents(spark, AWKWARD + ["The quick brown fox jumps over the lazy dog and runs away from it"] * 3)
    docs = docs.unionByName(docs.where("doc_id > 12")).unionByName(spark.createDataFrame([(None, None, None, None, None)], docs.schema))
    docs = docs.withColumns({"score": F.lit(1), "n_lines": F.lit(2), "component_id": F.lit(3)})
    for start in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            start = common.cut(stage(spark, start, SMALL), name)
            if name != "packing":
                assert start.columns == docs.columns


def test_near_duplicate_stage_tells_repeated_ids_apart(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(80))
    three, alone, hot = text(), text(), [text() for _ in range(40)]
    rows = [(3, three), (7, three), (7, alone), (5, text()), (5, text()), (6, hot[0]), (None, three), (None, hot[1])]
    rows += [(9, t) for t in hot] + [(9, hot[2])] * 3 + [(2, hot[3]), (4, None), (4, ""), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__h1": F.lit("x"), "n": F.lit(1)})
    got = list(map(tuple, corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).select("doc_id", "text").collect()))
    groups = defaultdict(list)  # the texts are random: a group is a set of equal prints
    for i, t in rows:
        if i is not None:
            groups[brute_print(t)].append((i, t))
    assert sorted(t for i, t in got if i is None) == sorted(t for i, t in rows if i is None)
    left = [(i, t) for i, t in got if i is not None]
    assert len(left) == len(groups) and {brute_print(t) for _, t in left} == set(groups)
    assert all(i == min(groups[brute_print(t)], key=lambda x: x[0])[0] for i, t in left)
    assert (7, alone) in got and (7, three) not in got and sum(i == 5 for i, _ in got) == 2


def test_pipeline_query(spark):
    assert queries.pipeline(spark, SMALL).count() > 0
