"""Hot keys inside the operators: adaptive execution splits their joins, results stay exact; iterations free their rounds."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordforge.llm import common, simhash, tool_calls, url_filter

CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def plans(spark, monkeypatch):
    """No broadcasts, small partitions; the final plan of every table that an operator writes, by name."""
    old = {k: spark.conf.get(k) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    seen: dict[str, list[str]] = {}

    def recorded(df, name, **kwargs):
        df.collect()
        seen.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return common.cut(df, name, **kwargs)

    for module in (simhash, url_filter, tool_calls):
        monkeypatch.setattr(module, "cut", recorded)
    yield seen
    for k, v in old.items():
        spark.conf.set(k, v)


def split(plans, name):
    return any("SortMergeJoin(skew=true)" in p for p in plans[name])


def test_hub_of_a_component_is_split(spark, plans):
    edges = spark.range(1, 20001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).unionByName(
        spark.range(30000, 30020).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))).repartition(16)
    got = {r["root"]: r["n"] for r in simhash.connected(edges).groupBy("root").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 20000, 30000: 20}
    assert split(plans, "large")


def test_bucket_of_many_fingerprints_is_split(spark, plans):
    rng = random.Random(3)
    low = rng.getrandbits(21)  # the first segment: 6000 fingerprints share 21 of its keys
    prints = {(rng.getrandbits(43) << 21) | low for _ in range(6000)} | {rng.getrandbits(64) for _ in range(500)}
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, 1) for p in prints], "__fp long, __docs long").repartition(16)
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # more than there are hot keys
    try:
        roots = {r["__fp"]: r["__root"] for r in simhash.link_fingerprints(nodes).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = {}
    ordered = sorted(roots)
    values = np.array(ordered, np.int64).view(np.uint64)
    for k, fp in enumerate(ordered):  # random upper bits: groups are pairs at most
        near = np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 4)
        want[fp] = ordered[near[0]]
    assert roots == want
    assert split(plans, "edges")


def test_hub_host_is_split(spark, plans):
    edges = spark.range(20000).select(F.lit("hub").alias("src"), F.concat(F.lit("h"), F.col("id")).alias("dst"), F.lit(1).cast("long").alias("n"))
    seeds = spark.createDataFrame([("trust", "hub", 1.0)], "kind string, host string, seed double")
    ranks = {r["host"]: r["rank"] for r in url_filter.propagate(edges.repartition(16), seeds).collect()}
    assert len(ranks) == 20001 and abs(ranks["h7"] - 0.85 * 0.15 / 20000) < 1e-12
    assert split(plans, "edges") and split(plans, "ranks")


def test_identifier_answered_very_often_is_split(spark, plans):
    rows = [(1, 0, "assistant", json.dumps({"tool_calls": [{"id": "hot"}]}))]
    rows += [(1, k, "tool", json.dumps({"tool_call_id": "hot", "content": k})) for k in range(1, 8001)]
    rows += [(None, 0, "assistant", json.dumps({"tool_calls": [{"id": "c"}, {"id": "c"}]})), (None, 1, "tool", json.dumps({"tool_call_id": "c"}))]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    got = {(r["conv_id"], r["turn"]): (r["position"], r["kind"], r["n_answered"], r["n_duplicate"])
           for r in tool_calls.link_tool_calls(messages, {}).collect()}
    assert got == {(1, 0): (0, "call", 1, 0), **{(1, k): (k, "result", 0, 0) for k in range(1, 8001)},
                   (None, 0): (0, "call", 1, 1), (None, 1): (1, "result", 0, 0)}
    assert split(plans, "answers")


def test_iterations_free_their_rounds(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    chain = spark.range(12).select(F.concat(F.lit("h"), F.col("id")).alias("src"), F.concat(F.lit("h"), F.col("id") + 1).alias("dst"),
                                   F.lit(1).cast("long").alias("n"))
    seeds = spark.createDataFrame([("trust", "h0", 1.0)], "kind string, host string, seed double")
    assert url_filter.propagate(chain, seeds).where("kind = 'trust'").count() == 13
    new = sorted(x.split("-")[0] for x in set(os.listdir(folder)) - before)
    assert new == ["edges", "ranks"]
    before = set(os.listdir(folder))
    assert simhash.connected(spark.range(20).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))).where("root = 0").count() == 20
    assert len(set(os.listdir(folder)) - before) == 1
