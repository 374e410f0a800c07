from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hazardgrid.llm.mixing import mix, mixed_documents, words

from .helpers import clashing, documents, rows


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by the rule itself: deal, stop at the limits, deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    limit = {s: most * sizes[s] for s in names}
    target, free, left = dict.fromkeys(names, 0.0), list(names), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - limit[s]) for s in free)
        target = {s: min(target[s], limit[s]) for s in names}
        free = [s for s in free if target[s] < limit[s]]
    return target


def brute(texts, sources, ids):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    total = defaultdict(int)
    for s, n in zip(sources, size, strict=True):
        total[s] += n
    target = reshared(total)
    taken, before = [0] * len(texts), defaultdict(int)
    order = sorted(range(len(texts)), key=lambda i: hashlib.md5(f"mix:{ids[i]}".encode()).hexdigest())
    for i in order:
        s, budget = sources[i], math.floor(target[sources[i]] + 1e-6)
        for turn in range(4):
            taken[i] += min(size[i], max(0, budget - turn * total[s] - before[s])) if total[s] else 0
        before[s] += size[i]
    return {i: (size[k], total[sources[k]], target[sources[k]], taken[k]) for k, i in enumerate(ids)}


def corpus(n=200, seed=1):
    rng = random.Random(seed)
    texts = [" ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    sources = [rng.choice(["hot"] * 6 + ["a", "b", "ü", "Z", None]) for _ in range(n)]
    return texts, sources, list(range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_by_the_rule(spark, seed):
    texts, sources, ids = corpus(seed=seed)
    texts[:3], texts[7] = [None, "", " \n"], "w " * 5000
    wanted = brute(texts, sources, ids)
    found = mix(clashing(documents(spark, texts, sources))).collect()
    assert len(found) == len(ids)
    for r in found:
        size, total, target, taken = wanted[r["doc_id"]]
        assert (r["size"], r["source_size"], r["taken"]) == (size, total, taken)
        assert r["target"] == pytest.approx(target, rel=1e-9, abs=1e-6)


def test_takes_the_budget_and_no_more(spark):
    found = mix(documents(spark, *corpus()[:2]))
    totals = found.groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(r["taken"] == math.floor(r["target"] + 1e-6) for r in totals)
    assert found.filter("taken > 2 * size").isEmpty()


def test_partitions_change_nothing(spark):
    df = documents(spark, *corpus()[:2])
    one = rows(mix(df.coalesce(1)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert rows(mix(df.repartition(9))) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edges(spark):
    assert rows(mix(documents(spark, ["a"]).limit(0))) == []
    assert rows(mix(documents(spark, [None, ""], [None, "s"])), "size", "target", "taken") == [(0, 0.0, 0), (0, 0.0, 0)]
    twice = documents(spark, ["a b", "a b", "c"], ids=[1, 1, None])
    assert sum(r["taken"] for r in mix(twice).collect()) == 7
    assert mix(documents(spark, ["a b c"] * 4)).agg(F.sum("taken")).first()[0] == 18


def test_plan_stays_in_the_jvm(spark, sf_dir):
    plan = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_words(spark):
    df = documents(spark, [None, "", "  ", " a\tb\x0b c d "])
    assert [r[0] for r in df.orderBy("doc_id").select(words()).collect()] == [0, 0, 0, 3]


def test_whole_documents(spark):
    df = clashing(documents(spark, *corpus()[:2]))
    out = mixed_documents(df)
    assert out.columns == df.columns
    times = defaultdict(int)
    for r in out.collect():
        times[r["doc_id"]] += 1
    for r in mix(df).collect():
        assert times[r["doc_id"]] == (math.floor(r["taken"] / r["size"] + 0.5) if r["size"] else 0)
    assert mixed_documents(df.limit(0)).count() == 0
