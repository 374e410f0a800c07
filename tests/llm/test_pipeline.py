from __future__ import annotations

import importlib.util
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from hazardgrid.llm.mixing import mix
from hazardgrid.llm.oracles import ORACLES
from hazardgrid.llm.quality_knn import classify_quality
from hazardgrid.llm.queries import QUERIES

from .helpers import clashing, documents, groups, rows
from .test_best_fit_packing import check
from .test_chunk_dedup import squeeze
from .test_simhash_dedup import plain


def test_every_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]

    def kept(name, df):
        out = stages[name](spark, df, sf_dir)
        assert out.schema == df.schema
        return out

    good = kept("quality", docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in classify_quality(docs, labels).collect() if r["predicted"]}

    distinct = kept("exact_dedup", good)
    first = {}
    for r in sorted(good.collect(), key=lambda r: r["doc_id"]):
        first.setdefault(squeeze(r["text"]), r)
    assert rows(distinct) == sorted(tuple(r) for r in first.values())

    single = kept("near_dedup", distinct)
    held = sorted(distinct.collect(), key=lambda r: r["doc_id"])
    prints = [plain(r["text"]) for r in held]
    root = groups(len(held), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert rows(single) == sorted(tuple(held[i]) for i in set(root))

    mixed = kept("mixing", single)
    times = {r["doc_id"]: math.floor(r["taken"] / r["size"] + 0.5) if r["size"] else 0 for r in mix(single).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in times.items() if n})

    packed = stages["packing"](spark, mixed, sf_dir).collect()
    # Repeated documents have the same pieces: number the repetitions before the check.
    texts, seen = {r["doc_id"]: r["text"] for r in mixed.collect()}, defaultdict(int)
    numbered = []
    for r in packed:
        turn = seen[r["doc_id"], r["piece"]]
        seen[r["doc_id"], r["piece"]] += 1
        numbered.append(r.asDict() | {"doc_id": (r["doc_id"], turn)})
    check(numbered, {(i, t): texts[i] for i, n in times.items() for t in range(n)}, 2048)
    assert rows(corpus_pipeline.run(spark, sf_dir), "doc_id", "piece", "length", "ids_crc32") == sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed)


def test_stages_take_odd_rows(spark, sf_dir):
    texts = [None, "", "a b c d", "a b c d", "  a b\tc d", "word " * 3000, "x", "x"]
    df = clashing(documents(spark, texts, [None, "s", "s", None, "s", "t", "t", "t"], [1, 2, 3, 3, None, 5, 6, 6]))
    for name, stage in corpus_pipeline.STAGES:
        for part in (df, df.limit(0)):
            out = stage(spark, part, sf_dir)
            assert name == "packing" or out.columns == df.columns
            assert out.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted(rows(df, *names), key=str) == sorted(cursor.fetchall(), key=str)


def test_all_are_registered():
    spec = importlib.util.spec_from_file_location("entry", Path(corpus_pipeline.__file__).with_name("__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n))) == list(range(1, 11))
