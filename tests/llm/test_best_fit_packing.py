from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from hazardgrid.llm.best_fit_packing import best_fit_packing, fit, pack, repetitions, token_pieces
from hazardgrid.llm.queries import tokenizer

from .helpers import clashing, documents, rows


def check(found, docs, most):
    library = Tokenizer.from_file(tokenizer())
    library.no_truncation()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(docs)
    for doc_id, text in docs.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["length"] for r in mine] == [min(most, len(ids) - s) for s in range(0, len(ids), most)]
        for r in mine:
            assert r["start"] == r["piece"] * most
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= most
    return len(sequences)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = best_fit_packing(docs, tokenizer()).collect()
    n = check(found, {r["doc_id"]: r["text"] for r in docs.collect()}, 2048)
    assert n <= 1.03 * sum(r["length"] for r in found) / 2048 + 1


def test_cases(spark):
    texts = [None, "", "a b c", "a b c", "word " * 5000, "x y " * 31 + "z", "!" * 300]
    found = best_fit_packing(clashing(documents(spark, texts)), tokenizer(), 64).collect()
    check(found, dict(enumerate(texts)), 64)
    assert best_fit_packing(documents(spark, texts).limit(0), tokenizer()).collect() == []


def test_repeated_rows_and_null_ids(spark):
    found = best_fit_packing(documents(spark, ["a b"] * 4, ids=[1, 1, None, None]), tokenizer()).collect()
    assert [r["length"] for r in found] == [3] * 4 and sorted(r["offset"] for r in found) == [0, 3, 6, 9]


def test_repeated_rows_are_dealt_out(spark):
    same = spark.range(9000).selectExpr("if(id < 5000, 7L, NULL) AS doc_id", "0 AS piece", "0L AS start", "3L AS length", "5L AS ids_crc32")
    own = spark.range(1000).selectExpr("id + 100 AS doc_id", "0 AS piece", "0L AS start", "4L AS length", "id AS ids_crc32")
    found = pack(same.union(own), most=8, group=100).collect()
    groups, ids = Counter(r["sequence_id"] >> 32 for r in found), Counter(r["doc_id"] for r in found)
    assert len(groups) == 100 and max(groups.values()) < 200
    assert len(ids) == 1002 and ids[7] == 5000 and ids[None] == 4000 and sum(ids.values()) == 10000


def test_repetitions_over_several_blocks(spark):
    counted = repetitions(spark.createDataFrame([(1,)] * 10 + [(None,)] * 3 + [(2,)], "x int"), "n", block=4).collect()
    assert sorted((r["x"] or 0, r["n"]) for r in counted) == [(0, n) for n in range(3)] + [(1, n) for n in range(10)] + [(2, 0)]


def test_many_groups(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = pack(token_pieces(docs, tokenizer()), group=20).collect()
    check(found, {r["doc_id"]: r["text"] for r in docs.collect()}, 2048)


def test_every_capacity_holds():
    sizes = np.array([5, 5, 4, 3, 3, 2, 1, 1, 1, 1])
    bins, at = fit(sizes, (10, 3, 45), (1, 1e-6, 1e-6))
    for b in set(bins):
        mine = sizes[bins == b]
        assert mine.sum() <= 10 and len(mine) <= 3 and (mine**2).sum() <= 45
    with pytest.raises(ValueError):
        fit(np.array([11]), (10, 3, 1000), (1, 0, 0))


def test_best_fit_takes_the_tightest_bin():
    bins, _ = fit(np.array([7, 6, 3, 4]), (10, 10, 1000), (1, 0, 0))
    assert bins[0] == bins[2] and bins[1] == bins[3]


def test_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows(best_fit_packing(docs, tokenizer())) == rows(best_fit_packing(docs.repartition(7), tokenizer()))
