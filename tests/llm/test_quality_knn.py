from __future__ import annotations

import hashlib
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazardgrid.llm.quality_knn import classify_quality, features, fit, good_documents, score_quality, unit

from .helpers import clashing, documents, rows


@pytest.fixture(scope="module")
def labelled(spark):
    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("no test data here")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    found = classify_quality(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    judged = found.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in judged)
    unseen = [r for r in judged if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in unseen]) >= 0.95
    assert np.mean([r["predicted"] for r in unseen if r["quality"] == 1]) >= 0.97
    assert found.count() == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in judged)


def test_held_out_labels_and_other_columns_are_no_input(labelled):
    docs, labels = labelled
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x"), "n_chars": F.lit(0).cast("long")})
    assert rows(classify_quality(docs, labels)) == rows(classify_quality(other, turned))


def test_cases(spark, labelled):
    docs, labels = labelled
    voters = fit(docs, labels)
    texts = [None, "", " ", "a", "word " * 50000, "word " * 50000, "THE!! AND!! " * 30]
    df = clashing(documents(spark, texts, ids=[1, 2, 3, 4, 5, 5, None]))
    scored = score_quality(df, voters, "own").collect()
    assert len(scored) == 7 and all(0 <= r["own"] <= 1 for r in scored)
    by_text = {}
    for r in scored:
        by_text.setdefault(r["text"] or "", set()).add(r["own"])
    assert all(len(v) == 1 for v in by_text.values())
    good = good_documents(df, labels)
    assert good.columns == df.columns
    assert classify_quality(df.limit(0), labels).count() == 0
    without = classify_quality(df, labels.limit(0)).collect()
    assert {r["score"] for r in without} == {0.5}
    odd = spark.createDataFrame([(None, 1), (4, None), (4, 7)], "doc_id long, quality int")
    assert {r["score"] for r in classify_quality(df, odd).collect()} == {0.5}


def test_sample_is_bounded(labelled):
    docs, labels = labelled
    assert len(fit(docs, labels, sample=50).labels) == 50


def test_documents_that_share_an_id_teach_once(spark):
    texts = [f"Text {i} of one id." for i in range(300)] + [None, "A text. " * 40, "SHORT ONE!"]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    df = documents(spark, texts, ids=[1] * 301 + [2, 3])
    voters = fit(df.repartition(5), labels)
    assert voters.labels.tolist() == [1, 0, 0]
    first = min(texts[:301], key=lambda t: hashlib.md5((t or "").encode()).digest())
    alone = fit(documents(spark, [first, *texts[301:]], ids=[1, 2, 3]), labels)
    assert (voters.vectors == alone.vectors).all()


def test_long_labelled_texts_have_the_vectors_of_scored_ones(spark):
    texts = ["a" * 400000 + "Some words, 12 of them.\n" * 9000, "A text. " * 40, "SHORT ONE!"]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    voters = fit(documents(spark, texts, ids=[1, 2, 3]), labels)
    scored = unit(voters.weighted(np.concatenate(list(features(pa.array(texts))))) @ voters.directions.astype(float))
    assert len(voters.vectors) == 3 and voters.vectors == pytest.approx(scored, abs=1e-9)


def test_features_of_a_text_depend_on_it_alone():
    texts = ["abc abc", "", "Ünï!", "abc abc", "z" * 100]
    together = np.concatenate(list(features(pa.array(texts), block=2)))
    alone = np.concatenate([next(features(pa.array([t]))) for t in texts])
    assert (together == alone).all()


def test_votes_equal_a_plain_loop(spark, labelled):
    docs, labels = labelled
    voters = fit(docs, labels, sample=60, neighbours=5)
    texts = [r["text"] for r in docs.limit(40).collect()]
    raw = np.concatenate(list(features(pa.array(texts))))
    v = voters.weighted(raw) @ voters.directions.astype(float)
    for row, score in zip(v, voters.score(raw), strict=True):
        cosine = voters.vectors @ (row / max(np.linalg.norm(row), 1e-30))
        nearest = np.argsort(-cosine)[:5]
        w = np.maximum(cosine[nearest], 0) ** 8
        assert score == pytest.approx(((w * voters.labels[nearest]).sum() + 0.01 * voters.prior) / (w.sum() + 0.01), abs=1e-6)


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The workers of a driver that starts elsewhere don't find the package on their path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
from hazardgrid.llm.quality_knn import classify_quality
docs = spark.createDataFrame([(i, f"some text {{i}} " * (i % 5)) for i in range(40)], "doc_id long, text string")
labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
print("rows", classify_quality(docs, labels).count(), len(classify_quality(docs, labels).collect()))
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 40 40" in done.stdout, done.stderr[-2000:]
