import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardgrid.llm import collocations as module
from hazardgrid.llm.collocations import CUT, collocations, tile_counts
from hazardgrid.llm.terms import parts
from tests.llm.helpers import clashing, rows

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(texts, max_words=3, least=10, cover=50, top=2000):
    f, n = {}, Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        many = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in many.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in many.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def frame(spark, texts, slices=3):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string").repartition(slices)


def invented(seed, n=60, words=25, signs="  . , \t\n!"):
    draw = random.Random(seed)
    names = [f"{draw.choice('aAbÉ')}{i}" if i % 5 else "thé" for i in range(words)]
    weight = [1 / (i + 1) for i in range(words)]
    return [(draw.choice(["en", "de", None, "und"]), "".join(draw.choices(names, weight)[0] + draw.choice(signs) for _ in range(draw.randint(0, 120)))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"max_words": 2}, {"max_words": 4, "least": 4}, {"top": 3, "least": 3}, {"cover": 90, "least": 2}])
def test_equals_brute_force(spark, options):
    texts = invented(len(options) + options.get("max_words", 0))
    assert rows(collocations(frame(spark, texts), **options), *COLUMNS) == brute(texts, **options)


def test_long_texts_in_slices(spark, monkeypatch):
    monkeypatch.setattr(module, "SLICE", 300)
    monkeypatch.setattr(module, "PAIRS", 64)
    texts = [("en", " ".join(t for _, t in invented(9))), ("en", "x" * 2000 + " y z " * 30), ("de", ""), ("de", "of the end " * 200)]
    assert rows(collocations(frame(spark, texts, 2), least=3), *COLUMNS) == brute(texts, least=3)


def test_dense_and_sparse_tiles():
    draw = np.random.default_rng(1)
    width = 30000
    keys = np.concatenate([draw.integers(0, 900, 400000) * width + draw.integers(0, 900, 400000), draw.integers(0, width, 50000) * width + draw.integers(0, width, 50000)])
    cells, counts = tile_counts(keys, width)
    order = np.argsort(cells)
    want, n = np.unique(keys, return_counts=True)
    assert (cells[order] == want).all() and (counts[order] == n).all()
    assert [len(x) for x in tile_counts(np.zeros(0, np.int64), 5)] == [0, 0]


def test_products_beyond_64_bits(spark):
    a, left, right = 10**14 + 7, 3 * 10**14 + 1, 2 * 10**14 + 11
    one = spark.createDataFrame([(a, [left, left], [right, right])], "f long, lefts array<long>, rights array<long>").select(F.expr(CUT).alias("cut")).first().cut
    assert (one.score, one.k) == (1000000 * a * a // (left * right), 0)


def test_parts_cover_the_text():
    values = np.frombuffer(b"ab cd efghij kl", np.uint8)
    cut = parts(values, values.min() == np.arange(256), 4)
    assert cut[0][0] == 0 and cut[-1][1] == len(values) and all(a[1] == b[0] for a, b in zip(cut[:-1], cut[1:], strict=True))
    assert parts(values[:0], np.zeros(256, bool), 4) == [(0, 0)]


def test_odd_rows(spark):
    texts = [(None, "A b."), (None, None), ("und", "a B"), ("en", ""), ("en", " \t .,;"), ("und", "a b\x0ba b")]
    docs = clashing(frame(spark, texts)).withColumn("f", F.lit(1)).withColumn("phrase", F.lit("x"))
    assert rows(collocations(docs, least=2), *COLUMNS) == brute(texts, least=2)
    assert collocations(frame(spark, texts).filter("doc_id < 0")).count() == 0
    again = frame(spark, [("en", "same words here")] * 12)
    assert rows(collocations(again), "phrase", "a", "score") == [("same words here", 12, 1000000)]
