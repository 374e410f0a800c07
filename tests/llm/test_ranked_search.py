import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from hazardgrid.llm import ranked_search as module
from hazardgrid.llm.ranked_search import best_of_block, bounds, ranked_search
from tests.llm.helpers import clashing, documents

ITEMS = "item_id long, text string"


def terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(texts, ids, items, top=10):
    counts = [Counter(terms(t)) for t in texts]
    sizes = [sum(c.values()) for c in counts]
    total, n = sum(sizes), sum(s > 0 for s in sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for c, size, at in zip(counts, sizes, ids, strict=True):
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (100 - 90 + (90 * size * n) // total)))
            if score > 0:
                scored.append((-score, at is None, at or 0, at))
        out += [(item, rank, at, -score) for rank, (score, _, _, at) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=lambda r: (r[0], r[1]))


def got(df):
    assert set(df.columns) >= {"item_id", "rank", "doc_id", "score"}
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=lambda r: (r[0], r[1]))


def invented(seed, n, words=60):
    draw = random.Random(seed)
    names = [f"{draw.choice('aAbÉß')}{i}" for i in range(words)]
    weight = [1 / (i + 1) for i in range(words)]
    return ["".join(draw.choices(names, weight)[0] + draw.choice(" ,\n-") for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("block, part, top", [(8 << 20, 1 << 18, 10), (2000, 30, 10), (300, 1 << 18, 3)])
def test_equals_brute_force(spark, monkeypatch, block, part, top):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "TERMS", part)
    texts = invented(block, 150)
    items = list(enumerate(invented(7, 12))) + [(50, texts[3]), (51, "")]
    docs = documents(spark, texts).repartition(3)
    assert got(ranked_search(docs, spark.createDataFrame(items, ITEMS), top)) == brute(texts, range(150), items, top)


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 100)
    texts = [" ".join(invented(5, 20)), "a0 b1", "x" * 500 + " a0", None]
    items = [(0, texts[0]), (1, "a0 x b1 " + "x" * 500)]
    assert got(ranked_search(documents(spark, texts), spark.createDataFrame(items, ITEMS))) == brute(texts, range(4), items)


def test_ties_copies_and_odd_rows(spark):
    texts = [None, "", " .,", "one two", "one two", "one two", "two three", "one two", "Ünï CODE", "rest"]
    ids = [0, 1, 2, 9, 3, None, 4, 3, 5, 6]
    items = [(1, "One two! one"), (2, None), (3, "none of these"), (4, "üNï code Ünï")]
    docs = clashing(documents(spark, texts, ids=ids))
    assert got(ranked_search(docs, clashing(spark.createDataFrame(items, ITEMS)))) == brute(texts, ids, items)


def test_items_that_share_an_id(spark):
    texts = invented(2, 30)
    items = [(1, texts[0]), (1, texts[1])]
    found = got(ranked_search(documents(spark, texts), spark.createDataFrame(items, ITEMS)))
    assert sorted(found) == sorted(brute(texts, range(30), items))


def test_empty_tables(spark):
    none, one = documents(spark, []), documents(spark, ["a b"])
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert got(ranked_search(none, items)) == [] and got(ranked_search(one, items.limit(0))) == []


def test_pair_bounds_hold_and_skip_more_than_term_bounds():
    draw = np.random.default_rng(1)
    tighter = 0
    for _ in range(200):
        n, size = int(draw.integers(1, 9)), 40
        dense = draw.integers(1, 100, (n, size)) * (draw.random((n, size)) < 0.2)
        held = {t: (np.flatnonzero(dense[t]).astype(np.int32), dense[t][dense[t] > 0].astype(np.int64)) for t in range(n) if dense[t].any()}
        tops, query = dense.max(1), draw.permutation(n)
        joint = {(a, b): int((dense[a] + dense[b])[(dense[a] > 0) & (dense[b] > 0)].max()) for a, b in zip(query[:-1].tolist(), query[1:].tolist()) if ((dense[a] > 0) & (dense[b] > 0)).any()}
        limit = bounds(query, tops, joint)
        for k in range(n + 1):
            assert limit[k] >= dense[query[:k]].sum(0).max(initial=0)
        tighter += limit[-1] < tops.sum()
        total = dense.sum(0)
        for floor in (1, int(np.sort(total)[-5]) or 1):
            docs, scores = best_of_block(query, held, tops, joint, size, floor, 5)
            want = sorted(total[total >= floor].tolist())[::-1][:5]
            assert sorted(scores.tolist())[::-1][:5] == want and (total[docs] == scores).all()
            # Whatever ties with the last place is there, too.
            if len(want) == 5:
                assert set(np.flatnonzero(total >= want[-1])) <= set(docs.tolist())
    assert tighter > 100
