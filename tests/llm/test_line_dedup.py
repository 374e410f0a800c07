from __future__ import annotations

import random

import numpy as np
import pytest

from hazardgrid.llm import line_dedup as module
from hazardgrid.llm.line_dedup import band_keys, block_links, line_dedup, shingles, text_lines, without_repeated_lines

from .helpers import clashing, documents, groups, rows


def brute(docs, width=8, least=0.8):
    found = [(i, n, line.decode()) for i, text in docs for n, line in enumerate(text_lines(text or "")) if line]
    sets = [shingles(line, width) for _, _, line in found]
    root = groups(len(found), lambda a, b: len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]))
    first = {}
    for (i, n, _), r in zip(found, root, strict=True):
        first[r] = min(first.get(r, (i, n)), (i, n))
    return sorted((i, n, *first[r], first[r] == (i, n)) for (i, n, _), r in zip(found, root, strict=True))


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    lines = [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(60)]
    hot = " ".join(words[:30])
    docs = []
    for i in range(40):
        own = rng.sample(lines, 3)
        line = list(rng.choice(lines))
        line[rng.randrange(len(line))] = "X"
        docs.append((i, "\n".join([*own, "".join(line), "", hot + f" {i}", hot.upper() if i % 3 else "  " + hot])))
    return docs


def test_against_all_pairs(spark):
    docs = corpus()
    out = line_dedup(clashing(documents(spark, [t for _, t in docs])), bands=24, rows=2)
    assert rows(out) == brute(docs)


def test_components_beyond_the_first_comparison(spark):
    # Neighbours in the chain are similar, its ends aren't: the pivot alone can't link them all.
    line = "".join(random.Random(1).choice("abcdefgh ") for _ in range(200)).strip()
    docs = [(i, "y" * (4 * i) + line[4 * i :]) for i in range(12)]
    assert rows(line_dedup(documents(spark, [t for _, t in docs]), bands=40, rows=1)) == brute(docs)


def test_blocks_of_tiles(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE", 5)
    monkeypatch.setattr(module, "WIDTH", 64)
    docs = corpus(6)
    assert rows(line_dedup(documents(spark, [t for _, t in docs]), bands=12, rows=1)) == brute(docs)


@pytest.mark.parametrize("few", [0, 16])
def test_links_of_a_block(monkeypatch, few):
    monkeypatch.setattr(module, "FEW", few)
    lines = ["abcdefgh", "abcdefghi", "zzzzzzzzz", "abcdefghij", "zzzzzzzzzz"]
    sets = [shingles(x, 3) for x in lines]
    assert block_links(sets, [0, 1, 2, 3, 4], 0, 0.8) == [(0, 1), (1, 3), (2, 4)]
    assert block_links(sets, [0, 1, 2, 1, 2], 0, 0.8) == [(0, 1)]
    assert block_links(sets, [0, 1, 2, 3, 4], 3, 0.8) == [(1, 3), (2, 4)]


def test_cases(spark):
    docs = [(3, "A  line\n\nb"), (1, "a line \nc"), (2, None), (4, ""), (5, "\n \n"), (6, "long " * 30000), (7, "long " * 30000 + "er"), (8, "some line of text, of which there is a copy"), (9, "x\nSome line of text, of which there is a copY")]
    df = clashing(documents(spark, [t for _, t in docs], ids=[i for i, _ in docs]))
    assert rows(line_dedup(df)) == brute(docs)
    cleaned = without_repeated_lines(df)
    assert cleaned.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == dict(docs) | {3: "\nb", 9: "x"}
    assert rows(line_dedup(df.limit(0))) == []
    odd = documents(spark, ["x\ny", "x\ny", "x"], ids=[1, 1, None])
    assert rows(line_dedup(odd), "doc_id", "line_no", "kept") == [(1, 0, True), (1, 0, True), (1, 1, True), (1, 1, True), (None, 0, False)]


def test_bands_depend_on_the_line_alone():
    lines = [b"a", b"some line", "lïne of ünicode".encode(), b"x" * 500, b"abcdefgh"]
    together = band_keys(lines, 8, 9, 4)
    assert (together == np.concatenate([band_keys([x], 8, 9, 4) for x in lines])).all()


def test_recall_at_the_threshold():
    rng = random.Random(2)
    met = []
    for _ in range(300):
        a = "".join(rng.choice("abcdefghijklmnop ") for _ in range(180))
        b = a[:90] + "".join(rng.choice("qrstuv") for _ in range(12)) + a[90 + 12 :]
        if len(shingles(a, 8) & shingles(b, 8)) >= 0.8 * len(shingles(a, 8) | shingles(b, 8)):
            x, y = band_keys([a.encode(), b.encode()], 8, 9, 4)
            met.append((x == y).any())
    assert len(met) > 200 and np.mean(met) > 0.97
