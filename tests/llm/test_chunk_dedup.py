from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hazardgrid.llm.chunk_dedup import chunk_dedup, squeezed, without_copies
from hazardgrid.llm.common import text_bytes

from .helpers import clashing, documents, rows


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(texts, ids):
    out = []
    for i, t in zip(ids, texts, strict=True):
        same = [j for j, u in zip(ids, texts, strict=True) if squeeze(u) == squeeze(t)]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(squeeze(t).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(rows(df, "doc_id", "keep_id", "group_size", "kept", "text_sha256"), key=str)


def test_squeezed():
    texts = ["", " ", "  a\t\n b ", "é\x0b\x0cü", "   ", "x", " y", "z ", " "]
    values, edges = squeezed(*text_bytes(pa.array(texts)))
    data = values.tobytes()
    assert [data[a:b].decode() for a, b in zip(edges, edges[1:], strict=False)] == [squeeze(t) for t in texts]
    assert squeezed(np.zeros(0, np.uint8), np.zeros(1, np.int64))[1].tolist() == [0]


# One byte of digest makes different chunks share identifiers, which the verification must part.
@pytest.mark.parametrize("sizes", [{}, {"bits": 4, "least": 32, "most": 96, "digest": 1}])
def test_cases(spark, sizes):
    rng = random.Random(4)
    long = "".join(rng.choice("ab \n") for _ in range(40000))
    texts = [None, "", " ", "\n\n", "a b", "a\t b", "a b ", long, long.replace("\n", "  "), long + "!", "!" + long, "x" * 70000, "x" * 70001]
    texts += ["".join(rng.choice("ab ") for _ in range(80)) for _ in range(40)]
    ids = list(range(len(texts), 0, -1))
    df = clashing(documents(spark, texts, ids=ids))
    assert found(chunk_dedup(df, **sizes)) == brute(texts, ids)
    kept = without_copies(df, **sizes)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({k for _, k, _, _, _ in brute(texts, ids)})
    assert rows(chunk_dedup(df.limit(0), **sizes)) == [] and rows(without_copies(df.limit(0), **sizes)) == []


def test_repeated_rows_and_null_ids(spark):
    df = documents(spark, ["a", "a", "a", "b", "b", "c"], ids=[2, 2, None, None, None, 2])
    marked = rows(chunk_dedup(df), "doc_id", "keep_id", "group_size", "kept")
    assert sorted(map(str, marked)) == sorted(map(str, [(2, 2, 3, True), (2, 2, 3, False), (None, 2, 3, False), (None, None, 2, True), (None, None, 2, False), (2, 2, 1, True)]))
    assert sorted(r["text"] for r in without_copies(df).collect()) == ["a", "b", "c"]
