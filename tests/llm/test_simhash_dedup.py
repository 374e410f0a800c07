from __future__ import annotations

import random
import re

import pytest
import xxhash

from hazardgrid.llm.common import components
from hazardgrid.llm.simhash_dedup import near_links, simhash, simhash_dedup, without_near_copies

from .helpers import clashing, documents, groups, rows


def plain(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(texts, ids):
    prints = [plain(t) for t in texts]
    root = groups(len(texts), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    least = {r: min((i for i, q in zip(ids, root, strict=True) if q == r and i is not None), default=None) for r in set(root)}
    return sorted(((i, f"{p:016x}", least[r]) for i, p, r in zip(ids, prints, root, strict=True)), key=str)


def found(df):
    return sorted(rows(df, "doc_id", "fingerprint", "component_id"), key=str)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    collected = docs.collect()
    assert found(simhash_dedup(docs)) == brute([r["text"] for r in collected], [r["doc_id"] for r in collected])


def test_cases(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [None, "", " \t", "A b", "a  B", "ÄB c", "one two three", base, base.upper(), base + " x", "word " * 40000, base, "  x"]
    ids = [5, 6, 3, 9, 8, 1, 2, 20, 19, 18, 0, None, 30]
    df = clashing(documents(spark, texts, ids=ids))
    assert found(simhash_dedup(df)) == brute(texts, ids)
    kept = without_near_copies(df)
    assert kept.columns == df.columns
    parts = {c for _, _, c in brute(texts, ids)}
    assert {r["doc_id"] for r in kept.collect()} == parts and kept.count() == len(parts)
    assert rows(simhash_dedup(df.limit(0))) == [] and rows(without_near_copies(df.limit(0))) == []


def test_repeated_rows_leave_one(spark):
    df = documents(spark, ["a b c d"] * 3 + ["x y z"], ids=[4, 4, 7, 4])
    assert sorted(r["text"] for r in without_near_copies(df).collect()) == ["a b c d", "x y z"]
    nulls = documents(spark, ["a b c d"] * 3, ids=[None] * 3)
    assert without_near_copies(nulls).count() == 1


def test_long_text_in_blocks():
    text = (" ".join(f"w{i % 97}" for i in range(1000))).encode()
    assert simhash(text, 3, 42, block=64) == simhash(text, 3, 42) == plain(text.decode())


@pytest.mark.parametrize("most", [1, 3, 64])
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_connect_what_is_close(spark, most, bits):
    rng = random.Random(bits)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values)[:12]:
        for _ in range(6):
            w = v
            for b in rng.sample(range(64), rng.randrange(1, 4)):
                w ^= 1 << b
            values.add(w)
    signed = sorted(v - (1 << 64) if v >= 1 << 63 else v for v in values)
    root = groups(len(signed), lambda i, j: ((signed[i] ^ signed[j]) & (1 << 64) - 1).bit_count() <= bits)
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {r["id"]: r["component"] for r in components(near_links(prints, bits, most=most)).collect()}
    assert [got.get(v, v) for v in signed] == [signed[r] for r in root]


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 1100)]
    got = dict(rows(components(spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long"))))
    assert all(got[i] == 0 for i in range(301)) and got[5000] == got[1050] == 1000 and len(got) == 301 + 201
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
