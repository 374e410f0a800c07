from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hazardgrid.llm.queries import tokenizer
from hazardgrid.llm.token_counts import MergeTable, Tokens, token_counts

from .helpers import clashing, documents, rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


@pytest.fixture(scope="module")
def tokens():
    return Tokens(MergeTable(tokenizer()))


def ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


POOL = [*"aAbzÉéß'sStreVEmlld09²½.,!-—_…🙂日本語한국어Σσςİıŉ  \u0085​ \t\n\r\x0b\x0c\x1f\x00<|>", "é", "<|endoftext|>", "'re", "''s", "aaaaaa", "!!!!", "µªº", "ʹ;", "Жй", "ﬁẞ"]


def test_any_text(library, tokens):
    rng = random.Random(3)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randrange(40))) for _ in range(4000)]
    wanted = ids(library, texts)
    assert [x.tolist() for x in tokens.ids(pa.array(texts))] == wanted
    assert tokens.counts(pa.array(texts)).tolist() == [len(x) for x in wanted]


def test_every_code_point(library, tokens):
    chars = [chr(c) for c in range(0x3000) if not chr(c).isspace()]
    texts = [t for c in chars for t in (c, f"a{c}b")]
    assert [x.tolist() for x in tokens.ids(pa.array(texts))] == ids(library, texts)


def test_punctuation_is_merged_here(library, monkeypatch):
    merging = Tokens(MergeTable(tokenizer()))
    monkeypatch.setattr(merging, "library", None)
    texts = ["“It’s 5 € – or ‘more’…”", "don’t—stop†‡• 1‰ a‑b ‹x› ₽₴ „ja“", "‘’“”—––…€€€" * 9, "naïve‘s ’re ''’s"]
    assert [x.tolist() for x in merging.ids(pa.array(texts))] == ids(library, texts)


def test_runs_of_one_symbol(library, tokens):
    texts = [c * n for c in "ao!=é" for n in range(1, 70)]
    assert tokens.counts(pa.array(texts)).tolist() == [len(x) for x in ids(library, texts)]


def test_merge_of_empty_words():
    table = MergeTable(tokenizer())
    flat, edges = table.merge(np.frombuffer(b"thecat", np.uint8), np.array([0, 0, 3, 3, 6]))
    assert edges.tolist()[:2] == [0, 0] and edges[2] == edges[3] and len(flat) == edges[-1]


def test_cases(spark, library):
    texts = [None, "", " \n", "one two", "one two", "Ünïcode 12", "x" * 30000 + " end", "word " * 60000]
    df = clashing(documents(spark, texts))
    found = rows(token_counts(df, tokenizer(), keep=("doc_id",)))
    wanted = ids(library, texts)
    assert found == [(i, len((t or "").encode()), len(w)) for i, (t, w) in enumerate(zip(texts, wanted, strict=True))]
    assert rows(token_counts(df.limit(0), tokenizer(), keep=("doc_id",))) == []


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    wanted = dict(zip(texts, map(len, ids(library, texts.values())), strict=True))
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, tokenizer(), keep=("doc_id",)).collect()} == wanted
