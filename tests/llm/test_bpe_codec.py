import hashlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazardgrid.llm.bpe_codec import Codec, bpe_decode, bpe_encode, id_count, pieces
from hazardgrid.llm.queries import op13_bpe_codec, tokenizer
from tests.llm.helpers import clashing, documents, rows


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer())


@pytest.fixture(scope="module")
def codec():
    return Codec(tokenizer())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    text = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def agree(codec, library, texts):
    ids, edges = codec.encode(pa.array(texts, pa.string()))
    for i, one in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert one.ids == ids[edges[i] : edges[i + 1]].tolist(), texts[i]


def test_every_code_point(codec, library):
    # The planes between hold ideographs and nothing else.
    points = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x20100), *range(0x2A6D0, 0x2A710), *range(0x323A0, 0x323C0), *range(0xE0000, 0xE0200), sys.maxunicode)]
    for form in ("a{0}1{0}{0}'s", "é{0}̧́x"):
        agree(codec, library, [form.format(c) for c in points])


def test_random_texts(codec, library):
    draw = random.Random(3)
    signs = "aaab'stredll12 \t.,!?-ȩ́́́ÅΣσ한각漢字अ़<|>😀  "
    agree(codec, library, ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(20000)])


def test_runs_of_one_symbol(codec, library):
    agree(codec, library, [c * n for c in ("a", "aA", "!", "-", "1", "é", "ha") for n in range(1, 70)])


def test_decoding(codec, library):
    draw = random.Random(4)
    lists = [[draw.randrange(50000) for _ in range(draw.randint(0, 30))] for _ in range(500)] + [[], [49406], [49999], [49999, 5, 49407, 99999999]]
    edges = np.r_[0, np.cumsum([len(x) for x in lists])]
    text, ends = codec.decode(np.array(sum(lists, []), np.int64), edges)
    assert [text[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_pieces_hold_the_text(codec, library):
    text = "one two  three\n" * 50 + "x" * 300 + " end"
    parts = list(pieces(pa.array([text]), 64))
    assert "".join(p[0].as_py() for p in parts) == text and max(len(p[0].as_py()) for p in parts) == 301
    assert np.concatenate([codec.encode(p)[0] for p in parts]).tolist() == library.encode(text, add_special_tokens=False).ids
    assert [p[0].as_py() for p in pieces(pa.array([""]), 64)] == [""]


def test_long_text_in_pieces(spark, library, monkeypatch):
    import hazardgrid.llm.bpe_codec as module

    monkeypatch.setattr(module, "SLICE", 1000)
    texts = ["Words and more words, " * 400, "short", "y" * 5000]
    done = bpe_decode(bpe_encode(documents(spark, texts), tokenizer()), tokenizer())
    got = rows(done.select("doc_id", id_count(), F.sha2("ids", 256), F.sha2(F.col("decoded").cast("binary"), 256)))
    assert got == [(i, *expected(library, t)) for i, t in enumerate(texts)]


def test_special_and_odd_rows(spark, library):
    texts = [None, "", " \t\n", "x<|endoftext|>y <|STARTOFTEXT|> z", "same", "same", "İstanbul ΑΣ"]
    docs = clashing(documents(spark, texts, ids=[0, 1, 2, None, 5, 5, 6]))
    done = bpe_decode(bpe_encode(docs, tokenizer()), tokenizer()).select("doc_id", id_count(), F.sha2("ids", 256), F.sha2(F.col("decoded").cast("binary"), 256))
    got = rows(done)
    want = [(i, *expected(library, t)) for i, t in zip([0, 1, 2, None, 5, 5, 6], texts, strict=True)]
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0))


def test_empty_table_and_null_ids(spark):
    empty = bpe_encode(documents(spark, []), tokenizer())
    assert empty.columns == ["doc_id", "ids"] and empty.count() == 0
    assert bpe_decode(empty, tokenizer()).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert rows(bpe_decode(nothing, tokenizer()), "decoded") == [("",)]


def test_query(spark, sf_dir, library):
    got = rows(op13_bpe_codec(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted((r.doc_id, *expected(library, r.text)) for r in docs)
