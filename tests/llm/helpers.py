"""Small inputs and brute-force counterparts."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use themselves.
CLASHING = ("key", "size", "score", "fingerprint", "component", "kept", "target", "recipe", "row", "n", "_id", "_text", "id")


def documents(spark, texts, sources=None, ids=None):
    ids = range(len(texts)) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def groups(n, linked):
    """Smallest member of each item's component, by comparing all pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
