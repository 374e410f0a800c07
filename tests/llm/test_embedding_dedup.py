from __future__ import annotations

import numpy as np
import pytest

from hazardgrid.llm.embedding_dedup import cosine, embedding_dedup, tile_links, unit_rows

from .helpers import clashing, groups, rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, least=0.95):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(i, j):
        a, b = vectors[i][1], vectors[j][1]
        if not good(a) or not good(b) or len(a) != len(b):
            return False
        a, b = (np.asarray(np.asarray(v, np.float32), float) for v in (a, b))
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least - 1e-12

    n = len(vectors)
    root = groups(n, linked)
    least_id = {r: min(v[0] for v, q in zip(vectors, root, strict=True) if q == r) for r in set(root)}
    return sorted((vectors[i][0], sum(linked(i, j) for j in range(n) if j != i), least_id[root[i]]) for i in range(n))


def cloud(n, dim, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 3, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = np.concatenate([base, base + rng.normal(scale=spread, size=base.shape), base[:1] + rng.normal(scale=spread, size=(n // 3, dim))])
    return [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(near * rng.uniform(0.1, 9, (len(near), 1)))]


@pytest.mark.parametrize(("dim", "tile"), [(24, 4096), (24, 30), (3, 20), (1, 4), (40, 7)])
def test_against_all_pairs(spark, dim, tile):
    vectors = cloud(150, dim, seed=dim)
    found = rows(embedding_dedup(spark.createDataFrame(vectors, SCHEMA), tile=tile), "vec_id", "n_links", "component_id")
    assert found == brute(vectors)


def test_cases(spark):
    vectors = [(9, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [2.0, 0.0], 1), (6, [0.0, 0.0], 1), (7, None, 1), (8, [], 1), (10, [1.0, None], 1), (11, [1.0, float("nan")], 1), (12, [float("inf"), 0.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [-0.0, 1e-30], 1), (16, [0.0, 1e30], 1)]
    df = clashing(spark.createDataFrame(vectors, SCHEMA))
    out = embedding_dedup(df)
    assert rows(out, "vec_id", "n_links", "component_id") == brute(vectors)
    assert {r["vec_id"] for r in out.filter("kept").collect()} == {4, 6, 7, 8, 10, 11, 12, 13, 14, 15}
    assert rows(embedding_dedup(df.limit(0))) == []
    odd = spark.createDataFrame([(1, [1.0], 0), (1, [1.0], 0), (None, [1.0], 0), (None, None, 0)], SCHEMA)
    assert sorted(map(str, rows(embedding_dedup(odd)))) == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)]))


def test_doubles_on_the_threshold(spark):
    exact = [(1, [1.0, 0.0]), (2, [0.95, np.sqrt(1 - 0.95**2)]), (3, [0.9499999, np.sqrt(1 - 0.9499999**2)])]
    found = rows(embedding_dedup(spark.createDataFrame([(i, list(map(float, v))) for i, v in exact], "vec_id long, embedding array<double>")), "vec_id", "n_links")
    assert dict(found) == {1: 1, 2: 2, 3: 1}


def test_a_tie_links_whatever_else_the_table_holds(spark):
    # Length 20 and first component 19: the cosine is 0.95 and no rounding makes it less.
    a, b = [1.0, 0.0, 0.0, 0.0, 0.0], [19.0, 5.0, 3.0, 2.0, 1.0]
    assert cosine(np.array(a), np.array(b)) == 0.95 == cosine(np.array(b) * 2.0**600, np.array(a) * 2.0**-500)
    for seed in range(50):
        others = np.random.default_rng(seed).standard_normal((50, 5))
        v = np.concatenate([[a, b], others])
        u = unit_rows(v)
        turned = u @ np.linalg.eigh(np.round(u.T @ u, 6))[1][:, ::-1]
        counts, roots = tile_links(np.arange(len(v)), np.ones(len(v), int), turned, 0, 0.95, given=v)
        assert roots[0] == roots[1] and counts[0] >= 1
    for seed in range(2):
        others = np.random.default_rng(seed).standard_normal((50, 5)).tolist()
        table = spark.createDataFrame([(i, v) for i, v in enumerate([a, b, *others])], "vec_id long, embedding array<double>")
        got = {r["vec_id"]: r["component_id"] for r in embedding_dedup(table).collect()}
        assert got[0] == got[1] == 0


def test_tiles_that_meet_give_each_pair_once():
    x = np.array([[1.0, 0.0]] * 3 + [[0.0, 1.0]] * 2 + [[1.0, 0.0]] * 2)
    counts, roots = tile_links(np.arange(7), np.array([1, 1, 1, 1, 1, 5, 1]), x, 5, 0.95)
    assert counts.tolist() == [6, 6, 6, 0, 0, 3, 3] and roots.tolist() == [0, 0, 0, 3, 4, 0, 0]
    counts, roots = tile_links(np.arange(7), np.ones(7, int), x, 0, 0.95, rows=2)
    assert counts.tolist() == [4, 4, 4, 1, 1, 4, 4] and roots.tolist() == [0, 0, 0, 3, 3, 0, 0]


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"], 0) for r in table.collect()]
    assert rows(embedding_dedup(table, tile=64), "vec_id", "n_links", "component_id") == brute(vectors)
