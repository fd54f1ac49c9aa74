import math

import numpy as np
import pytest

from orderloom.llm import embed_dedup as E

from test_near_dedup import smallest


def brute(data, cosine=0.95):
    good = []
    for d, v in data:
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append((2**63 - 1 if d is None else d, np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None))
    links, counts = [], [0] * len(good)
    for i, (a, x) in enumerate(good):
        for j, (b, y) in enumerate(good[:i]):
            if x is not None and y is not None and len(x) == len(y) and x @ y >= cosine:
                links.append((a, b))
                counts[i] += 1
                counts[j] += 1
    label = smallest({d for d, _ in good}, links)
    return sorted((d, n, label[d]) for (d, _), n in zip(good, counts))


def got(df, **options):
    return sorted(tuple(r) for r in E.near_duplicates(df, **options).collect())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_awkward_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.25, 0.0]), (4, None), (5, []),
            (6, [0.0, 0.0, 0.0]), (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [None, 1.0, 0.0]), (None, [0.0, 3.0, 0.5]),
            (None, None), (10, [1.0, 0.0]), (11, [5.0, 0.0]), (12, [-1.0, 0.0, 0.0]), (13, [0.0, 1.0, -0.0]), (2, [2.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "clash", 7) for r in data], f"vec_id bigint, embedding array<{kind}>, rep string, n int")
    assert got(df) == brute(data)
    assert got(df.limit(0)) == []


def test_small_blocks_against_brute_force(spark):
    draw = np.random.RandomState(2)
    centers = draw.randn(40, 16)
    data = [(int(i), (centers[draw.randint(40)] + draw.randn(16) * draw.choice([0.02, 0.15, 0.3, 1])).tolist()) for i in range(900)]
    data += [(1000 + i, data[5][1]) for i in range(100)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    assert got(df, block=32, leaf=8) == brute(data)


def test_intervals_inside_a_task():
    draw = np.random.RandomState(4)
    for spread in (0.01, 0.05, 0.2, 1.0):  # from one ball, joined as a whole, to nothing linked
        x = E.unit(draw.randn(1, 12) + draw.randn(700, 12) * spread)
        x = x[np.argsort(x[:, 0])]
        n = draw.randint(1, 5, 700)
        interval = lambda s: E.Interval(np.arange(700)[s], np.arange(700)[s], n[s], x[s], x[s], 64)
        near = x @ x.T >= 0.95
        np.fill_diagonal(near, False)
        a, b = interval(slice(0, 400)), interval(slice(400, 700))
        degrees = np.zeros(700, int)
        links = []
        for p, q in ((a, a), (b, b), (a, b)):
            found, forest = E.join_intervals(p, q, 0.95)
            links += forest
            for i, d in found.items():
                degrees[i] += d
        assert (degrees == near @ n).all()
        assert all(near[i, j] for i, j in links) or spread == 0.01
        assert smallest(range(700), links) == smallest(range(700), list(zip(*map(list, np.nonzero(near)))))


def test_whole_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == brute(data)
