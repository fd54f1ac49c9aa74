import pytest

from orderloom.llm import mixing

from cases import ROWS, collected, rows


def filled(sizes, weights, epochs):
    """Targets by plain repeated sharing."""
    total, capped = sum(sizes.values()), {}
    while True:
        left, open_ = total - sum(capped.values()), {s: w for s, w in weights.items() if s not in capped}
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()} if open_ else {}
        over = [s for s, x in share.items() if x > epochs * sizes[s] + 1e-9]
        if not over:
            return share | capped
        capped |= {s: epochs * sizes[s] for s in over}


def check(got, epochs=3):
    sizes, taken, target, largest = {}, {}, {}, {}
    for r in got:
        s = r.doc.source
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.size * r.reps
        target[s] = r.target
        largest[s] = max(largest.get(s, 0), r.size)
        assert 0 <= r.reps <= epochs
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    expected = filled(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, epochs)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    return sizes


def test_targets_and_repetitions(spark):
    docs = rows(spark, clash=("size", "draw", "key", "reps", "target", "doc", "rest"))
    first = mixing.mix_documents(docs)
    sizes = check(first.collect())
    assert set(sizes) == {"a", "b", "z", "ü", None}
    assert collected(first) == collected(mixing.mix_documents(docs.repartition(5)))  # reruns agree


def test_many_documents_come_near_the_target(spark):
    data = [(i, "w " * (1 + i % 7), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(3000)]
    check(mixing.mix_documents(rows(spark, data)).collect())


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_documents(rows(spark, [])).collect() == []
    got = mixing.mix_documents(rows(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert {(r.size, r.target, r.reps) for r in got} <= {(0, 0.0, 0), (0, 0.0, 1)}


def test_no_python_on_the_main_path(spark):
    plan = mixing.mix_documents(rows(spark)).select("size", "reps")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert len(ROWS) == mixing.mix_documents(rows(spark)).count()
