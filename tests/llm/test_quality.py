import numpy as np

from orderloom.llm import quality as Q

from cases import ROWS, crc, rows


def test_context_sums_equal_a_plain_loop(spark):
    docs = rows(spark).repartition(3)
    places, signs = Q.index_vectors()
    expected = np.zeros((Q.BUCKETS, Q.DIMS))
    for _, text, _, _ in ROWS:
        b = Q.buckets(text or "", Q.TokenCache())
        for own, other in [*zip(b, b[1:]), *zip(b[1:], b)]:
            expected[own, places[other]] += signs[other]
    assert np.allclose(Q.context_sums(docs), expected)


def test_pooling_does_not_depend_on_runs():
    vectors = np.random.RandomState(0).rand(Q.BUCKETS, Q.DIMS).astype(np.float32)
    b = np.random.RandomState(1).randint(0, Q.BUCKETS, 150_000).astype(np.int32)
    v = vectors[b]
    got = Q.pool(b, vectors)
    assert np.allclose(got[:Q.DIMS], v.mean(axis=0), atol=1e-4)
    assert np.allclose(got[Q.DIMS:2 * Q.DIMS], v.std(axis=0), atol=1e-3)
    assert np.allclose(got[2 * Q.DIMS:-1], np.abs(np.diff(v, axis=0)).sum(axis=0) / len(b), atol=1e-3)


def test_awkward_rows_and_labels(spark):
    docs = rows(spark, clash=("score", "features", "quality"))
    for labels in ([], [(1, 1), (1, None), (None, 0), (99, 1)], [(i, i % 2) for i in range(1, 12)]):
        table = spark.createDataFrame(labels, "doc_id bigint, quality int")
        got = Q.score(docs, Q.learn(docs, table)).collect()
        assert len(got) == len(ROWS) and all(0 <= r[1] <= 1 for r in got)
    assert Q.score(rows(spark, []), Q.learn(docs, table)).collect() == []


def test_held_out_accuracy(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = E.queries()["op7_quality"](spark, sf).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in got)
    test = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert len(test) > 40
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.93
