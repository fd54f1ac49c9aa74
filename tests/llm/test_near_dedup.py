import random
import re

import numpy as np

from orderloom.llm import near_dedup as N
from orderloom.llm.components import connected_components

from cases import ROWS, rows


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def smallest(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def brute(data, percent=85):
    sets = [(2**63 - 1 if d is None else d, shingles(t)) for d, t in data]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    label = smallest({d for d, _ in sets}, links)
    return sorted((d, len(s), label[d]) for d, s in sets)


def got(df):
    return sorted(tuple(r) for r in N.near_duplicates(df).collect())


def test_awkward_rows(spark):
    data = ROWS + [(2, "another text under the same id as a row above", "en", "a"), (40, "another text under the same id as a ROW above", "en", "a")]
    assert got(rows(spark, data, clash=("id", "fp", "keys", "component", "rep"))) == brute([(r[0], r[1]) for r in data])
    assert got(rows(spark, [])) == []


def test_large_group_around_the_threshold(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    data = []
    for i in range(700):  # edits put the similarity to the base on both sides of the threshold
        w = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3, 4])):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
        data.append((i, " ".join(w), "en", "a"))
    data += [(1000 + i, " ".join(f"u{i}x{j}" for j in range(30)), "en", "a") for i in range(50)]
    assert got(rows(spark, data)) == brute([(r[0], r[1]) for r in data])


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = got(docs)
    assert found == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i, _, c in found if i == c)


def test_super_minhash_is_the_element_by_element_algorithm():
    draw = np.random.RandomState(5)
    for n in (1, 2, 7, 40, 300):
        own = np.unique(draw.randint(0, 2**62, n).astype(np.uint64))
        slots = 16
        expected = [(slots, 0)] * slots
        for h in own:
            p = list(range(slots))
            for j in range(slots):
                one = np.array([h], np.uint64)
                pick = int(N.mix(one + np.uint64((2 * j + 1) * N._STEP % 2**64))[0])
                value = int(N.mix(one + np.uint64((2 * j + 2) * N._STEP % 2**64))[0]) >> 8
                k = j + ((pick >> 32) * (slots - j) >> 32)
                p[j], p[k] = p[k], p[j]
                expected[p[j]] = min(expected[p[j]], (j, value))
        assert N.super_minhash([own], slots)[0].tolist() == [(j << 56) | v for j, v in expected]


def test_signature_estimates_similarity():
    draw = np.random.RandomState(6)
    errors = []
    for _ in range(200):
        shared = np.unique(draw.randint(0, 2**62, 300).astype(np.uint64))
        a, b = (np.unique(draw.randint(0, 2**62, 30).astype(np.uint64)) for _ in range(2))
        x, y = np.union1d(shared, a), np.union1d(shared, b)
        s = N.super_minhash([x, y])
        errors.append((s[0] == s[1]).mean() - len(shared) / (len(shared) + 60))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(200)] + [(1500, 1001 + i) for i in range(50)]
    links = chain + star + [(2000, 2000), (3000, 2999), (2999, 3000)]
    found = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    links = [p for p in links if p[0] != p[1]]       # a link to itself makes no node
    expected = smallest({x for p in links for x in p}, links)
    assert found == expected
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_rows_are_dropped_by_row_not_by_id(spark):
    own = lambda name: " ".join(f"{name}{i}" for i in range(40))
    data = [(1, own("a")), (None, own("a")), (None, own("b")), (None, own("c")), (None, own("c")),  # null ids
            (2, own("d")), (3, own("d")), (3, own("e")), (4, own("f")), (4, own("f")),             # repeated ids
            (None, None), (None, ""), (5, None)]
    kept = N.drop_near_duplicates(rows(spark, [(i, t, "en", "a") for i, t in data], clash=("row", "first", "component", "id")))
    expected = [(1, own("a")), (None, own("b")), (None, own("c")), (2, own("d")), (3, own("e")), (4, own("f")),
                (None, None), (None, ""), (5, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_members_are_those_of_buckets_that_no_earlier_band_covers(spark):
    rng = random.Random(3)
    # one id with several sets, keys that agree in runs of bands, and null keys
    data = [(i // 2, bytes([i]), [rng.randrange(2 + 3 * (j % 5)) * 10 ** 12 for j in range(N.BANDS)]) for i in range(40)]
    data += [(100 + i, bytes([100 + i]), data[7][2][:9] + [i] * (N.BANDS - 9)) for i in range(5)] + [(200, b"z" * 16, None)]
    expected = set()
    for band in range(N.BANDS):
        for key in {k[band] for _, _, k in data if k}:
            inside = [(rep, fp, k) for rep, fp, k in data if k and k[band] == key]
            if len(inside) > 1 and not any(len({k[j] for _, _, k in inside}) == 1 for j in range(band)):
                expected |= {(band, key, rep, fp, len(inside), min(r for r, _, _ in inside)) for rep, fp, _ in inside}
    classes = spark.createDataFrame(data, "rep bigint, fp binary, keys array<bigint>")
    found = N._members(classes).select("band", "key", "rep", "fp", "size", "center").collect()
    assert len(found) == len(expected) and {(b, k, r, bytes(f), n, c) for b, k, r, f, n, c in found} == expected


def test_texts_of_all_documents_are_not_shuffled_for_the_sets(spark):
    docs = rows(spark).select("doc_id", "text").withColumnRenamed("doc_id", "id")
    signed = N.signatures(docs, "text").select("doc.id", "fp")
    wanted = signed.where("id in (1, 9)").withColumnRenamed("id", "rep")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")                        # as if the planner held the ids for too many
    try:
        sets = N._sets(docs, wanted, N.WORDS)
        plan = sets._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.rep for r in sets.collect()) == [1, 9]
    finally:
        spark.conf.set(name, before)
    assert "BroadcastHashJoin [rep" in plan and "LeftSemi, BuildRight" in plan
