import re

from orderloom.llm import decontaminate as D

from cases import BASE, ROWS, rows

ITEMS = [(10, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (9, "One, TWO!"), (9, "One, TWO!"),
         (2, None), (3, " ... "), (None, "word1x1 word2x2 word3x3"), (100, "the the"), (5, "absent words here"), (1, BASE)]


def _words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, n=10):
    w, hit, found = _words(text), set(), set()
    for item, t in items:
        v = _words(t)
        k = min(n, len(v))
        for i in range(len(v) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j:j + k] == v[i:i + k]:
                    hit |= set(range(j, j + k))
                    found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def test_against_brute_force(spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for block in (D.BLOCK_BYTES, 40):  # one block and many
        got = D.find_contamination(rows(spark, clash=("n_hit", "items", "doc")), bench, block_bytes=block).collect()
        assert len(got) == len(ROWS)
        for r in got:
            assert (r.n_words, r.n_hit, list(r["items"])) == brute(r[0].text, ITEMS), (block, r[0].doc_id)


def test_spans_and_documents(spark):
    bench = spark.createDataFrame([(1, "two three four")], "item_id bigint, text string")
    docs = rows(spark, [(1, "One two, THREE four five", "en", "a"), (2, "nothing", "en", "a")])
    got = {r[0].doc_id: r.clean_text for r in D.find_contamination(docs, bench, remove_spans=True).collect()}
    assert got == {1: "One  five", 2: "nothing"}
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r.n_hit == 0 for r in D.find_contamination(rows(spark), bench).collect())
    assert D.find_contamination(rows(spark, []), bench).collect() == []


def test_whole_small_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    first = {}
    for item, t in items:  # windows by their first two words keep the brute force short
        v = _words(t)
        for i in range(max(1, len(v) - 9)):
            first.setdefault(tuple(v[i:i + 10][:2]), []).append((item, v[i:i + 10]))
    hits = 0
    for r in D.find_contamination(docs, bench).collect():
        w, hit, found = _words(r[0].text), set(), set()
        for j in range(len(w) - 1):
            for item, v in first.get((w[j], w[j + 1]), ()):
                if w[j:j + len(v)] == v:
                    hit |= set(range(j, j + len(v)))
                    found.add(str(item))
        assert (r.n_words, r.n_hit, list(r["items"])) == (len(w), len(hit), sorted(found))
        hits += bool(hit)
    assert hits


def test_blocks_are_bounded_and_pass_one_by_one(spark, monkeypatch):
    own = [f"z{i}q" for i in range(400)]
    items = [(1, " ".join(own)), *[(2, "same words in many rows")] * 300, (3, "short item"), *[(10 + i, f"item number {i}") for i in range(40)]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    sizes, opened, most = [], [], []
    init, broadcast = D.WindowSet.__init__, type(spark.sparkContext).broadcast

    def made_of(block, rows, n):
        sizes.append(sum(len(t) for _, t in rows))
        init(block, rows, n)

    def watched(context, value):
        made = broadcast(context, value)
        if isinstance(value, D.WindowSet):
            opened.append(made)
            most.append(len(opened))
            destroy = made.destroy
            made.destroy = lambda *a: (opened.remove(made), destroy(*a))
        return made

    docs = [(1, " ".join(["a", *own[100:130], "b", *own[395:], "same words IN many rows"]), "en", "a"),
            (2, " ".join([*own[200:209], "short, item"]), "en", "a"), (2, "clean", "en", "a"), (None, None, "en", "a")]
    with monkeypatch.context() as m:
        m.setattr(D.WindowSet, "__init__", made_of)
        m.setattr(type(spark.sparkContext), "broadcast", watched)
        got = D.find_contamination(rows(spark, docs), bench, block_bytes=600).collect()
    assert len(sizes) > 3 and max(sizes) <= 600 and max(most) == 1
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, list(r["items"])) == brute(r[0].text, items)
