import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from orderloom.llm.common import stored

from cases import ROWS, rows
from test_decontaminate import brute as contamination
from test_mixing import check
from test_near_dedup import brute as components
from test_tokens import _expected

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    after = {}
    for name, stage in P.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), f"test-{name}")
        after[name] = docs
        if name != "token_files":
            assert docs.columns == columns
        texts = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        if name == "language":
            assert set(ids(docs)) <= {i for i, t in texts if any(c.isalpha() for c in t or "")}
            assert docs.count() >= 0.95 * before.where(F.length("text") > 20).count()
        elif name == "near_duplicates":
            assert ids(docs) == sorted(i for i, _, c in components(texts) if i == c)
            assert docs.count() < before.count()
        elif name == "decontamination":
            dirty = {i for i, t in texts if contamination(t, items)[1]}
            assert dirty and set(ids(docs)) == {i for i, _ in texts} - dirty
        elif name == "mix":
            assert set(ids(docs)) <= set(ids(before))
            check(P.mixing.mix_documents(before).collect())
        else:
            assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in docs.collect()) == sorted(_expected(texts))
    whole = P.run(spark, SF)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, after["token_files"].collect()), key=repr)


@pytest.mark.parametrize("data", [[], ROWS])
def test_awkward_tables(spark, data, tmp_path):
    spark.createDataFrame([(1, "beta gamma")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows(spark, data, clash=("id", "doc", "reps", "_gone")).write.parquet(str(tmp_path / "documents.parquet"))
    found = P.run(spark, str(tmp_path)).collect()
    assert bool(found) == bool(data)


def test_language_stage_rejects_what_is_in_no_learned_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    draw = random.Random(4)
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
        "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı "
        "kardeşlik zihniyeti ile hareket etmelidirler.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        *(" ".join("".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(draw.randint(3, 9))) for _ in range(n)) for n in (20, 200, 2000))]
    clean = "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience."
    added = [(10**6 + i, t, "en", "a") for i, t in enumerate([*foreign, clean])]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(rows(spark, added))
    kept = set(ids(P.language(spark, both, "")))
    assert {i for i in kept if i >= 10**6} == {10**6 + len(foreign)}
    lettered = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert len(lettered - kept) <= 0.01 * len(lettered)
