import base64
import hashlib

from orderloom.llm import warc as W
from orderloom.session import scratch_path


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def fake_record(payload="x", length=None):
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: "
            f"{len(payload) if length is None else length}\r\n\r\n{payload}\r\n\r\n")


PAGES = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>"), (None, "u", "null id"),
         (None, "v", "null id"), (5, "u", "null id"), (6, "u", "a" + fake_record() + fake_record("y" * 50) + "z"),
         (7, "u", "WARC/1.1\r\n"), (8, "u", fake_record(length=10**9)), (9, "u", fake_record(length=3)), (10, "u", "WARC/1.1\r\nno head"),
         (11, "u", "\r\n\r\n" * 5), (12, "u", "long " * 60_000 + fake_record() * 3), (13, "u", fake_record() * 2000), (1, "u", "other payload")]


def brute(pages, min_bytes=0):
    key = lambda i: 2**63 - 1 if i is None else i
    out = []
    for i, _, h in pages:
        n = len((h or "").encode())
        first = min((key(j) for j, _, g in pages if (g or "") == (h or "")), default=None) if n >= min_bytes else key(i)
        revisit = first != key(i)
        out.append((i, n, digest(h), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def round_trip(spark, pages, **options):
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id bigint, url string, html string, digest string")
    path = scratch_path(spark, "test-warc")
    W.write_warc(df.repartition(2), path, **options)
    return path, sorted((tuple(r) for r in W.page_records(W.read_warc(spark, path)).collect()), key=repr)


def test_round_trip_with_magic_in_payloads(spark):
    path, found = round_trip(spark, PAGES)
    assert found == brute(PAGES)
    assert round_trip(spark, PAGES, min_bytes=9)[1] == brute(PAGES, 9)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")  # many splits in a file, records across them
    try:
        assert sorted((tuple(r) for r in W.page_records(W.read_warc(spark, path)).collect()), key=repr) == brute(PAGES)
        whole = W.read_warc(spark, path, with_payload=True).collect()
        bodies = [r.payload.decode() for r in whole if r.fields["warc-type"] == "response"]
        assert sorted(bodies) == sorted(h or "" for (i, _, h), b in zip(sorted(PAGES, key=repr), range(99))
                                        if (i, len((h or "").encode()), digest(h), "response", None) in brute(PAGES))
        for r in whole:
            if r.fields["warc-type"] == "response":
                assert r.fields["warc-payload-digest"] == "sha1:" + r.payload_digest == "sha1:" + digest(r.payload.decode())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_table(spark):
    assert round_trip(spark, PAGES[:0])[1] == []


def test_a_broken_chain_ends(spark, tmp_path):
    good = fake_record("a") + fake_record("b")
    (tmp_path / "x.warc").write_bytes((good + fake_record("c", 5) + fake_record("d")).encode())
    assert W.read_warc(spark, str(tmp_path)).count() == 3  # the third claims to end inside the fourth, which is not reached


def test_whole_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    import __spark_entry__ as E
    found = sorted((tuple(r) for r in E.queries()["op10_warc"](spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert found == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
