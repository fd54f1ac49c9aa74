import re

import numpy as np

from orderloom.llm import url_filter as U

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x#y", "https://example.org", "https://example.org/en/12",
        "https://notexample.org/en/12", "http://a.com/fr/x", "http://a.com/de/x", "http://com/de/", "ftp://x.net/path?q=/a#b",
        "http://x.org#frag/a", "http://a.org/b://c/d", "http://é.org/ü\n?z", "http://" + "long" * 5000 + ".net/" + "p" * 5000]


def plain(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_hosts_paths_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS * 3)], "page_id bigint, url string, verdict string")
    got = U.judge(pages).collect()
    assert len(got) == len(URLS) * 3
    for r in got:
        host, path, rule, verdict = plain(r[0].url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r[5] == verdict if rule else r[5] == ("allow" if r.probability >= 0.5 else "block")


def test_empty_table(spark):
    assert U.judge(spark.createDataFrame([], "page_id bigint, url string")).collect() == []


def test_model_tells_kinds_apart(spark):
    good = [f"http://site{i}.org/guide/page-{i}" for i in range(300)]
    bad = [f"http://casino{i}.com/de/win{i}" for i in range(300)]
    rows = [(u, "allow") for u in good] + [(u, "block") for u in bad]
    pair = U.learn(spark.createDataFrame(rows, "url string, verdict string"))
    assert (pair.probability([b"http://newsite.net/guide/page-9"])[0] > 0.5 > pair.probability([b"http://casino7.net/win3"])[0])
    grams = {(r.model, r.k, r.joined, r.alone): r.n for r in U.gram_counts(
        spark.createDataFrame([(0, u) for u in good], "kind int, url string")).collect()}
    row, slots, lengths = U._grams([u.encode() for u in good])
    assert lengths.sum() == len(row) == sum(n for (m, k, *_), n in grams.items() if k == 3)
    assert np.isclose(sum(1 for key in grams if key[1] == 0), len(set("".join(good)) | {"\0"}))


def test_scores_are_exact_whatever_the_number_of_grams(spark):
    draw = np.random.RandomState(2)
    noise = ["".join(map(chr, draw.randint(33, 127, 20_000))) for _ in range(30)]  # far more grams than 2**18
    urls = [(1, u) for u in noise] + [(0, f"http://s{i}.org/p{i % 7}") for i in range(50)]
    counted = spark.createDataFrame(urls, "kind int, url string")
    expected = {}
    for kind, u in urls:
        b = bytes(U.ORDER) + u.encode() + b"\0"
        for at in range(U.ORDER, len(b)):
            for k in range(U.ORDER + 1):
                after = expected.setdefault((kind, b[at - k:at]), {})
                after[b[at]] = after.get(b[at], 0) + 1
    counts = U.stored(U.gram_counts(counted), "test-grams")
    assert counts.where("k = 5").count() == sum(len(v) for (_, c), v in expected.items() if len(c) == 5) > 2 ** 18
    asked = [noise[0][:500], "http://s3.org/p3", "http://s99.net/q", "x"]
    rows = spark.createDataFrame(list(enumerate(asked)), "u bigint, url string")
    got = {r.u: r.score for r in U.MarkovPair(counts).scores(rows).collect()}
    for i, u in enumerate(asked):
        b, logs = bytes(U.ORDER) + u.encode() + b"\0", [0.0, 0.0]
        for kind in (0, 1):
            for at in range(U.ORDER, len(b)):
                p = 1 / 256
                for k in range(U.ORDER + 1):
                    after = expected.get((kind, b[at - k:at]))
                    if after:
                        p = (after.get(b[at], 0) + len(after) * p) / (sum(after.values()) + len(after))
                logs[kind] += np.log(p)
        assert np.isclose(got[i], (logs[0] - logs[1]) / (len(u) + 1), rtol=1e-9)
