import re

from orderloom.llm import line_dedup as L

from cases import BASE, ROWS, rows


def brute(data, min_chars=10):
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(strip))
    ident = lambda d: 2**63 - 1 if d is None else d
    holders = {}
    for d, t in data:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(ident(d))
    out = []
    for d, t in data:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == ident(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    many = [(20 + i, "\n".join(f"line number {j % (i + 90)}" if j % 3 else BASE for j in range(200)), "en", "a") for i in range(4)]
    same_id = [(30, "unique line of thirty\n" + BASE, "en", "a"), (30, BASE + "\n\nanother line here", "en", "a")]
    data = ROWS + many + same_id
    got = L.dedup_lines(rows(spark, data, clash=("h", "g", "doc", "row", "pos", "keep", "line", "lines")))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute([(r[0], r[1]) for r in data])


def test_bitmaps_are_sparse(spark):
    text = "\n".join(f"a line of its own {i}" for i in range(1000))
    data = [(1, BASE, "en", "a"), (2, text + "\n" + BASE, "en", "a")]
    got = L.keep_bitmaps(rows(spark, data)).collect()
    assert [(r.doc, [tuple(k) for k in r.keep]) for r in got] == [(2, [(15, ~(1 << 40))])]


def test_empty_table_and_plan(spark):
    assert L.dedup_lines(rows(spark, [])).collect() == []
    plan = L.dedup_lines(rows(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
