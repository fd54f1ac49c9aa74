import hashlib
import math
import zlib

import pytest

from orderloom.llm import prefix_trie as P

from cases import collected


def conversations(spark, data, clash=()):
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    for name in clash:
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def brute(data):
    """The contract in plain Python: every prefix of every rebuilt conversation in a dict."""
    ident = lambda c: P.NULL_ID if c is None else c
    turns = {}
    for c, turn, role, text in data:
        digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
        turns.setdefault(ident(c), []).append(((turn is not None, turn or 0), role or "", f"{digest}:{len(text or '')}", text or ""))
    plain = {c: [(r, t) for _, r, _, t in sorted(rows)] for c, rows in turns.items()}
    whole = {}
    for c, own in plain.items():
        h = 0 if c == P.NULL_ID else zlib.crc32(str(c).encode()) % 6
        whole[c] = (plain.get(c - int(math.fmod(c, 100)), [])[:h] if c != P.NULL_ID else []) + own[h:]
    nodes = {}
    for c, own in whole.items():
        for d in range(len(own) + 1):
            nodes.setdefault(tuple(own[:d]), []).append(c)
    children, leaves, saved = ({n: 0 for n in nodes} for _ in range(3))
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    for n, members in nodes.items():
        value = (len(members) - 1) * len(n[-1][1]) if n else 0
        for d in range(len(n) + 1):
            saved[n[:d]] += value
            leaves[n[:d]] += not children[n]
    out = lambda c: None if c == P.NULL_ID else c
    found = []
    for n, members in nodes.items():
        ended = ",".join("null" if c == P.NULL_ID else str(c) for c in sorted(members) if len(whole[c]) == len(n))
        found.append((out(min(members)), len(n), out(min(nodes[n[:-1]])) if n else None, len(members), children[n], leaves[n], saved[n],
                      hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(found, key=repr)


AWKWARD = (
    [(c, t, "user" if t % 2 == 0 else "bot", f"turn {t} of {c % 3}") for c in range(100, 130) for t in range(c % 5)]
    + [(200, 0, "user", "hello"), (200, 1, "bot", "é😀 hello")]                         # fewer turns than most heads
    + [(c, t, "user", "own") for c in (201, 202, 203, 204, 205) for t in range(9)]
    + [(399, t, "user", f"no first one {t}") for t in range(7)]                          # conversation 300 is absent
    + [(7, None, None, None), (7, None, None, None), (7, 3, "user", "tie b"), (7, 3, "user", "tie a"), (7, 3, "bot", "tie")]
    + [(None, 1, "user", "of nobody"), (None, 0, None, "x"), (-5, 0, "user", "negative"), (-100, 0, "user", "x"), (-150, 1, "user", "y")]
    + [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "a", "b" * 40_000)]
)


def test_awkward_rows(spark):
    got = collected(P.prefix_trie(conversations(spark, AWKWARD, clash=("node", "d", "depth", "t1", "conv", "tid", "range", "pos"))))
    assert got == brute(AWKWARD)


def test_long_conversations_pass_several_blocks(spark):
    # 150 turns shared by some, a fork in the second, third and fourth block, ends at block borders, paths of one alone
    base = lambda n, tail=(): [*(f"line {i}" for i in range(n)), *tail]
    texts = {600: base(150), 601: base(150), 602: base(150, ["fork"] * 40), 603: base(60, ["other"] * 5), 604: base(8), 605: base(40),
             606: base(41), 607: base(72), 608: base(73, ["last"]), 609: ["alone"] * 300, 610: ["alone"] * 8, 611: base(150, ["fork"] * 40)}
    data = [(c, i, "user", x) for c, own in texts.items() for i, x in enumerate(own)]
    assert collected(P.prefix_trie(conversations(spark, data))) == brute(data)


@pytest.mark.parametrize("copies", [P.CHUNK + 5])
def test_hot_conversation_and_first_turn(spark, copies, monkeypatch):
    data = [(1000 * i, t, "user", f"same {t}") for i in range(copies) for t in range(2)]
    data += [(1000 * i + 500, t, "user", f"{t} {i}" if t else "same 0") for i in range(300) for t in range(3)]
    assert collected(P.prefix_trie(conversations(spark, data))) == brute(data)


def test_ranges_number_one_long_conversation(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = P.numbered(conversations(spark, [(1, i, "user", f"t{i}") for i in range(2000)] + [(2, 0, "user", "x")])).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.pos for r in rows if r.conv == 1) == list(range(2000))
    first = {r.pos: r.tid for r in rows if r.conv == 1}
    assert all(first[i].split(":")[0] == hashlib.md5(f"4:usert{i}".encode()).hexdigest() for i in range(2000))


def test_empty_table(spark):
    assert P.prefix_trie(conversations(spark, [])).collect() == []
