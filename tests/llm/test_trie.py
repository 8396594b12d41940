import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from shardsync.llm import trie
from shardsync.llm.trie import conversation_trie, number_turns

KIND = "conv_id long, turn long, role string, text string, depth int, a int, `part` string, pos int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "x", 9) for r in rows], KIND)


def said(role, text):
    role, text = role or "", text or ""
    return role, text, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text, digest = said(role, text)
            own[c].append((t is not None, t or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words[p] + sum(saved[q] for q in children[p])
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    found = conversation_trie(table(spark, rows))
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("chunk", [1024, 2])
def test_shared_beginnings_and_long_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "PIECE", 3)
    rng = random.Random(1)
    rows = []
    for c in range(90):
        for t in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 40])):
            rows.append((c, t, "user" if t % 2 else "assistant", f"say {rng.randrange(2)} now" if t < 12 else "same again"))
    rows += [(c, t, "user", f"turn {t}") for c in (200, 220, 240, 333) for t in range(50)]  # equal ones
    check(spark, rows)


def test_awkward_rows(spark):
    long = "word " * 50_000
    rows = [
        (1, None, None, None), (1, 5, "user", ""), (1, 5, "user", "b"), (1, 5, "", "userb"), (1, 5, "user", "b"),
        (None, 1, "user", "no conversation"), (-7, 1, "user", "x"), (-7, 0, "user", "y"), (-27, 3, None, "z"),
        (2**62, 1, "user", long), (3, 9, "us", "er"), (3, 10, "user", "  odd\x0bblanks\x1f"),
        *[(k, 1, "user", "only turn") for k in range(1000, 1030)],
    ]
    check(spark, rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    short = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:4]
    check(spark, [(c, t, "user", "hi") for c in short for t in range(2)])


def test_no_conversations(spark):
    assert conversation_trie(table(spark, []).limit(0)).count() == 0
    assert conversation_trie(table(spark, [(None, 1, "user", "x")])).count() == 0


def test_a_long_conversation_is_numbered_by_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("1L conv_id", "id turn", "'user' role", "string(id) text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = number_turns(rows.unionAll(rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.pos for r in found) == list(range(40_000))
    assert len({r.part for r in found}) > 4


def test_prefixes_nobody_has_are_dropped_before_they_are_grouped(spark):
    turns = number_turns(table(spark, [(1, 1, "user", "x")]))
    rolled = trie._nodes(trie._paths(turns), {"conv_id": "min(conv_id)"})
    plan = rolled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Filter CASE") < plan.index("Expand")
