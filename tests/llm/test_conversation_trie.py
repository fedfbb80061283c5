"""The trie of conversations against a dictionary of prefixes, over many task boundaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("tidewheel.llm")
from tidewheel.llm import conversation_trie as trie  # noqa: E402
from tidewheel.llm import queries  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, depth int, keys string"


def rebuilt(rows):
    own = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - int(np.fmod(c, 5))
        out[c] = own.get(head, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p, held in members.items():
        gain = (len(held) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += gain
    rows = []
    for p, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(p))
        rows.append((
            min(held), len(p), min(members[p[:-1]]) if p else None, len(held), children[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def build(spark, rows, partitions):
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    return trie.prefix_trie(trie.with_shared_heads(trie.sequences(turns)), partitions)


@pytest.fixture(scope="module")
def conversations():
    r = random.Random(4)
    rows = [(None, 0, "user", "lost"), (3, None, None, None), (3, 2, "user", "é"), (3, 2, "user", "a"), (3, 2, "user", "a")]
    for c in range(-12, 150):
        for t in range(r.choice([0, 1, 2, 4, 9, 12])):
            rows.append((c, t, r.choice(["user", "bot"]), r.choice("ab") * r.choice([1, 1, 1, 3])))
    hot = [("user", "hello"), ("bot", "hi"), ("user", "bye")]
    for c in range(200, 330):  # one conversation that very many repeat, and some go on
        for t, (role, text) in enumerate(hot * 4):
            rows.append((c, t, role, text))
        if c % 7 == 0:
            rows.append((c, 99, "bot", f"end {c % 3}"))
    rows += [(1000, t, "user", str(t)) for t in range(700)]
    return rows


@pytest.mark.parametrize("partitions,fan", [(1, 64), (9, 64), (60, 2), (60, 3)])
def test_equals_prefixes(spark, conversations, partitions, fan, monkeypatch):
    monkeypatch.setattr(trie, "FAN", fan)
    monkeypatch.setattr(trie, "PIECE", 3)
    if fan == 3:
        monkeypatch.setattr(trie, "BROADCAST_ROWS", 0)
    got = build(spark, conversations, partitions)
    assert got.columns == [c.split()[0] for c in trie.NODE.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(conversations))


@pytest.mark.parametrize("seed", range(60))
def test_union_find_gives_the_branchings(seed):
    r = random.Random(seed)
    paths = sorted("".join(r.choice("ab") for _ in range(r.randint(0, 6))) for _ in range(r.randint(1, 12)))
    lcp = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    lcps = np.array([0] + [lcp(a, b) for a, b in zip(paths, paths[1:])])
    tree = trie.branchings(np.array([len(p) for p in paths]), lcps)
    chains = []
    for x in range(len(tree.depth)):
        inside = paths[tree.first[x] : tree.last[x] + 1]
        for d in range(tree.top[x] + 1, tree.depth[x] + 1):
            prefix = inside[0][:d]
            assert [p for p in paths if p[:d] == prefix and len(p) >= d] == inside
            chains.append((d, prefix))
    assert sorted(chains) == sorted({(d, p[:d]) for p in paths for d in range(len(p) + 1)})
    assert all(paths[i] == paths[tree.first[x]][: tree.depth[x]] for i, x in enumerate(tree.own))


def test_repeated_turns_and_one_conversation(spark):
    rows = [(0, 1, "u", "x")] * 3
    assert sorted(map(tuple, build(spark, rows, 4).collect()), key=str) == brute(rebuilt(rows))


def test_empty_table(spark, conversations):
    turns = spark.createDataFrame(conversations[:1], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(trie.with_shared_heads(trie.sequences(turns))).collect() == []


def test_registered_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op12_prefix_trie(spark, sf_dir).collect()), key=str) == brute(rebuilt(rows))
