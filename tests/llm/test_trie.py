"""Conversation tries against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidewell.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth bigint, h1 string, words string, kids string, c string, n bigint, run string, base string"
EXTRA = (0, "h", "w", "k", "c", 0, "r", "b")


def conversations(seed: int, n: int = 70, deep: int = 6) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(90), n):
        for turn in range(rng.choice([1, 2, 3, deep])):
            rows.append((c, turn or None, rng.choice(["user", "user", None]), rng.choice(["a", "a", "a b c", "", None, "\x1cé x"])))
    return rows


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple]]:
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    return {c: own.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + turns[h:] for c, turns in own.items()}


def brute(convs: dict[int, list[tuple]]) -> set[tuple]:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for prefix, own in members.items():
        d = len(prefix)
        below = [p for p in members if p[:d] == prefix]
        leaf = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)]
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == d)
        out.add((
            min(own), d, min(members[prefix[:-1]]) if d else None, len(own), sum(len(p) == d + 1 for p in below), len(leaf),
            sum((len(members[p]) - 1) * len(p[-1][1].encode().split()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def run(spark, rows):
    turns = trie.ordered_turns(spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA))
    return trie.prefix_trie(*queries.shared_openings(turns))


def test_trie(spark):
    rows = conversations(1)
    found = [tuple(r) for r in run(spark, rows).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rebuilt(rows))


def test_trie_of_long_conversations_in_runs(spark, small_tasks, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 2)
    rows = [(c, t, "user", f"t{t // 2} {t % (c + 2)}") for c in range(0, 60, 20) for t in range(130)] + [(c, t, "user", f"t{t}") for c in range(60, 79) for t in range(3)]
    assert {tuple(r) for r in run(spark, rows).collect()} == brute(rebuilt(rows))


def test_empty_and_odd_conversations(spark):
    assert run(spark, []).collect() == []
    rows = [(None, 0, "user", "x"), (7, None, None, None), (7, None, None, None), (40, 2, "user", "x y"), (40, 1, "user", "x y")]
    odd = run(spark, rows).collect()
    convs = rebuilt([r for r in rows if r[0] is not None])
    assert {tuple(r) for r in odd} == brute(convs)


def test_turns_with_equal_numbers_have_one_order(spark):
    rows = [(c, 1, "user", t) for c in (20, 40) for t in ("a", "b", "c")]
    there = {(r.conv_id, r.depth): r.n_convs for r in run(spark, rows).collect()}
    back = {(r.conv_id, r.depth): r.n_convs for r in run(spark, rows[::-1]).collect()}
    assert there == back


def totals(nodes: dict[int, int | None], value: dict[int, int]) -> dict[int, tuple[int, int]]:
    children = defaultdict(list)
    for n, up in nodes.items():
        children[up].append(n)
    out = {}
    for n in sorted(nodes, reverse=True):
        below = [out[k] for k in children[n]]
        out[n] = (sum(b[0] for b in below) or int(not below), value[n] + sum(b[1] for b in below))
    return out


@pytest.mark.parametrize("shape", ["chain", "caterpillar", "random"])
def test_subtree_totals(spark, shape):
    rng = random.Random(5)
    up = {"chain": lambda i: i - 1, "caterpillar": lambda i: (i - 1) // 2 * 2, "random": lambda i: rng.randrange(max(0, i - 9), i)}[shape]
    nodes = {0: None} | {i: up(i) for i in range(1, 180)}
    value = {i: rng.randrange(100) for i in nodes}
    kids = defaultdict(int)
    for p in nodes.values():
        kids[p] += 1
    depth = {}
    for i in nodes:
        depth[i] = depth[nodes[i]] + 1 if i else 0
    rows = [(i, depth[i], p, None if p is None else depth[p], kids[i], int(not kids[i]), value[i]) for i, p in nodes.items()]
    tree = spark.createDataFrame(rows, "c bigint, d bigint, up_c bigint, up_d bigint, kids bigint, leaves bigint, saved bigint")
    assert {r.c: (r.leaves, r.saved) for r in trie.subtree_totals(tree).collect()} == totals(nodes, value)
