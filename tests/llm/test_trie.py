"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from tests.llm import tables
from tests.oracle_check import compare, duck
from tidemark.llm import trie
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256".split(", ")


def plain(rows) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, key, (role, text)))
    turns = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in turns.items():
        h = tables.crc(c) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = tuple(turns.get(family, [])[:h] + ts[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[p] for p in below) or 1
        chars = len(path[-1][1]) if path else 0
        saved[path] = (len(members[path]) - 1) * chars + sum(saved[p] for p in below)
    return sorted(
        (
            (
                min(m),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(m),
                len(children[path]),
                leaves[path],
                saved[path],
                hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
            )
            for path, m in members.items()
        ),
        key=str,
    )


def found(df) -> list[tuple]:
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def odd_turns() -> list[tuple]:
    draw = random.Random(13)
    rows = [(0, 0, "user", "hi"), (0, 1, "bot", "yo"), (0, None, None, None), (0, None, "user", "z"), (None, 0, "user", "hi")]
    rows += [(-7, 1, "bot", "é" * 50), (-100, 1, "bot", "é"), (305, 0, "a", "b"), (305, 0, "ab", ""), (305, 0, "ab", "")]
    for c in [*range(1, 60), *range(400, 520), 70_000, 70_001, 1 << 40]:
        for t in range(draw.randint(1, 9)):
            rows.append((c, t, draw.choice(["user", "bot"]), draw.choice(["a", "bb", "ccc"]) if t < 4 else f"{c}-{t}"))
    rows += [(c, t, "user", "same") for c in range(600, 700) for t in range(8)]
    return rows


@pytest.mark.parametrize("shard_turns,queue", [(100_000, 100_000), (20, 3), (1, 1)])
def test_trie_like_a_dictionary(spark, shard_turns, queue):
    rows = odd_turns()
    turns = trie.rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found(trie.prefix_trie(turns, shard_turns, queue)) == plain(rows)


def test_rebuilt_turns_of_a_missing_family_head(spark):
    # h of 305 is greater than its number of turns, and 300 is absent: no turns, but a member of the root
    c = next(c for c in range(301, 400) if tables.crc(c) % 6 == 5)
    rows = [(c, 0, "user", "x")]
    assert found(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == plain(rows)


def test_no_conversations(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA))).count() == 0


def test_extra_columns_do_not_matter(spark):
    rows = odd_turns()[:40]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("depth", "key", "chars", "size", "place", "family", "shared", "node", "heads"):
        df = df.selectExpr("*", f"'mine' AS {name}")
    assert found(trie.prefix_trie(trie.rebuilt(df))) == plain(rows)


def test_query_like_sql_and_dictionary(spark):
    folder = "/root/testdata/sf0.01"
    df = QUERIES["op13_prefix_trie"](spark, folder)
    con = duck(folder)
    assert compare(df, con, ORACLES["op13_prefix_trie"]) == ""
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(df) == plain(rows)


def test_queue_spills_in_order():
    draw = random.Random(1)
    for limit in (1, 3, 50, 1000):
        queue, held = trie.SpillingQueue(limit), []
        for _ in range(600):
            if held and draw.random() < 0.4:
                assert queue.peek() == min(held)
                held.remove(queue.pop())
            else:
                entry = (draw.randrange(40), bytes([draw.randrange(4)]), draw.randrange(3), 0)
                queue.push(entry)
                held.append(entry)
        assert [queue.pop() for _ in held] == sorted(held) and queue.peek() is None
