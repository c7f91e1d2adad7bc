"""The trie against a dictionary of prefixes, for any number of shards; find_close against a stack."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from tallywork.llm import oracles, prefix_trie, registered

DICE = random.Random(11)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, shard int, path string, open int"


def balanced(n):
    """A random balanced string of 2n parentheses."""
    out, level, left = [], 0, n
    while left or level:
        if left and (level == 0 or DICE.random() < 0.55):
            out.append(True)
            level, left = level + 1, left - 1
        else:
            out.append(False)
            level -= 1
    return np.array(out)


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 500, 3000])
@pytest.mark.parametrize("block", [2, 4, 64])
def test_find_close(n, block):
    deep = np.array([True] * n + [False] * n)
    flat = np.array([True, False] * n)
    for bits in (balanced(n), deep, flat, np.concatenate([[True], balanced(n), [False]])):
        stack, close = [], {}
        for at, opens in enumerate(bits):
            if opens:
                stack.append(at)
            else:
                close[stack.pop()] = at
        opening = np.flatnonzero(bits)
        assert prefix_trie.Parentheses(bits, block).find_close(opening).tolist() == [close[at] for at in opening]


def plain(paths):
    """paths: conv_id -> list of (name, size)."""
    members = {}
    for conv_id, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(conv_id)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own) - 1) * node[-1][1] if node else 0
    out = []
    for node, own in members.items():
        ended = ",".join(str(conv_id) for conv_id in sorted(own) if len(paths[conv_id]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def lists(spark, paths):
    rows = [(conv_id, [(i, hashlib.md5(name.encode()).hexdigest(), size) for i, (name, size) in enumerate(path)]) for conv_id, path in paths.items()]
    return spark.createDataFrame(rows, "conv_id bigint, turns array<struct<turn: bigint, hash: string, size: int>>")


def drawn(n, names, most):
    return {i * 3 + 1: [(name := DICE.choice(names), 10 + len(name) * ord(name[0]) % 7) for _ in range(DICE.randint(0, most))] for i in range(n)}


@pytest.mark.parametrize("turns_per_shard", [1, 7, 40, 1 << 17])
def test_any_number_of_shards_gives_the_dictionary(spark, turns_per_shard):
    paths = drawn(70, ["a", "b"], 6)
    paths |= {1000 + i: [("a", 11), ("b", 12), ("a", 11)] for i in range(40)}
    paths |= {2000: [("a", 11)] * 60, 2001: [("a", 11)] * 55 + [("c", 9)], 2002: []}
    sizes = {}
    paths = {c: [(name, sizes.setdefault(name, size)) for name, size in path] for c, path in paths.items()}
    got = prefix_trie.trie(lists(spark, paths), turns_per_shard)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(paths)


def test_shards_one_by_one_add_up():
    """Without Spark: each cut of the sorted paths gives the same sums."""
    paths = sorted({tuple(DICE.choice("ab") for _ in range(DICE.randint(0, 7))) for _ in range(60)})
    raw = sorted((b"".join(hashlib.md5(name.encode()).digest() for name in path), [len(path)] * len(path), 1, i, "x") for i, path in enumerate(paths))
    whole = prefix_trie.shard_nodes(raw)
    expected = {key: row for key, *row in zip(whole["key"], whole["n_convs"], whole["n_children"], whole["n_leaves"], strict=True)}
    for cut in range(1, len(raw)):
        sums = {}
        for part, before, after in ((raw[:cut], None, raw[cut][0]), (raw[cut:], raw[cut - 1][0], None)):
            found = prefix_trie.shard_nodes(part, before, after)
            for key, *row in zip(found["key"], found["n_convs"], found["n_children"], found["n_leaves"], strict=True):
                sums[key] = [a + b for a, b in zip(sums.get(key, [0, 0, 0]), row, strict=True)]
        assert sums == expected


def rebuilt(rows):
    """The splicing of the query as a loop."""
    own = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(f"{len(role)}:{role}{text}", len(text.encode())) for *_, role, text in sorted(x)] for c, x in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + mine[h:]
    return out


def result(spark, path, rows):
    spark.createDataFrame([(*row, "k", 1, "p", 2) for row in rows], SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return sorted(map(tuple, registered.op11_prefix_trie(spark, str(path)).collect()), key=repr)


def test_query_is_the_loop_on_odd_rows(spark, tmp_path):
    rows = [(c, t, DICE.choice(["user", "assistant"]), DICE.choice(["yes", "no", "Größe"])) for c in range(60) for t in range(DICE.randint(1, 12)) if c % 10 != 5]
    rows += [(61, None, "user", "first"), (61, 0, None, None), (61, 1, "", ""), (62, None, None, None), (None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(63, t, "user", "z" * 100_000 if t == 5 else "a") for t in range(300)]
    # Turns that repeat are alike here: rows that differ under one number have no order of their own.
    rows += [(64, 2, "user", "twice"), (64, 2, "user", "twice")]
    assert result(spark, tmp_path, rows) == plain(rebuilt(rows))


def test_query_is_its_sql_on_odd_rows(spark, tmp_path):
    rows = [(c, t, "user", DICE.choice(["yes", "no", None])) for c in range(80) for t in range(c % 13) if c % 10 != 5]
    got = result(spark, tmp_path, rows)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{tmp_path}/conversations.parquet/*.parquet'")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got == sorted(duck.execute(f"SELECT {', '.join(names)} FROM ({oracles.ORACLES['op11_prefix_trie']})").fetchall(), key=repr)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversation_no_node(spark, tmp_path, rows):
    assert result(spark, tmp_path, rows) == []
