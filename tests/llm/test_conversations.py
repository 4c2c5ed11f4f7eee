"""The prefix trie against a plain tree, with small blocks, spans and pieces, and the cases defined."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sequences(rows, rebuild):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    if not rebuild:
        return own
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :] for c in own}


def plain(rows, rebuild=False):
    paths = sequences(rows, rebuild)
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
    return sorted(
        (m[0], len(node), members[node[:-1]][0] if node else -1, len(m), len(kids[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, m in members.items()
    )


def found(spark, rows, rebuild=False, schema=SCHEMA):
    result = conversations.conversation_trie(spark.createDataFrame(rows, schema), rebuild).fillna(-1, ["parent_conv_id"])
    return sorted(map(tuple, result.collect()))


def made(seed, convs, longest):
    """Conversations over few different turns, most of which begin like another one."""
    draw = np.random.default_rng(seed)
    kept, rows = [[]], []
    for c in range(convs):
        begun = kept[int(draw.integers(len(kept)))]
        begun = begun[: int(draw.integers(len(begun) + 1))]
        path = begun + [(["user", "bot"][int(draw.integers(2))], "é" * int(draw.integers(4))) for _ in range(int(draw.integers(longest)))]
        kept.append(path)
        rows += [(3 * c + c % 2, t, *turn) for t, turn in enumerate(path)]
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_against_a_plain_tree(spark, monkeypatch, rebuild):
    monkeypatch.setattr(conversations, "BLOCK", 3)
    monkeypatch.setattr(conversations, "SPAN", 6)
    monkeypatch.setattr(conversations, "PIECE", 7)
    rows = made(5, 70, 9)
    rows += [(c, t, "user", "same") for c in range(300, 340) for t in range(7)]  # one conversation, many times
    rows += [(c, 0, "user", "hot first turn") for c in range(400, 430)] + [(c, 1, "bot", str(c)) for c in range(400, 430)]
    rows += [(500, t, "user", str(t % 3)) for t in range(200)]  # and a very long one
    assert found(spark, rows, rebuild) == plain(rows, rebuild)


def test_defined_cases(spark):
    rows = [
        (1, None, "b", "x"), (1, None, "a", "y"), (1, 2, None, None), (1, 2, "", ""), (2, 5, "a", "y"), (2, 7, "b", "x"),
        (None, 1, "a", "lost"), (-4, 0, "a", "y"), (-4, -3, "long", "w" * 100_000), (-4, -(1 << 60), "a", "y"),
    ]
    result = found(spark, rows)
    assert result == plain(rows)
    assert result[0][:4] == (-4, 0, -1, 3) and sum(r[1] == 0 for r in result) == 1


def test_turnless_and_empty(spark):
    # 6 % 9 of its checksum leaves nothing of a short conversation whose base is absent
    rows = [(c, 0, "user", "x") for c in (6, 7, 8, 9, 11, 12, 13, 14)]
    assert found(spark, rows, True) == plain(rows, True)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert conversations.conversation_trie(docs.filter(F.lit(False)), True).count() == 0


def test_other_columns_are_left_alone(spark):
    rows = [(1, 0, "u", "x", 5, "p"), (2, 0, "u", "x", 6, "q")]
    assert found(spark, rows, schema=SCHEMA + ", pos int, d1 string") == plain([r[:4] for r in rows])
