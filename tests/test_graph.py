"""Neighbour recommendation against a plain computation, with and without hubs."""

import random
from collections import Counter

import pytest

from tarn.operators.graph import hub_lists, people_you_may_know


def brute_force(edges, seeds=None, k=10):
    out = {}
    for src, dst in edges:
        out.setdefault(src, set()).add(dst)
    best = {}
    for user in out if seeds is None else seeds & out.keys():
        scored = [
            (-len(out[user] & out[other]), other)
            for other in out
            if other != user
            and other not in out[user]
            and user not in out[other]
            and out[user] & out[other]
        ]
        for rank, (shared, other) in enumerate(sorted(scored)[:k], 1):
            best[user, rank] = (other, -shared)
    return best


def skewed_graph(seed, nodes=60, edges=220, hubs=3):
    rng = random.Random(seed)
    pairs = {(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)}
    for hub in rng.sample(range(nodes), hubs):
        pairs |= {(node, hub) for node in range(nodes) if rng.random() < 0.6}
    return pairs


def run(spark, edges, seeds=None, **options):
    frame = spark.createDataFrame(sorted(edges), "src long, dst long")
    users = None
    if seeds is not None:
        users = spark.createDataFrame([(s,) for s in sorted(seeds)], "user long")
    rows = people_you_may_know(frame, users, **options).collect()
    return {(r.user, r.rank): (r.other, r.shared) for r in rows}


# hub_degree 0 makes a hub of every target; small slices part the nodes, small heads the lists.
@pytest.mark.parametrize("seed,hub_degree,slice_edges,list_head", [
    (1, 10**6, 1000, 1000), (1, 10, 1000, 15), (1, 10, 30, 5), (2, 0, 1000, 1000), (2, 0, 60, 16),
    (3, 5, 25, 25),
])
def test_all_users(spark, seed, hub_degree, slice_edges, list_head):
    edges = skewed_graph(seed)
    got = run(spark, edges, hub_degree=hub_degree, slice_edges=slice_edges, list_head=list_head)
    assert got == brute_force(edges)


def many_hubs(seed, nodes=1200, hubs=100):
    """Every node points to a few of the hubs, some to very many, and to an ordinary target."""
    rng = random.Random(seed)
    pairs = set()
    for node in range(nodes):
        wanted = 3 if node % 50 else hubs // 2
        pairs |= {(node, 10_000 + rng.randrange(hubs)) for _ in range(wanted)}
        pairs.add((node, 20_000 + node // 3))
    return pairs


def test_a_hundred_hubs(spark):
    """All hundred targets above the degree are hubs, and the lists' rows follow the edges."""
    edges = many_hubs(6)
    degree = Counter(dst for _, dst in edges)
    assert sum(n > 20 for n in degree.values()) == 100
    assert run(spark, edges, hub_degree=20, slice_edges=2000) == brute_force(edges)


def test_list_rows_follow_the_edges(spark):
    """Twice the nodes on the same hubs: pairs grow fourfold, the rows that leave the units twofold."""
    rows = []
    for nodes in (600, 1200):
        edges = many_hubs(7, nodes)
        sets = {}
        for src, dst in edges:
            if dst < 20_000:
                sets.setdefault(src, set()).add(dst)
        entries = {node: 11 + sum(node in e for e in edges) for node in sets}
        assert len(edges) > 0
        frame = spark.createDataFrame([(n, sorted(h)) for n, h in sets.items()], "node long, hubs array<long>")
        classes = {}
        for node, hubs in sets.items():
            key = tuple(sorted(hubs))
            classes[key] = max(classes.get(key, 0), entries[node])
        asked = spark.createDataFrame([(i, list(h), e) for i, (h, e) in enumerate(classes.items())], "class long, hubs array<long>, entries long")
        found = hub_lists(asked, frame).collect()
        assert len(found) <= sum(classes.values()) <= len(sets) * 11 + 2 * len(edges)
        rows.append(len(found))
        for number, (hubs, most) in list(enumerate(classes.items()))[::97]:
            best = sorted((-len(set(hubs) & other), node) for node, other in sets.items() if set(hubs) & other)[:most]
            got = sorted((r.rank, r.other, r.shared) for r in found if r["class"] == number)
            assert got == [(i + 1, node, -share) for i, (share, node) in enumerate(best)]
    assert rows[1] < 2.3 * rows[0]


def test_ids_may_be_texts(spark):
    edges = {(f"u{src}", f"t{dst}") for src, dst in skewed_graph(8, nodes=30, edges=60)}
    frame = spark.createDataFrame(sorted(edges), "src string, dst string")
    got = {(r.user, r.rank): (r.other, r.shared) for r in people_you_may_know(frame, hub_degree=5).collect()}
    assert got == brute_force(edges)


@pytest.mark.parametrize("hub_degree", [10**6, 10])
def test_seeds(spark, hub_degree):
    edges = skewed_graph(4)
    seeds = {0, 7, 13, 999}
    assert run(spark, edges, seeds, hub_degree=hub_degree, k=4) == brute_force(edges, seeds, 4)


def test_one_target_shared_by_all(spark):
    """A star: everybody shares the hub, the best strangers are the lowest ids."""
    edges = {(node, 1000) for node in range(200)}
    got = run(spark, edges, hub_degree=50)
    assert got == brute_force(edges)
    assert got[5, 1] == (0, 1) and got[0, 1] == (1, 1)


def test_repeated_edges_and_friends(spark):
    edges = [(1, 9), (1, 9), (2, 9), (3, 9), (3, 1), (4, 8)]
    frame = spark.createDataFrame(edges, "src long, dst long")
    rows = {(r.user, r.other): r.shared for r in people_you_may_know(frame).collect()}
    assert rows == {(1, 2): 1, (2, 1): 1, (2, 3): 1, (3, 2): 1}


@pytest.mark.parametrize("user_entries", [10**6, 60, 0])
@pytest.mark.parametrize("shift", [0, 1 << 40])
def test_users_who_receive_much_are_served_pair_by_pair(spark, user_entries, shift):
    edges = {(s + shift, d + shift) for s, d in skewed_graph(7)} | {(1 + shift, n + shift) for n in range(60)}
    assert run(spark, edges, hub_degree=10**6, k=3, user_entries=user_entries) == brute_force(edges, k=3)


def test_no_pair_is_shuffled(spark):
    """What leaves a block are k others a user; pairs once went through two shuffles."""
    pairs = [(user, 1000 + n % 5) for n, user in enumerate(range(400))]
    frame = spark.createDataFrame(pairs, "src long, dst long")
    found = people_you_may_know(frame, k=2)
    assert "FlatMapGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    from tarn.operators.graph import _from_lists
    assert _from_lists(frame, 2, 10**6).count() == 400 * 2


def test_ids_may_be_words(spark):
    edges = skewed_graph(9)
    frame = spark.createDataFrame([(f"n{s:03}", f"n{d:03}") for s, d in sorted(edges)], "src string, dst string")
    got = {(r.user, r.rank): (r.other, r.shared) for r in people_you_may_know(frame).collect()}
    assert got == {(f"n{u:03}", rank): (f"n{o:03}", n) for (u, rank), (o, n) in brute_force(edges).items()}
