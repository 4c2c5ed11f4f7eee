"""Support, confidence and predictions against plain counting."""

import random
from collections import Counter
from itertools import combinations

import pytest

from tarn.operators import baskets as bk


def make_baskets(seed, n=40, items="abcdefgh", longest=9):
    rng = random.Random(seed)
    weights = [len(items) - i for i in range(len(items))]
    made = [rng.choices(items, weights, k=rng.randrange(0, longest)) for _ in range(n)]
    return made + [list(items) * 2, ["a"] * 5, []]


def rows(spark, baskets):
    data = [(i, item) for i, basket in enumerate(baskets) for item in basket]
    return spark.createDataFrame(data, "basket long, item string")


def counted(baskets, r, least):
    counts = Counter(tuple(sorted(c)) for b in baskets for c in combinations(b, r))
    return {key: n for key, n in counts.items() if n >= least}


def collected(frame, *keys):
    result = {tuple(r[k] for k in keys): r["n"] for r in frame.collect()}
    assert len(result) == frame.count()
    return result


@pytest.mark.parametrize("slice_items", [2000, 4])
@pytest.mark.parametrize("positional", [True, False])
def test_pairs_and_triples(spark, slice_items, positional):
    baskets = make_baskets(7)
    contents = bk.basket_contents(rows(spark, baskets), positional)
    if not positional:
        baskets = [sorted(set(b)) for b in baskets]
    items = {k[0]: n for k, n in counted(baskets, 1, 20).items()}
    pairs = {
        k: n for k, n in counted(baskets, 2, 20).items() if k[0] in items and k[1] in items
    }
    assert collected(bk.frequent_items(contents, 20), "item") == {(k,): n for k, n in items.items()}
    found = bk.pair_counts(contents, 20, slice_items=slice_items)
    assert collected(found, "a", "b") == pairs
    found = bk.triple_counts(contents, 8, sets=not positional, slice_items=slice_items)
    assert collected(found, "a", "b", "c") == counted(baskets, 3, 8)
    assert bk.basket_count(contents) == sum(1 for b in baskets if b)


@pytest.mark.parametrize("positional", [True, False])
@pytest.mark.parametrize("least", [3, 12])
def test_one_basket_with_a_third_of_all_rows(spark, positional, least):
    """Pairs met only in the large basket, only elsewhere, and in both."""
    letters = "abcdefghijklmnop"
    huge = list(letters) * 2 + list("aaaabbb")
    baskets = [huge] + make_baskets(11, n=30, items=letters[:10], longest=5)[:30]
    contents = bk.basket_contents(rows(spark, baskets), positional)
    if not positional:
        baskets = [sorted(set(b)) for b in baskets]
    items = {k[0] for k in counted(baskets, 1, least)}
    expected = {k: n for k, n in counted(baskets, 2, least).items() if set(k) <= items}
    found = bk.pair_counts(contents, least, slice_items=6)
    assert collected(found, "a", "b") == expected
    found = bk.triple_counts(contents, least, sets=not positional, slice_items=6)
    assert collected(found, "a", "b", "c") == counted(baskets, 3, least)


def test_triple_bound_drops_only_hopeless_items(spark):
    # x is rare but repeats lift (x, x, y) to 6 * 2; z takes part in three triples at most.
    contents = bk.basket_contents(rows(spark, [list("xxxxyy"), list("abz"), list("abz"), list("zab")]))
    kept = {r["item"] for r in bk._possible_in_triples(contents, 12).collect()}
    assert kept == {"x", "y"}
    assert collected(bk.triple_counts(contents, 12), "a", "b", "c") == {("x", "x", "y"): 12}


def test_confidence(spark):
    baskets = [list("ab"), list("ab"), list("ac"), list("abc")]
    contents = bk.basket_contents(rows(spark, baskets))
    items = bk.item_counts(contents)
    pairs = bk.pair_counts(contents, 1)
    rules = {(r.lhs, r.rhs): r.confidence for r in bk.pair_confidence(pairs, items).collect()}
    assert rules[("b", "a")] == 1.0 and rules[("a", "b")] == 0.75 and rules[("c", "b")] == 0.5
    triples = bk.triple_confidence(bk.triple_counts(contents, 1), pairs).collect()
    assert [(r.lhs1, r.lhs2, r.rhs) for r in triples] == [
        ("b", "c", "a"), ("a", "c", "b"), ("a", "b", "c"),
    ]
    assert triples[0].confidence == 1.0 and triples[2].confidence == pytest.approx(1 / 3)


def test_repeated_item_pairs_with_itself(spark):
    contents = bk.basket_contents(rows(spark, [list("aaaab")]))
    pairs = bk.pair_counts(contents, 1)
    assert collected(pairs, "a", "b") == {("a", "a"): 6, ("a", "b"): 4}
    # (a, a) gives its rule twice, once per direction, as any pair does.
    rules = bk.pair_confidence(pairs, bk.item_counts(contents)).collect()
    assert [(r.lhs, r.rhs, r.confidence) for r in rules][-2:] == [("a", "a", 1.5), ("a", "b", 1.0)]
    assert len(rules) == 4


def test_rule_without_its_pair_is_left_out(spark):
    contents = bk.basket_contents(rows(spark, [list("abc"), list("bc")]))
    pairs = bk.pair_counts(contents, 2)
    rules = bk.triple_confidence(bk.triple_counts(contents, 1), pairs).collect()
    assert [(r.lhs1, r.lhs2, r.rhs, r.confidence) for r in rules] == [("b", "c", "a", 0.5)]


def test_predictions_by_join_equal_the_model(spark):
    contents = bk.basket_contents(rows(spark, make_baskets(3, longest=5)))
    sets = bk.basket_sets(contents)
    model = bk.fp_growth(sets, 0.1, 0.4, partitions=3)
    assert model.associationRules.count() > 5

    def result(frame):
        return {r.basket: (r["items"], sorted(r.prediction)) for r in frame.collect()}

    by_join = result(bk.fp_predict(model, sets, max_rules=0))
    assert by_join == result(bk.fp_predict(model, sets)) and any(p for _, p in by_join.values())


def test_an_item_repeated_millions_of_times(spark):
    n = 3_000_000
    contents = spark.createDataFrame([(1, "a", n)], "basket bigint, item string, times bigint")
    weighed = contents.selectExpr("item AS a", "item AS b", "item AS c", "times AS na", "times AS nb", "times AS nc")
    assert bk._weighed(weighed, 3).first().n == n * (n - 1) * (n - 2) // 6


def test_a_basket_of_thousands_makes_no_triples_of_its_own(spark):
    """Its 1.3 billion triples cannot reach the threshold and are not formed."""
    rows = [(b, f"x{i}") for b in range(40) for i in range(3)] + [(99, f"x{i}") for i in range(2000)]
    contents = bk.basket_contents(spark.createDataFrame(rows, "basket bigint, item string"))
    found = bk.triple_counts(contents, 20).collect()
    assert [(r.a, r.b, r.c, r.n) for r in found] == [("x0", "x1", "x2", 41)]


def test_rules_wait_at_their_rarest_item(spark):
    """All thousand rules and all baskets share an item; only rules at a basket's other items meet it."""
    sets = spark.createDataFrame([(b, ["all", f"x{b % 500}", "y"]) for b in range(2000)], "basket long, items array<string>")
    rules = [(["all", f"x{k}"], ["z"]) for k in range(500)] + [(["all", f"gone{k}"], ["z"]) for k in range(499)] + [(["all"], ["y"])]
    frame = spark.createDataFrame([(a, c[0]) for a, c in rules], "antecedent array<string>, consequent string")
    met = bk.rules_met(frame, sets, unit_rows=100).collect()
    assert len(met) == 2000 * 2
    assert all(set(r.antecedent) <= set(r["items"]) for r in met)
    joined = bk.rules_met(frame, sets)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in joined
    # rows out of the join of baskets and waiting rules, before containment is looked at: no more than met
    assert len({(r.basket, r.rule) for r in met}) == len(met)
