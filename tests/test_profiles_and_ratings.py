"""Item and user profiles on small tables; splits, RMSE, unseen items and ALS."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.operators import ratings as rt
from tarn.plans import item_profiles as ip
from tarn.plans import user_profiles as up


@pytest.fixture(scope="module")
def shop(spark):
    items = spark.createDataFrame(
        [
            (1, "Toy Story (1995)", "Animation|Comedy"),
            (2, "Heat (1995)", "Action"),
            (3, "Untagged (2000)", "Drama"),
            (4, "Unrated", "Drama"),
        ],
        "item long, title string, genres string",
    )
    ratings = spark.createDataFrame(
        [(7, 1, 4.0, 0), (7, 2, 5.0, 6), (7, 3, 3.0, 8), (8, 1, 1.0, 5), (8, 1, 2.0, 7), (9, 3, 5.0, 1)],
        "user long, item long, rating double, ts long",
    )
    tags = spark.createDataFrame(
        [(1, "Funny toys"), (1, "toy"), (2, "crimes"), (4, "toy")], "item long, tag string"
    )
    return items, ratings, tags


def test_item_master_needs_rating_and_tag(shop):
    items, ratings, tags = shop
    counts = ip.item_tag_counts(tags)
    master = ip.item_master(ip.item_features(items), ratings, counts)
    rows = {r["item"]: r for r in master.collect()}
    assert set(rows) == {1, 2}
    assert rows[1].tags == ["toy", "funni"] and rows[1].avg_rating == pytest.approx(7 / 3)
    assert rows[1].genre_words == ["anim", "comedi"] and rows[1].year == "1995"


def test_user_profiles(shop):
    items, ratings, tags = shop
    counts = ip.item_tag_counts(tags)
    master = ip.item_master(ip.item_features(items), ratings, counts)
    by_tag = up.user_tags(ratings, counts)
    scores = {(r.user, r["rank"]): (r.stem, r.score) for r in by_tag.collect()}
    # Item 1 carries the tag "toy" twice, so its ratings count twice for it.
    assert scores == {
        (7, 1): ("toy", 8.0), (7, 2): ("crime", 5.0), (7, 3): ("funni", 4.0),
        (8, 1): ("toy", 6.0), (8, 2): ("funni", 3.0),
    }
    years, genres = up.user_years(ratings, master), up.user_genres(ratings, master)
    assert sorted((r.user, r.year, r.score) for r in years.collect()) == [(7, "1995", 9.0), (8, "1995", 3.0)]
    assert sorted((r.user, r["rank"], r.genre) for r in genres.collect()) == [
        (7, 1, "action"), (7, 2, "anim"), (7, 3, "comedi"), (8, 1, "anim"), (8, 2, "comedi"),
    ]
    profile = {r.user: r for r in up.user_profile(by_tag, years, genres).collect()}
    assert set(profile) == {7, 8}
    assert [tuple(e) for e in profile[7].tags] == [("toy", 8.0), ("crime", 5.0), ("funni", 4.0)]
    limited = up.user_tags(ratings, counts, k=1).collect()
    assert {(r.user, r.stem) for r in limited} == {(7, "toy"), (8, "toy")}


def test_split_and_union(shop):
    _, ratings, _ = shop
    split = {(r.user, r.ts): r.split for r in rt.with_split(ratings).collect()}
    assert split == {
        (7, 0): "train", (7, 6): "validation", (7, 8): "test",
        (8, 5): "train", (8, 7): "validation", (9, 1): "train",
    }
    user = rt.most_active_user(ratings)
    assert user.collect() == [(7,)]
    union = rt.train_union(ratings, user)
    # Training rows, then all of user 7: the one in a training bucket counts twice.
    assert sorted((r.user, r.ts) for r in union.collect()) == [
        (7, 0), (7, 0), (7, 6), (7, 8), (8, 5), (9, 1),
    ]


def test_rmse(spark):
    truth = spark.createDataFrame(
        [(1, 1, 3.0), (1, 1, 5.0), (2, 2, 1.0), (3, 3, 1.0)], "user long, item long, rating double"
    )
    predicted = spark.createDataFrame(
        [(1, 1, 4.0), (2, 2, 3.0)], "user long, item long, prediction double"
    )
    matched = rt.rmse(predicted, truth).first()
    assert (matched.matched, matched.rmse) == (3, pytest.approx((6 / 3) ** 0.5))
    assert rt.rmse(predicted, truth, "all").first().rmse == pytest.approx((6 / 4) ** 0.5)
    assert rt.rmse(predicted.where("user > 9"), truth).first().rmse is None
    with pytest.raises(ValueError):
        rt.rmse(predicted, truth, "none")


def test_unseen_items(shop):
    items, ratings, _ = shop
    rows = rt.unseen_items(items, ratings, rt.most_active_user(ratings)).collect()
    assert rows == [(7, 4)]


def test_als_recovers_planted_factors(spark):
    rng = np.random.default_rng(0)
    users, items = rng.uniform(0.5, 1.5, (40, 2)), rng.uniform(0.5, 1.5, (30, 2))
    table = users @ items.T
    picks = random.Random(1)
    rows = [
        (u, i, float(table[u, i]), picks.randrange(10)) for u in range(40) for i in range(30)
        if (u, i) != (0, 29)
    ] + [(0, 29, float(table[0, 29]), 9)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double, ts long")
    split = rt.with_split(ratings)
    model = rt.als(split.where("split = 'train'"), regularisation=0.001, iterations=15)
    truth = split.where("split = 'validation'")
    assert rt.rmse(rt.als_predict(model, truth), truth).first().rmse < 0.05
    unknown = spark.createDataFrame([(0, 0), (0, 999), (999, 0)], "user long, item long")
    assert [(r.user, r["item"]) for r in rt.als_predict(model, unknown).collect()] == [(0, 0)]

    titles = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "item long, title string")
    seen = ratings.where("user = 0 AND item >= 5")
    user = spark.createDataFrame([(0,)], "user long")
    best = rt.recommend_unseen(model, titles, seen, user).collect()
    assert {r["item"] for r in best} == {0, 1, 2, 3, 4}
    assert [r.prediction for r in best] == sorted((r.prediction for r in best), reverse=True)
    assert best[0].title == f"t{best[0]['item']}"


def test_als_depends_on_its_arguments_only(spark):
    """Ids beyond 31 bits, and the same model whatever the shuffle width."""
    big = 2**40
    rows = [(big + u, f"i{i}", 1.0 + (u * i) % 5, u + i) for u in range(30) for i in range(20)]
    ratings = spark.createDataFrame(rows, "user bigint, item string, rating double, ts bigint")
    before, scores = spark.conf.get("spark.sql.shuffle.partitions"), []
    for width in ("4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        predicted = rt.als_predict(rt.als(ratings), ratings)
        scores.append(rt.rmse(predicted, ratings).first().rmse)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert round(scores[0], 9) == round(scores[1], 9)


def test_all_given_users_join_the_training_set(spark):
    ratings = spark.createDataFrame([(u, 1, 3.0, 8) for u in (1, 2, 3)], "user bigint, item bigint, rating double, ts bigint")
    users = spark.createDataFrame([(1,), (3,)], "user bigint")
    assert sorted(r.user for r in rt.train_union(ratings, users).collect()) == [1, 3]
    items = spark.createDataFrame([(1,), (2,)], "item bigint")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        rt.unseen_items(items, ratings, users).collect()


@pytest.mark.parametrize("shift", [0.0, 1e8, -1e8])
def test_errors_far_from_zero(spark, shift):
    rng = random.Random(5)
    rows = [(rng.randrange(40), shift + rng.randrange(1, 11) / 2, rng.choice(["train", "train", "validation", "test"])) for _ in range(2000)]
    rows += [(99, shift + 1.0, "validation"), (98, shift + 2.0, "train")]  # without training, without validation
    of = lambda item, split: [r - shift for i, r, s in rows if i == item and s == split]
    items = {i for i, _, _ in rows}
    errors = [(r - np.mean(of(i, "train"))) ** 2 for i in items if of(i, "train") for r in of(i, "validation")]
    all_rows = sum(s == "validation" for _, _, s in rows)
    got = rt.item_mean_rmse(spark.createDataFrame(rows, "item long, rating double, split string").repartition(5)).first()
    assert got.matched == len(errors) == all_rows - 1
    assert got.rmse == pytest.approx(np.sqrt(sum(errors) / all_rows), abs=1e-6)


def test_errors_of_two_ratings_a_hundred_million_up(spark):
    rows = [(1, 1e8 + 3.0, "train"), (1, 1e8 + 3.0, "validation"), (1, 1e8 + 4.0, "validation")]
    got = rt.item_mean_rmse(spark.createDataFrame(rows, "item long, rating double, split string")).first()
    assert got.rmse == pytest.approx(0.5**0.5, abs=1e-9)


@pytest.mark.parametrize("slice_items,block_users", [(7, 5), (8192, 1024)])
def test_recommendations_for_many_users(spark, slice_items, block_users):
    """Every user's best unseen items by plain scoring of the factors."""
    rng = random.Random(9)
    rows = [(u, i, float(rng.randrange(1, 6)), rng.randrange(6)) for u in range(30) for i in rng.sample(range(40), 12)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double, ts long")
    items = spark.createDataFrame([(i, f"t{i}") for i in range(45)], "item long, title string")
    model = rt.als(ratings, rank=3, iterations=3)
    users = spark.createDataFrame([(u,) for u in (*range(0, 30, 2), 99)], "user long")
    got = {(r.user, r["rank"]): (r["item"], r.title, r.prediction) for r in rt.recommend_for_users(model, items, ratings, users, 4, slice_items, block_users).collect()}
    x, v = ({r[key]: np.array(r.features, dtype=float) for r in numbers.join(factors, F.col(f"{key}_no") == F.col("id")).collect()}
            for key, numbers, factors in (("user", model.users, model.model.userFactors), ("item", model.items, model.model.itemFactors)))
    seen = {(u, i) for u, i, _, _ in rows}
    expected = {}
    for u in range(0, 30, 2):
        best = sorted((-float(x[u] @ v[i]), i) for i in v if (u, i) not in seen)[:4]
        expected |= {(u, k): (i, f"t{i}", pytest.approx(-s)) for k, (s, i) in enumerate(best, 1)}
    assert got == expected
    one = rt.recommend_unseen(model, items, ratings, users.where("user = 4")).limit(4).collect()
    assert [r["item"] for r in one] == [got[4, k][0] for k in range(1, 5)]


def busy(spark, users=40, items=30):
    rng = random.Random(5)
    ratings = [(u, i, float(rng.randrange(1, 6)), 0) for u in range(users) for i in rng.choices(range(items), k=9)]
    ratings += [(1, i, 1.0, 0) for i in range(items)] + [(2, None, 3.0, 0), (None, 3, 2.0, 0)]
    tags = [(i, " ".join(rng.choices(["red", "Reds", "blue", "w1", "w2", "w3"], k=3))) for i in range(items) for _ in range(4)]
    tags += [(3, None), (None, "red"), (4, tags[16][1])]
    return ratings, tags


@pytest.mark.parametrize("user_rows", [10**6, 4])
@pytest.mark.parametrize("unit_rows", [4096, 3])
def test_tags_of_users_with_many_ratings(spark, user_rows, unit_rows):
    """Lists of tags, whole or in parts, and users added up in one task or several, against plain sums."""
    rated, tagged = busy(spark)
    counts = {}
    for item, text in tagged:
        for word in (text or "").lower().split():
            stem = "red" if word == "reds" else word
            counts.setdefault(item, {})[stem] = counts.get(item, {}).get(stem, 0) + 1
    sums = {}
    for user, item, rating, _ in rated:
        for stem, n in counts.get(item, {}).items() if item is not None else ():
            sums[user, stem] = sums.get((user, stem), 0) + rating * n
    expected = {}
    for user in {u for u, _ in sums}:
        best = sorted((-round(v, 6), s) for (u, s), v in sums.items() if u == user)[:3]
        expected |= {(user, rank): (s, -v) for rank, (v, s) in enumerate(best, 1)}
    ratings = spark.createDataFrame(rated, "user long, item long, rating double, ts long")
    tag_counts = ip.item_tag_counts(spark.createDataFrame(tagged, "item long, tag string"))
    got = up.user_tags(ratings, tag_counts, 3, unit_rows, user_rows).collect()
    assert {(r.user, r["rank"]): (r.stem, r.score) for r in got} == expected


@pytest.mark.parametrize("n", [127, 128, 32767, 32768, 1 << 40])
def test_counts_of_any_size(spark, n):
    ratings = spark.createDataFrame([(1, 1, 2)], "user long, item long, rating int")
    tag_counts = spark.createDataFrame([(1, "a", n), (1, "b", 1)], "item long, stem string, n long")
    got = {r.stem: r.score for r in up.user_tags(ratings, tag_counts).collect()}
    assert got == {"a": 2 * n, "b": 2}


def test_widths_follow_the_rows(spark, monkeypatch):
    """A task gets a bounded number of rows; the width was the session's once."""
    from tarn.operators import relational
    assert relational.tasks_for(spark.range(1000), 10) == 100
    monkeypatch.setattr(relational.tasks_for, "__defaults__", (10,))
    rated, tagged = busy(spark)
    ratings = spark.createDataFrame(rated, "user long, item long, rating double, ts long")
    tag_counts = ip.item_tag_counts(spark.createDataFrame(tagged, "item long, tag string"))
    assert "RepartitionByExpression [item#" in tag_counts._jdf.queryExecution().optimizedPlan().toString()
    plan = up.user_tags(ratings, tag_counts)._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [user#" in plan and f", {-(-len(rated) // 10)}" in plan
    assert plan.index("Generate inline") < plan.index("RepartitionByExpression [user#")  # lists are opened after the shuffle


def test_the_search_of_a_unit_is_exact_and_skips_leaves(monkeypatch):
    """Against all products; and only few of them are formed, where once all were."""
    rng = np.random.default_rng(1)
    for rank, users, items in ((1, 30, 400), (2, 50, 3000), (5, 40, 777), (2, 7, 4), (2, 0, 5), (2, 5, 0)):
        left, right = rng.normal(size=(users, rank)), rng.normal(size=(items, rank))
        left[:1] = 0  # all items tie
        sizes = rng.integers(0, min(items, 40) + 1, users)
        seen = [rng.choice(items, n, replace=False) for n in sizes]
        row, place, score = rt.best_items(left, right, sizes, np.concatenate([*seen, []]).astype(int), 5, leaf_items=16)
        for u in range(users):
            best = sorted((round(-float(left[u] @ right[i]), 9) + 0.0, i) for i in set(range(items)) - set(seen[u].tolist()))[:5]
            assert [(round(-s, 9) + 0.0, p) for s, p in zip(score[row == u].tolist(), place[row == u].tolist())] == best
    formed = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            formed.append(self.shape[0] * other.shape[-1])
            return np.asarray(self) @ np.asarray(other)

    left, right = rng.normal(size=(200, 2)), rng.normal(size=(50_000, 2))
    none = np.zeros(200, dtype=int)
    rt.best_items(left.view(Counted), right, none, none[:0], 5)
    assert sum(formed) < 200 * 50_000 / 10


def test_items_travel_to_blocks_in_chunks(spark):
    """Rows on their way to the units follow users and chunks of items, not items times blocks."""
    rows = [(u, u % 7, 1.0 + u % 3, 0) for u in range(300)] + [(0, i, 2.0, 0) for i in range(200)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double, ts long")
    items = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "item long, title string")
    found = rt.recommend_for_users(rt.als(ratings, iterations=1), items, ratings, ratings.select("user"), 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "entries#" in plan and "FlatMapCoGroupsInArrow" in plan
    assert found.count() == 299 * 3


def test_normal_equations_see_a_wrong_factor(spark):
    rng = random.Random(3)
    rows = [(u, i, float(rng.randrange(1, 6)), 0) for u in range(20) for i in rng.sample(range(30), 8)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double, ts long")
    model = rt.als(ratings)
    assert rt.normal_residuals(model, ratings).where("residual > 1e-4").count() == 0
    assert rt.normal_residuals(model, ratings).agg(F.sum("n")).first()[0] == len(rows)
    # other ratings, or another regularisation, are not solved by these factors
    assert rt.normal_residuals(model, ratings.withColumn("rating", F.col("rating") + F.col("item") % 3)).where("residual > 1e-3").count() > 10
    assert rt.normal_residuals(model, ratings, 0.5).where("residual > 1e-3").count() > 10
