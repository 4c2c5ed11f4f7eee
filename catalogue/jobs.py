"""One callable per job: ``(spark, sf_dir) -> DataFrame``, over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import inputs
from tarn.functions.text import words
from tarn.operators import baskets as bk
from tarn.operators import clustering as cl
from tarn.operators import ratings as rt
from tarn.operators.graph import people_you_may_know
from tarn.operators.relational import count_by, joined_count, most_frequent
from tarn.operators.similarity import tf_cosine
from tarn.operators.words import letter_counts, stem_counts, word_rows
from tarn.plans import item_profiles as ip
from tarn.plans import user_profiles as up
from tarn.session import materialise, scratch_path
from tarn.sources import lines as ln
from tarn.sources import tabular as tb
from tarn.sources.tables import read_table, register_views

PAIR_SHARE = 0.02
TRIPLE_SHARE = 0.003
MIN_SUPPORT = 0.003
MIN_CONFIDENCE = 0.15
ROUNDS = 20


# -- counting and joining ------------------------------------------------------------------


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_frequent(read_table(spark, sf_dir, "events"), "event_type")


def group_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir, ["events"])
    return spark.sql(
        "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type"
    )


def group_count_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = read_table(spark, sf_dir, "events").selectExpr("to_date(ts) AS event_date", "event_type")
    return count_by(dated, "event_date", "event_type").orderBy("event_date", "event_type")


def filter_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return most_frequent(
        events.where("to_date(ts) = DATE'2024-01-15' AND event_type = 'error'"), "user_id"
    )


def global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


def join_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    return joined_count(lines, part, "l_partkey", "p_partkey", "p_type")


def join_group_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir, ["lineitem", "part"])
    return spark.sql(
        """
        SELECT p_type, sum(lines) AS n
        FROM (SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY l_partkey) l
        JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY p_type
        ORDER BY n DESC, p_type
        """
    )


# -- files and line formats ----------------------------------------------------------------


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-json")
    tb.write_json(events, path, compression="gzip")
    back = tb.read_json(spark, path, events.schema)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    return back.select("event_id", stamp, "user_id", "event_type", "value", "props")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    tb.write_csv(part, path)
    back = tb.read_csv(spark, path, part.schema)
    return tb.require_not_null(back, ["p_partkey", "p_name", "p_size", "p_retailprice"])


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and white space through a CSV file."""
    documents = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    tb.write_csv(documents, path)
    return tb.read_csv(spark, path, documents.schema)


def json_timestamp_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants with a zone, through a JSON file, to the microsecond."""
    events = read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    events = events.withColumn("ts", F.expr("ts + make_dt_interval(0, 0, 0, event_id % 1000000 / 1000000)"))
    path = scratch_path(spark, "instants-json")
    tb.write_json(events, path)
    back = tb.read_json(spark, path, events.schema)
    return back.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


def string_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number compared with a column of texts, as read from a CSV file without a schema."""
    path = scratch_path(spark, "supplier-csv")
    tb.write_csv(read_table(spark, sf_dir, "supplier"), path)
    return tb.read_csv_strings(spark, path).where("s_nationkey = 1").select("s_suppkey", "s_name", "s_nationkey")


def csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part-csv")
    tb.write_csv(read_table(spark, sf_dir, "part"), path)
    return tb.read_csv_inferred(spark, path)


def csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "supplier-csv")
    tb.write_csv(read_table(spark, sf_dir, "supplier"), path)
    types = {"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double"}
    return tb.typed(tb.read_csv_strings(spark, path), types)


def adjacency_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written as ``order <tab> part,supplier,`` and read back as edges."""
    lines = read_table(spark, sf_dir, "lineitem").selectExpr(
        r"concat(l_orderkey, '\t', l_partkey, ', ', l_suppkey, ',') AS value"
    )
    return ln.adjacency_edges(lines)


def basket_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read as baskets of words: occurrences per item."""
    items = ln.basket_items(inputs.documents(spark, sf_dir), "text")
    return count_by(items, "item")


def basket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in order as lines of text and read back as baskets named by their line."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" ", "o_orderstatus", "o_orderpriority", "o_orderstatus").alias("value"))
    path = scratch_path(spark, "order-lines")
    orders.orderBy("o_orderkey").select("value").write.text(path)
    return ln.basket_items(ln.read_numbered_lines(spark, path), basket="line")


def csv_text_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through a CSV file, read back without a schema; numbers are cast by name."""
    documents = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    tb.write_csv(documents, path, file_rows=500)
    return tb.typed(tb.read_csv_strings(spark, path), {"doc_id": "bigint", "n_chars": "bigint"})


def csv_text_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the types found in the file."""
    turns = read_table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "turns-csv")
    tb.write_csv(turns, path, file_rows=500)
    back = tb.read_csv_inferred(spark, path)
    return back.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")


def vector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "array_join(transform(embedding, x -> string(x)), ' ') AS value"
    )
    points = lines.select("vec_id", ln.vector_from_text(F.col("value")).alias("point"))
    return points.select("vec_id", F.posexplode("point").alias("i", "x"))


# -- words ---------------------------------------------------------------------------------


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letter_counts(inputs.documents(spark, sf_dir), "text")


def letters_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from text files, one row a line."""
    path = scratch_path(spark, "documents-text")
    inputs.documents(spark, sf_dir).write.text(path)
    return letter_counts(ln.read_lines(spark, path), "value")


def stem_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stem_counts(word_rows(inputs.documents(spark, sf_dir), "text"), "word")


def stem_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stem_counts(word_rows(inputs.tags(spark, sf_dir), "tag"), "word")


def tf_cosine_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = inputs.turn_pairs(spark, sf_dir).select(
        "conv_id", "turn", words(F.col("text")).alias("left"), words(F.col("reply")).alias("right")
    )
    cosine = tf_cosine(pairs, ["conv_id", "turn"], "left", "right")
    return cosine.withColumn("cosine", F.round("cosine", 6))


# -- neighbours and baskets ----------------------------------------------------------------


def pymk_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_you_may_know(inputs.edges(spark, sf_dir))


def pymk_most_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the ten users with most distinct links only, as given seeds."""
    edges = materialise(inputs.edges(spark, sf_dir).distinct())
    linked = count_by(edges, "src").orderBy(F.desc("n"), "src").limit(10)
    return people_you_may_know(edges, linked.select(F.col("src").alias("user")))


def _contents(spark: SparkSession, sf_dir: str, positional: bool = True) -> DataFrame:
    return bk.basket_contents(inputs.basket_rows(spark, sf_dir), positional)


def _least(contents: DataFrame, share: float) -> float:
    return share * bk.basket_count(contents)


def item_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir)
    return bk.frequent_items(contents, _least(contents, PAIR_SHARE))


def pair_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir)
    return bk.pair_counts(contents, _least(contents, PAIR_SHARE))


def pair_support_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir, positional=False)
    return bk.pair_counts(contents, _least(contents, PAIR_SHARE))


def pair_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir)
    least = _least(contents, PAIR_SHARE)
    items = materialise(bk.frequent_items(contents, least))
    rules = bk.pair_confidence(bk.pair_counts(contents, least, items), items)
    return rules.withColumn("confidence", F.round("confidence", 6))


def triple_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir)
    return bk.triple_counts(contents, _least(contents, TRIPLE_SHARE))


def triple_support_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir, positional=False)
    return bk.triple_counts(contents, _least(contents, TRIPLE_SHARE), sets=True)


def triple_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir)
    least = _least(contents, TRIPLE_SHARE)
    rules = bk.triple_confidence(bk.triple_counts(contents, least), bk.pair_counts(contents, least))
    return rules.withColumn("confidence", F.round("confidence", 6))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = bk.basket_sets(_contents(spark, sf_dir))
    return sets.select("basket", F.size("items").alias("size"), F.array_join("items", " ").alias("items"))


def _fp_model(spark: SparkSession, sf_dir: str):
    sets = bk.basket_sets(_contents(spark, sf_dir))
    return bk.fp_growth(sets, MIN_SUPPORT, MIN_CONFIDENCE), sets


def fp_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _fp_model(spark, sf_dir)
    return model.freqItemsets.select(
        F.array_join(F.sort_array("items"), " ").alias("items"), "freq"
    )


def fp_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _fp_model(spark, sf_dir)
    return model.associationRules.select(
        F.array_join(F.sort_array("antecedent"), " ").alias("antecedent"),
        F.array_join("consequent", " ").alias("consequent"),
        F.round("confidence", 6).alias("confidence"),
        F.round("lift", 6).alias("lift"),
        F.round("support", 6).alias("support"),
    )


def fp_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, sets = _fp_model(spark, sf_dir)
    return bk.fp_predict(model, sets).select(
        "basket", F.array_join(F.sort_array("prediction"), " ").alias("prediction")
    )


def fp_predict_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same predictions by the index of rules, the way for more rules than fit everywhere."""
    model, sets = _fp_model(spark, sf_dir)
    return bk.fp_predict(model, sets, max_rules=0).select(
        "basket", F.array_join(F.sort_array("prediction"), " ").alias("prediction")
    )


def basket_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket rows with the names of their items, repeats kept."""
    lines = read_table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS basket", "l_partkey AS item")
    return bk.with_names(lines, read_table(spark, sf_dir, "part"), "p_partkey", "p_name")


# -- clusters ------------------------------------------------------------------------------


def _lloyd(spark: SparkSession, sf_dir: str, metric: str) -> tuple[cl.GivenCentersKMeans, DataFrame]:
    """Rounds from the mean vector of each label as the given centers."""
    points = inputs.points(spark, sf_dir)
    start = cl.centers_from(cl.group_means(points, "label"))
    return cl.GivenCentersKMeans(ROUNDS, start, metric).fit(points), points


def _costs(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    model, _ = _lloyd(spark, sf_dir, metric)
    return model.cost_rows(spark).withColumn("cost", F.round("cost", 6))


def kmeans_cost_sq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _costs(spark, sf_dir, "sqeuclidean")


def kmeans_cost_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _costs(spark, sf_dir, "manhattan")


def kmeans_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and centers as text files, a vector a line, through all rounds."""
    points = inputs.points(spark, sf_dir)
    files = {name: scratch_path(spark, name) for name in ("points-text", "centers-text")}
    points.select(F.array_join("point", " ")).write.text(files["points-text"])
    # k rows, in one file, since the order of its lines numbers the centers
    means = cl.group_means(points, "label").orderBy("cluster").coalesce(1)
    means.select(F.array_join("center", " ")).write.text(files["centers-text"])
    start = cl.centers_from(ln.read_centers(spark, files["centers-text"]))
    model = cl.GivenCentersKMeans(ROUNDS, start).fit(ln.read_points(spark, files["points-text"]))
    return model.cost_rows(spark).withColumn("cost", F.round("cost", 6))


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, points = _lloyd(spark, sf_dir, "sqeuclidean")
    return model.assign(points.select("vec_id", "point")).select(
        "vec_id", "cluster", F.round("distance", 6).alias("distance")
    )


def kmeans_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _lloyd(spark, sf_dir, "sqeuclidean")
    centers = model.center_rows(spark)
    return centers.select("cluster", F.posexplode("center").alias("i", "x")).withColumn(
        "x", F.round("x", 6)
    )


def features_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four number columns gathered into one vector, and its parts read back."""
    lines = read_table(spark, sf_dir, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vectors = cl.assemble(lines.select("l_orderkey", "l_linenumber", *columns), columns)
    parts = vectors.select("l_orderkey", "l_linenumber", F.posexplode(vector_to_array("features")).alias("i", "x"))
    return parts.groupBy("i").agg(F.count("*").alias("n"), F.round(F.sum("x"), 2).alias("total"))


def silhouette_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = cl.silhouette(cl.as_vectors(inputs.points(spark, sf_dir)), cluster="label")
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


def cluster_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = inputs.points(spark, sf_dir)
    start = cl.centers_from(cl.group_means(points, "truth"))
    assigned = cl.GivenCentersKMeans(0, start).assign(points)
    return cl.label_accuracy(assigned, "cluster", "truth").withColumn(
        "accuracy", F.round("accuracy", 6)
    )


def kmeans_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cl.as_vectors(inputs.points(spark, sf_dir))
    clustered = cl.ml_kmeans(vectors, 2).transform(vectors)
    score = cl.silhouette(clustered)
    return cl.label_accuracy(clustered, "prediction", "truth").withColumn("silhouette", F.lit(score))


def pca_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cl.as_vectors(inputs.points(spark, sf_dir))
    reduced = cl.pca(vectors, 2).transform(vectors).select("pca", "truth")
    clustered = cl.ml_kmeans(reduced, 2, features="pca").transform(reduced)
    score = cl.silhouette(clustered.withColumnRenamed("pca", "features"))
    return cl.label_accuracy(clustered, "prediction", "truth").withColumn("silhouette", F.lit(score))


def kmeans_ml_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned clusters as a fixed point: all rows at their nearest center, centers in the middle."""
    vectors = cl.as_vectors(inputs.points(spark, sf_dir))
    model = cl.ml_kmeans(vectors, 2)
    found = cl.settled(model, model.transform(vectors))
    return found.agg(
        F.count("*").alias("clusters"),
        F.sum("n").alias("points"),
        F.sum("misplaced").alias("misplaced"),
        (F.max("moved") < 0.01).alias("settled"),
    )


def pca_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each component against the covariance of the points, and the variance of all dimensions."""
    vectors = cl.as_vectors(inputs.points(spark, sf_dir))
    model = cl.pca(vectors, 2)
    shares = [float(x) for x in model.explainedVariance.toArray()]
    total = float(cl.covariance(vectors).trace())
    claimed = F.array(*map(F.lit, shares))[F.col("component") - 1]
    return cl.pca_residuals(model, vectors).select(
        "component",
        F.round(F.lit(total), 6).alias("variance"),
        (F.col("residual") < 1e-8).alias("eigenvector"),
        (F.abs(F.col("share") - claimed) < 1e-9).alias("explains"),
    )


# -- item and user profiles ----------------------------------------------------------------


def _feature_text(features: DataFrame) -> DataFrame:
    return features.withColumns(
        {
            "title_words": F.array_join("title_words", " "),
            "genre_words": F.array_join("genre_words", " "),
        }
    )


def item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_text(ip.item_features(inputs.items(spark, sf_dir)))


def item_features_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_text(ip.item_features(inputs.items(spark, sf_dir), tokenizer="whitespace"))


def item_avg_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = ip.item_average(inputs.ratings(spark, sf_dir))
    return averages.withColumn("avg_rating", F.round("avg_rating", 6))


def item_top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip.item_top_tags(ip.item_tag_counts(inputs.tags(spark, sf_dir)))


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip.item_master(
        ip.item_features(inputs.items(spark, sf_dir)),
        inputs.ratings(spark, sf_dir),
        materialise(ip.item_tag_counts(inputs.tags(spark, sf_dir))),
    )


def item_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_text(_master(spark, sf_dir)).withColumns(
        {"avg_rating": F.round("avg_rating", 6), "tags": F.array_join("tags", " ")}
    )


def user_tag_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag_counts = ip.item_tag_counts(inputs.tags(spark, sf_dir))
    return up.user_tags(materialise(inputs.ratings(spark, sf_dir)), materialise(tag_counts))


def user_year_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.user_years(materialise(inputs.ratings(spark, sf_dir)), _master(spark, sf_dir))


def user_genre_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.user_genres(materialise(inputs.ratings(spark, sf_dir)), materialise(_master(spark, sf_dir)))


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = materialise(inputs.ratings(spark, sf_dir))
    tag_counts = materialise(ip.item_tag_counts(inputs.tags(spark, sf_dir)))
    features = ip.item_features(inputs.items(spark, sf_dir))
    master = materialise(ip.item_master(features, ratings, tag_counts))
    profile = up.user_profile(
        up.user_tags(ratings, tag_counts),
        up.user_years(ratings, master),
        up.user_genres(ratings, master),
    )
    names = {
        name: F.array_join(F.transform(name, lambda e: e["name"]), " ")
        for name in ("tags", "years", "genres")
    }
    return profile.select("user", *[column.alias(name) for name, column in names.items()])


# -- ratings -------------------------------------------------------------------------------


def rating_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.with_split(inputs.ratings(spark, sf_dir))


def train_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = inputs.ratings(spark, sf_dir)
    return rt.train_union(ratings, rt.most_active_user(ratings))


def rmse_item_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = rt.with_split(inputs.ratings(spark, sf_dir))
    return rt.item_mean_rmse(split).withColumn("rmse", F.round("rmse", 6))


def unseen_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = inputs.ratings(spark, sf_dir)
    return rt.unseen_items(inputs.items(spark, sf_dir), ratings, rt.most_active_user(ratings))


def _als(spark: SparkSession, sf_dir: str):
    ratings = materialise(inputs.ratings(spark, sf_dir))
    user = materialise(rt.most_active_user(ratings))
    return rt.als(rt.train_union(ratings, user)), rt.with_split(ratings), user


def als_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split, _ = _als(spark, sf_dir)
    return rt.als_predict(model, split.where("split = 'validation'"))


def als_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split, _ = _als(spark, sf_dir)
    truth = split.where("split <> 'train'")
    return rt.rmse_by(rt.als_predict(model, truth), truth, "split")


def als_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each split whose user and item the model knows."""
    return als_rmse(spark, sf_dir).select("split", "matched")


def als_predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The different validation pairs that get a prediction."""
    return als_predict(spark, sf_dir).select("user", "item")


def als_solved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose factors solve their normal equations, made again from the ratings and item factors."""
    ratings = materialise(inputs.ratings(spark, sf_dir))
    train = rt.train_union(ratings, materialise(rt.most_active_user(ratings)))
    residuals = rt.normal_residuals(rt.als(train), train)
    return residuals.agg(
        F.count("*").alias("users"), F.sum("n").alias("ratings"), F.count_if(F.col("residual") < 1e-4).alias("solved")
    )


def als_rmse_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's errors against those of its factors' products."""
    model, split, _ = _als(spark, sf_dir)
    truth = split.where("split <> 'train'")
    own = rt.rmse_by(rt.als_predict(model, truth), truth, "split")
    again = rt.rmse_by(rt.factor_predictions(model, truth), truth, "split").select("split", F.col("matched").alias("also"), F.col("rmse").alias("again"))
    same = (F.col("matched") == F.col("also")) & (F.abs(F.col("rmse") - F.col("again")) < 1e-5)
    return own.join(again, "split").select("split", "matched", same.alias("same"))


def als_recommend_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best unseen items of every user."""
    model, split, _ = _als(spark, sf_dir)
    return rt.recommend_for_users(model, inputs.items(spark, sf_dir), split, split.select("user").distinct(), 5)


def als_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items recommended, without the model's numbers."""
    return als_recommend(spark, sf_dir).select("user", "item", "title")


def als_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split, user = _als(spark, sf_dir)
    return rt.recommend_unseen(model, inputs.items(spark, sf_dir), split, user)


JOBS = {
    "group_count": group_count,
    "group_count_sql": group_count_sql,
    "group_count_by_date": group_count_by_date,
    "filter_group_count": filter_group_count,
    "global_count": global_count,
    "join_group_count": join_group_count,
    "join_group_count_sql": join_group_count_sql,
    "json_roundtrip": json_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "csv_text_roundtrip": csv_text_roundtrip,
    "json_timestamp_roundtrip": json_timestamp_roundtrip,
    "string_key_filter": string_key_filter,
    "csv_infer": csv_infer,
    "csv_strings": csv_strings,
    "adjacency_parse": adjacency_parse,
    "basket_parse": basket_parse,
    "basket_lines": basket_lines,
    "csv_text_strings": csv_text_strings,
    "csv_text_inferred": csv_text_inferred,
    "vector_parse": vector_parse,
    "letter_counts": letters,
    "letters_from_text": letters_from_text,
    "stem_documents": stem_documents,
    "stem_tags": stem_tags,
    "tf_cosine_turns": tf_cosine_turns,
    "pymk_topk": pymk_topk,
    "pymk_most_linked": pymk_most_linked,
    "item_support": item_support,
    "pair_support": pair_support,
    "pair_support_sets": pair_support_sets,
    "pair_confidence": pair_confidence,
    "triple_support": triple_support,
    "triple_support_sets": triple_support_sets,
    "triple_confidence": triple_confidence,
    "baskets": baskets,
    "basket_names": basket_names,
    "fp_itemsets": fp_itemsets,
    "fp_rules": fp_rules,
    "fp_predict": fp_predict,
    "fp_predict_indexed": fp_predict_indexed,
    "kmeans_cost_sq": kmeans_cost_sq,
    "kmeans_from_files": kmeans_from_files,
    "kmeans_cost_l1": kmeans_cost_l1,
    "kmeans_assign": kmeans_assign,
    "kmeans_centers": kmeans_centers,
    "features_assembled": features_assembled,
    "silhouette_by_label": silhouette_by_label,
    "cluster_accuracy": cluster_accuracy,
    "kmeans_ml": kmeans_ml,
    "pca_kmeans": pca_kmeans,
    "pca_checked": pca_checked,
    "kmeans_ml_settled": kmeans_ml_settled,
    "item_features": item_features,
    "item_features_whitespace": item_features_whitespace,
    "item_avg_rating": item_avg_rating,
    "item_top_tags": item_top_tags,
    "item_master": item_master,
    "user_tag_profile": user_tag_profile,
    "user_year_profile": user_year_profile,
    "user_genre_profile": user_genre_profile,
    "user_profile": user_profile,
    "rating_split": rating_split,
    "train_union": train_union,
    "rmse_item_mean": rmse_item_mean,
    "unseen_items": unseen_items,
    "als_predict": als_predict,
    "als_rmse": als_rmse,
    "als_matched": als_matched,
    "als_predict_pairs": als_predict_pairs,
    "als_solved": als_solved,
    "als_rmse_checked": als_rmse_checked,
    "als_recommend_users": als_recommend_users,
    "als_candidates": als_candidates,
    "als_recommend": als_recommend,
}
