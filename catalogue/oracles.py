"""DuckDB SQL for every job that SQL can express, written from the job's definition."""

from __future__ import annotations

from tarn.functions.text import PUNCTUATION, STOP_WORDS

# White space of Unicode text, in the notation of DuckDB's regular expressions.
_SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# The words of the tag and genre fixtures with their Porter stems.
_STEMS = """
    automobile automobil   building build   furniture furnitur   household household
    machinery machineri   urgent urgent   high high   medium medium   not not
    specified specifi   low low   january januari   february februari   march march
    april april   may may   june june   july juli   august august   september septemb
    october octob   november novemb   december decemb   standard standard   promo promo
    economy economi   large larg   small small
""".split()


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_STEM_CTE = "stems(word, stem) AS (VALUES {})".format(
    ", ".join(f"('{w}', '{s}')" for w, s in zip(_STEMS[::2], _STEMS[1::2]))
)

# -- shared views of the inputs ------------------------------------------------------------

_RATINGS = """
ratings AS (
    SELECT o_custkey AS "user", l_partkey AS item, l_quantity / 10 AS rating,
           date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS ts
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_SPLIT = """
split AS (
    SELECT *, CASE WHEN ts % 10 < 6 THEN 'train' WHEN ts % 10 < 8 THEN 'validation'
                   ELSE 'test' END AS split
    FROM ratings)"""

_ACTIVE = """
active AS (
    SELECT "user" FROM ratings GROUP BY "user" ORDER BY count(*) DESC, "user" LIMIT 1)"""

_TAG_WORDS = f"""
{_STEM_CTE},
tag_words AS (
    SELECT item, coalesce(stem, word) AS stem
    FROM (SELECT l_partkey AS item,
                 unnest(string_split(lower(concat(c_mktsegment, ' ', substr(o_orderpriority, 3),
                                                  ' ', monthname(l_shipdate))), ' ')) AS word
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey) w
    LEFT JOIN stems USING (word))"""

_TAG_COUNTS = _TAG_WORDS + """,
tag_counts AS (SELECT item, stem, count(*) AS n FROM tag_words GROUP BY item, stem),
top_tags AS (
    SELECT item, stem, n, rank
    FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, stem) AS rank
          FROM tag_counts)
    WHERE rank <= 10)"""

_GENRES = """
genres AS (
    SELECT p_partkey AS item, coalesce(stem, lower(p_type)) AS genre, 1 AS place
    FROM part LEFT JOIN stems ON word = lower(p_type)
    UNION ALL
    SELECT p_partkey, lower(p_brand), 2 FROM part)"""


def _title_words(tokens: str) -> str:
    return f"""
titles AS (
    SELECT p_partkey AS item, concat('The ', p_name, ' of ', p_brand, ' (', 1990 + p_size, ')') AS title
    FROM part),
tokens AS (SELECT item, title, {tokens} AS words FROM titles),
title_words AS (
    SELECT item, regexp_extract(title, '[0-9]{{4}}') AS year,
           array_to_string([w FOR w IN words
                            IF w NOT IN ({_quoted(STOP_WORDS)})
                            AND w NOT IN ({_quoted(PUNCTUATION)})
                            AND NOT regexp_full_match(w, '[0-9]+')], ' ') AS title_words
    FROM tokens)"""


_WORD_TOKENS = r"regexp_extract_all(lower(title), '[a-z0-9]+|[^a-z0-9\s]')"
_SPACE_TOKENS = "string_split(lower(title), ' ')"

_FEATURES = """
features AS (
    SELECT item, year, title_words,
           (SELECT string_agg(genre, ' ' ORDER BY place) FROM genres g WHERE g.item = t.item) AS genre_words
    FROM title_words t)"""

_MASTER_ITEMS = """
master_items AS (SELECT DISTINCT item FROM tag_words)"""


def _features(tokens: str) -> str:
    return f"WITH {_STEM_CTE}, {_GENRES}, {_title_words(tokens)}, {_FEATURES} SELECT * FROM features"


def _user_top(trait: str, rows: str, k: int) -> str:
    return f"""
        SELECT "user", {trait}, score, rank
        FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, {trait}) AS rank
              FROM (SELECT "user", {trait}, round(sum(rating), 6) AS score
                    FROM ({rows}) GROUP BY "user", {trait}))
        WHERE rank <= {k}"""


_USER_TAGS = _user_top("stem", "SELECT * FROM ratings JOIN tag_words USING (item)", 20)
_USER_YEARS = _user_top(
    "year",
    """SELECT r.*, year FROM ratings r JOIN title_words USING (item)
       WHERE item IN (SELECT item FROM master_items)""",
    10,
)
_USER_GENRES = _user_top(
    "genre",
    """SELECT r.*, genre FROM ratings r JOIN genres USING (item)
       WHERE item IN (SELECT item FROM master_items)""",
    10,
)

# -- baskets -------------------------------------------------------------------------------

_LINES = """
lines AS (
    SELECT l_orderkey AS basket, p_brand AS item,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos
    FROM lineitem JOIN part ON l_partkey = p_partkey),
total AS (SELECT count(DISTINCT basket) AS baskets FROM lines)"""


def _enough(share: float) -> str:
    return f"CAST({share} AS DOUBLE) * (SELECT baskets FROM total)"


def _items(share: float) -> str:
    return f"""
items AS (
    SELECT item, count(*) AS n FROM lines GROUP BY item HAVING count(*) >= {_enough(share)})"""


def _pairs(share: float) -> str:
    return f"""
pairs AS (
    SELECT least(x.item, y.item) AS a, greatest(x.item, y.item) AS b, count(*) AS n
    FROM lines x JOIN lines y ON x.basket = y.basket AND x.pos < y.pos
    WHERE x.item IN (SELECT item FROM items) AND y.item IN (SELECT item FROM items)
    GROUP BY 1, 2 HAVING count(*) >= {_enough(share)})"""


def _triples(share: float) -> str:
    return f"""
triples AS (
    SELECT t[1] AS a, t[2] AS b, t[3] AS c, count(*) AS n
    FROM (SELECT list_sort([x.item, y.item, z.item]) AS t
          FROM lines x
          JOIN lines y ON x.basket = y.basket AND x.pos < y.pos
          JOIN lines z ON x.basket = z.basket AND y.pos < z.pos)
    GROUP BY 1, 2, 3 HAVING count(*) >= {_enough(share)})"""


_SETS = """
sets AS (SELECT DISTINCT l_orderkey AS basket, p_brand AS item
         FROM lineitem JOIN part ON l_partkey = p_partkey),
total AS (SELECT count(DISTINCT basket) AS baskets FROM sets)"""

_SUPPORT = "ceil(CAST(0.003 AS DOUBLE) * (SELECT baskets FROM total))"

_ITEMSETS = f"""
{_SETS},
subsets AS (
    SELECT basket, [item] AS items, item AS last FROM sets
    UNION ALL
    SELECT s.basket, list_append(s.items, x.item), x.item
    FROM subsets s JOIN sets x ON s.basket = x.basket AND x.item > s.last),
itemsets AS (SELECT items, count(*) AS freq FROM subsets GROUP BY items HAVING count(*) >= {_SUPPORT})"""

_RULES = _ITEMSETS + """,
splits AS (
    SELECT list_filter(items, lambda i: i <> c) AS antecedent, c AS consequent, freq
    FROM (SELECT items, freq, unnest(items) AS c FROM itemsets WHERE len(items) > 1)),
rules AS (
    SELECT s.antecedent, s.consequent, s.freq / i.freq AS confidence,
           (s.freq / i.freq) / (o.freq / (SELECT baskets FROM total)) AS lift,
           s.freq / (SELECT baskets FROM total) AS support
    FROM splits s JOIN itemsets i ON i.items = s.antecedent JOIN itemsets o ON o.items = [s.consequent]
    WHERE s.freq / i.freq >= CAST(0.15 AS DOUBLE))"""

# -- k-means -------------------------------------------------------------------------------

_POINTS = """
p AS (SELECT vec_id, label, CAST(label >= 5 AS INTEGER) AS truth,
             generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
      FROM embeddings)"""

ROUNDS = 20
_DISTANCE = {"sqeuclidean": "(p.x - c.x) * (p.x - c.x)", "manhattan": "abs(p.x - c.x)"}


def _assignment(name: str, centers: str, metric: str) -> str:
    return f"""
{name} AS MATERIALIZED (
    SELECT vec_id, c, dist
    FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) AS place
          FROM (SELECT p.vec_id, c.c, avg({_DISTANCE[metric]}) AS dist
                FROM p JOIN {centers} c USING (i) GROUP BY p.vec_id, c.c))
    WHERE place = 1)"""


def _lloyd(metric: str, rounds: int = ROUNDS) -> str:
    ctes = [_POINTS, "c0 AS (SELECT label AS c, i, avg(x) AS x FROM p GROUP BY label, i)"]
    for r in range(rounds):
        ctes.append(_assignment(f"a{r}", f"c{r}", metric))
        ctes.append(
            f"c{r + 1} AS MATERIALIZED (SELECT c, i, avg(x) AS x FROM p JOIN a{r} USING (vec_id) GROUP BY c, i)"
        )
    return "WITH " + ",".join(ctes)


def _cost(metric: str) -> str:
    rounds = " UNION ALL ".join(
        f'SELECT {r + 1} AS "round", round(sum(dist), 6) AS cost FROM a{r}' for r in range(ROUNDS)
    )
    return f"{_lloyd(metric)} {rounds}"



def _neighbours(users: str) -> str:
    return f"""
        WITH edges AS (SELECT DISTINCT o_custkey AS src, l_partkey AS dst
                       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        shared AS (SELECT x.src AS "user", y.src AS other, count(*) AS shared
                   FROM {users} x JOIN edges y ON x.dst = y.dst AND x.src <> y.src
                   GROUP BY 1, 2)
        SELECT "user", CAST(rank AS INTEGER) AS rank, other, shared
        FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY shared DESC, other) AS rank
              FROM shared s
              WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.src = s."user" AND e.dst = s.other)
                AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.src = s.other AND e.dst = s."user"))
        WHERE rank <= 10"""


# What ALS was trained on: the training split and all of the most active user.
_KNOWN = """
learned AS (SELECT "user", item FROM split WHERE split = 'train'
            UNION ALL SELECT "user", item FROM ratings WHERE "user" IN (SELECT "user" FROM active)),
known_users AS (SELECT DISTINCT "user" FROM learned),
known_items AS (SELECT DISTINCT item FROM learned)"""

ORACLES = {
    "group_count": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "group_count_sql": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "group_count_by_date": """
        SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n
        FROM events GROUP BY 1, 2""",
    "filter_group_count": """
        SELECT user_id, count(*) AS n FROM events
        WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type = 'error' GROUP BY user_id""",
    "global_count": "SELECT count(*) AS n FROM lineitem",
    "join_group_count": """
        SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_type""",
    "join_group_count_sql": """
        SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_type""",
    "json_roundtrip": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
        FROM events""",
    "csv_roundtrip": "SELECT * FROM part",
    "csv_text_roundtrip": "SELECT * FROM documents",
    "json_timestamp_roundtrip": """
        SELECT event_id, strftime(ts + to_microseconds(event_id % 1000000), '%Y-%m-%d %H:%M:%S.%f') AS ts
        FROM events""",
    "string_key_filter": """
        SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey
        FROM supplier WHERE s_nationkey = 1""",
    "basket_names": """
        SELECT l_orderkey AS basket, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "features_assembled": " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS i, count(*) AS n, round(sum(CAST({c} AS DOUBLE)), 2) AS total FROM lineitem"
        for i, c in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    ),
    "csv_infer": "SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part",
    "csv_strings": "SELECT * FROM supplier",
    "adjacency_parse": """
        SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem
        UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem""",
    "basket_parse": f"""
        SELECT item, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '{_SPACE}')) AS item FROM documents)
        WHERE item <> '' GROUP BY item""",
    "vector_parse": f"""
        WITH {_POINTS} SELECT vec_id, CAST(i - 1 AS INTEGER) AS i,
                              CAST(CAST(CAST(x AS FLOAT) AS VARCHAR) AS DOUBLE) AS x FROM p""",
    "letter_counts": rf"""
        SELECT lower(substr(w, 1, 1)) AS letter, count(*) AS count
        FROM (SELECT unnest(regexp_split_to_array(text, '{_SPACE}')) AS w FROM documents)
        WHERE regexp_full_match(w, '\p{{L}}+') GROUP BY 1""",
    "stem_tags": f"WITH {_TAG_WORDS} SELECT stem, count(*) AS n FROM tag_words GROUP BY stem",
    "tf_cosine_turns": f"""
        WITH words AS (
            SELECT conv_id, turn, lower(w) AS token, count(*) AS tf
            FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(text, '{_SPACE}')) AS w
                  FROM conversations)
            WHERE w <> '' GROUP BY 1, 2, 3),
        norms AS (SELECT conv_id, turn, sqrt(sum(tf * tf)) AS norm FROM words GROUP BY 1, 2),
        dots AS (SELECT x.conv_id, x.turn, sum(x.tf * y.tf) AS dot
                 FROM words x JOIN words y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1
                                          AND x.token = y.token
                 GROUP BY 1, 2)
        SELECT a.conv_id, a.turn, round(coalesce(dot, 0) / (n.norm * m.norm), 6) AS cosine
        FROM conversations a
        JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
        LEFT JOIN dots d ON d.conv_id = a.conv_id AND d.turn = a.turn
        LEFT JOIN norms n ON n.conv_id = a.conv_id AND n.turn = a.turn
        LEFT JOIN norms m ON m.conv_id = b.conv_id AND m.turn = b.turn""",
    "pymk_topk": _neighbours("edges"),
    "pymk_most_linked": _neighbours(
        "(SELECT * FROM edges WHERE src IN (SELECT src FROM edges GROUP BY src "
        "ORDER BY count(*) DESC, src LIMIT 10))"
    ),
    "item_support": f"WITH {_LINES}, {_items(0.02)} SELECT item, n FROM items",
    "pair_support": f"WITH {_LINES}, {_items(0.02)}, {_pairs(0.02)} SELECT * FROM pairs",
    "pair_support_sets": f"""
        WITH {_SETS} SELECT x.item AS a, y.item AS b, count(*) AS n
        FROM sets x JOIN sets y ON x.basket = y.basket AND x.item < y.item
        GROUP BY 1, 2 HAVING count(*) >= {_enough(0.02)}""",
    "pair_confidence": f"""
        WITH {_LINES}, {_items(0.02)}, {_pairs(0.02)},
        rules AS (SELECT a AS lhs, b AS rhs, n FROM pairs UNION ALL SELECT b, a, n FROM pairs)
        SELECT lhs, rhs, round(r.n / i.n, 6) AS confidence FROM rules r JOIN items i ON item = lhs""",
    "triple_support": f"WITH {_LINES}, {_triples(0.003)} SELECT * FROM triples",
    "triple_support_sets": f"""
        WITH {_SETS} SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS n
        FROM sets x JOIN sets y ON x.basket = y.basket AND x.item < y.item
        JOIN sets z ON x.basket = z.basket AND y.item < z.item
        GROUP BY 1, 2, 3 HAVING count(*) >= {_enough(0.003)}""",
    "triple_confidence": f"""
        WITH {_LINES}, {_items(0.003)}, {_pairs(0.003)}, {_triples(0.003)},
        rules AS (SELECT a AS lhs1, b AS lhs2, c AS rhs, n FROM triples
                  UNION ALL SELECT a, c, b, n FROM triples
                  UNION ALL SELECT b, c, a, n FROM triples)
        SELECT lhs1, lhs2, rhs, round(r.n / p.n, 6) AS confidence
        FROM (SELECT lhs1, lhs2, rhs, sum(n) AS n FROM rules GROUP BY 1, 2, 3) r
        JOIN pairs p ON p.a = lhs1 AND p.b = lhs2""",
    "baskets": f"""
        WITH {_SETS} SELECT basket, CAST(count(*) AS INTEGER) AS size,
                            string_agg(item, ' ' ORDER BY item) AS items
        FROM sets GROUP BY basket""",
    "fp_itemsets": f"""
        WITH RECURSIVE {_ITEMSETS} SELECT array_to_string(items, ' ') AS items, freq FROM itemsets""",
    "fp_rules": f"""
        WITH RECURSIVE {_RULES} SELECT array_to_string(antecedent, ' ') AS antecedent, consequent,
                             round(confidence, 6) AS confidence, round(lift, 6) AS lift,
                             round(support, 6) AS support
        FROM rules""",
    "fp_predict": f"""
        WITH RECURSIVE {_RULES},
        numbered AS (SELECT *, row_number() OVER () AS rule FROM rules),
        needs AS (SELECT rule, consequent, len(antecedent) AS need, unnest(antecedent) AS item
                  FROM numbered),
        satisfied AS (SELECT basket, rule, consequent FROM sets JOIN needs USING (item)
                      GROUP BY basket, rule, consequent, need HAVING count(*) = need),
        found AS (SELECT DISTINCT f.basket, consequent
                  FROM satisfied f LEFT JOIN sets s ON s.basket = f.basket AND s.item = consequent
                  WHERE s.item IS NULL)
        SELECT basket, coalesce(string_agg(consequent, ' ' ORDER BY consequent), '') AS prediction
        FROM (SELECT DISTINCT basket FROM sets) LEFT JOIN found USING (basket) GROUP BY basket""",
    "kmeans_cost_sq": _cost("sqeuclidean"),
    "kmeans_cost_l1": _cost("manhattan"),
    "kmeans_assign": f"""
        {_lloyd("sqeuclidean")}, {_assignment("final", f"c{ROUNDS}", "sqeuclidean")}
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, round(dist, 6) AS distance FROM final""",
    "kmeans_centers": f"""
        {_lloyd("sqeuclidean")}
        SELECT CAST(c AS INTEGER) AS cluster, CAST(i - 1 AS INTEGER) AS i, round(x, 6) AS x FROM c{ROUNDS}""",
    "silhouette_by_label": f"""
        WITH {_POINTS},
        apart AS (SELECT a.vec_id, a.label AS own, b.label AS other, b.vec_id AS to_id,
                         sum((a.x - b.x) * (a.x - b.x)) AS d
                  FROM p a JOIN p b USING (i) GROUP BY 1, 2, 3, 4),
        sizes AS (SELECT label, count(*) AS size FROM embeddings GROUP BY label),
        means AS (SELECT vec_id, own, other, sum(d) AS total FROM apart GROUP BY 1, 2, 3),
        sides AS (SELECT vec_id,
                         max(CASE WHEN own = other THEN total / (size - 1) END) AS inner_mean,
                         min(CASE WHEN own <> other THEN total / size END) AS outer_mean
                  FROM means JOIN sizes ON label = other GROUP BY vec_id)
        SELECT round(avg((outer_mean - inner_mean) / greatest(inner_mean, outer_mean)), 6) AS silhouette
        FROM sides""",
    "cluster_accuracy": f"""
        WITH {_POINTS}, c0 AS (SELECT truth AS c, i, avg(x) AS x FROM p GROUP BY truth, i),
        {_assignment("a", "c0", "sqeuclidean")},
        counts AS (SELECT count(*) FILTER (c = CAST(label >= 5 AS INTEGER)) AS same, count(*) AS n
                   FROM a JOIN embeddings USING (vec_id))
        SELECT greatest(same, n - same) AS correct, n,
               round(greatest(same, n - same) / n, 6) AS accuracy FROM counts""",
    "item_features": _features(_WORD_TOKENS),
    "item_features_whitespace": _features(_SPACE_TOKENS),
    "item_avg_rating": f"""
        WITH {_RATINGS} SELECT item, round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY item""",
    "item_top_tags": f"""
        WITH {_TAG_COUNTS} SELECT item, stem, n, CAST(rank AS INTEGER) AS rank FROM top_tags""",
    "item_master": f"""
        WITH {_RATINGS}, {_TAG_COUNTS}, {_GENRES}, {_title_words(_WORD_TOKENS)}, {_FEATURES},
        averages AS (SELECT item, round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY item),
        lists AS (SELECT item, string_agg(stem, ' ' ORDER BY rank) AS tags FROM top_tags GROUP BY item)
        SELECT item, year, title_words, genre_words, avg_rating, tags
        FROM features JOIN averages USING (item) JOIN lists USING (item)""",
    "user_tag_profile": f"""
        WITH {_RATINGS}, {_TAG_WORDS}
        SELECT "user", stem, score, CAST(rank AS INTEGER) AS rank FROM ({_USER_TAGS})""",
    "user_year_profile": f"""
        WITH {_RATINGS}, {_TAG_WORDS}, {_MASTER_ITEMS}, {_title_words(_WORD_TOKENS)}
        SELECT "user", year, score, CAST(rank AS INTEGER) AS rank FROM ({_USER_YEARS})""",
    "user_genre_profile": f"""
        WITH {_RATINGS}, {_TAG_WORDS}, {_MASTER_ITEMS}, {_GENRES}
        SELECT "user", genre, score, CAST(rank AS INTEGER) AS rank FROM ({_USER_GENRES})""",
    "user_profile": f"""
        WITH {_RATINGS}, {_TAG_WORDS}, {_MASTER_ITEMS}, {_title_words(_WORD_TOKENS)}, {_GENRES},
        t AS (SELECT "user", string_agg(stem, ' ' ORDER BY rank) AS tags FROM ({_USER_TAGS}) GROUP BY 1),
        y AS (SELECT "user", string_agg(year, ' ' ORDER BY rank) AS years FROM ({_USER_YEARS}) GROUP BY 1),
        g AS (SELECT "user", string_agg(genre, ' ' ORDER BY rank) AS genres FROM ({_USER_GENRES}) GROUP BY 1)
        SELECT "user", tags, years, genres FROM t JOIN y USING ("user") JOIN g USING ("user")""",
    "rating_split": f"WITH {_RATINGS}, {_SPLIT} SELECT * FROM split",
    "train_union": f"""
        WITH {_RATINGS}, {_SPLIT}, {_ACTIVE}
        SELECT "user", item, rating, ts FROM split WHERE split = 'train'
        UNION ALL SELECT "user", item, rating, ts FROM ratings WHERE "user" IN (SELECT "user" FROM active)""",
    "rmse_item_mean": f"""
        WITH {_RATINGS}, {_SPLIT},
        means AS (SELECT item, avg(rating) AS prediction FROM split WHERE split = 'train' GROUP BY item)
        SELECT count(*) AS matched,
               round(sqrt(sum((prediction - rating) * (prediction - rating))
                          / (SELECT count(*) FROM split WHERE split = 'validation')), 6) AS rmse
        FROM split JOIN means USING (item) WHERE split = 'validation'""",
    "unseen_items": f"""
        WITH {_RATINGS}, {_ACTIVE}
        SELECT (SELECT "user" FROM active) AS "user", p_partkey AS item FROM part
        WHERE p_partkey NOT IN (SELECT item FROM ratings WHERE "user" IN (SELECT "user" FROM active))""",
    "als_matched": f"""
        WITH {_RATINGS}, {_SPLIT}, {_ACTIVE}, {_KNOWN}
        SELECT split, count(*) FILTER ("user" IN (FROM known_users) AND item IN (FROM known_items)) AS matched
        FROM split WHERE split <> 'train' GROUP BY split""",
    "als_predict_pairs": f"""
        WITH {_RATINGS}, {_SPLIT}, {_ACTIVE}, {_KNOWN}
        SELECT DISTINCT "user", item FROM split
        WHERE split = 'validation' AND "user" IN (FROM known_users) AND item IN (FROM known_items)""",
    "als_candidates": f"""
        WITH {_RATINGS}, {_SPLIT}, {_ACTIVE}, {_KNOWN}
        SELECT (SELECT "user" FROM active) AS "user", p_partkey AS item,
               concat('The ', p_name, ' of ', p_brand, ' (', 1990 + p_size, ')') AS title
        FROM part
        WHERE p_partkey NOT IN (SELECT item FROM ratings WHERE "user" IN (SELECT "user" FROM active))
          AND p_partkey IN (FROM known_items)""",
}
# the same rows, read from text files
ORACLES["letters_from_text"] = ORACLES["letter_counts"]
ORACLES["kmeans_from_files"] = ORACLES["kmeans_cost_sq"]

#: The index must predict what the model's own way does.
ORACLES["fp_predict_indexed"] = ORACLES["fp_predict"]
ORACLES["basket_lines"] = """
    SELECT basket, unnest(string_split(o_orderstatus || ' ' || o_orderpriority || ' ' || o_orderstatus, ' ')) AS item
    FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS basket, o_orderstatus, o_orderpriority FROM orders)"""
ORACLES["csv_text_strings"] = "SELECT * FROM documents"
ORACLES["csv_text_inferred"] = "SELECT conv_id, turn, role, text FROM conversations"
ORACLES["kmeans_ml_settled"] = """
    SELECT CAST(2 AS BIGINT) AS clusters, count(*) AS points, CAST(0 AS BIGINT) AS misplaced, TRUE AS settled FROM embeddings"""
ORACLES["pca_checked"] = f"""
    WITH {_POINTS}, spread AS (SELECT i, var_samp(x) AS v FROM p GROUP BY i)
    SELECT CAST(component AS INTEGER) AS component, round(sum(v), 6) AS variance, TRUE AS eigenvector, TRUE AS explains
    FROM spread, (VALUES (1), (2)) c(component) GROUP BY component"""
ORACLES["als_solved"] = f"""
    WITH {_RATINGS}, {_SPLIT}, {_ACTIVE},
    train AS (SELECT "user" FROM split WHERE split = 'train'
              UNION ALL SELECT "user" FROM ratings WHERE "user" IN (SELECT "user" FROM active))
    SELECT count(DISTINCT "user") AS users, count(*) AS ratings, count(DISTINCT "user") AS solved FROM train"""
ORACLES["als_rmse_checked"] = f"SELECT split, matched, TRUE AS same FROM ({ORACLES['als_matched']})"
