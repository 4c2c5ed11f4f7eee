"""People you may know: candidates by number of shared neighbours.

The score of ``(user, other)`` is the number of nodes both point to. Summing over every pair that
shares a node is quadratic in the number of nodes that point to it, so targets above ``hub_degree``
("hubs", however many) are counted another way, without loss:

* over ordinary targets, pairs come from an equi-join on the target, and such a pair's shared hubs
  from both nodes' sets of hubs;
* a candidate that shares only hubs with a user needs to be known only if it is among the user's
  first ``k + 1 + friends`` nodes by shared hubs (then by id), as a user skips no more than itself and
  its friends. Users with the same set of hubs ask as one class. Classes and nodes are dealt to
  blocks and slices; a unit of work holds one block's classes and, of one slice's nodes, each
  hub's posting list, adds up the shared hubs of a class over the lists and returns only the
  entries that the class may need. So the rows that leave the units follow the number of edges,
  not the hubs' squares.

Both parts are exact for any choice of hubs.

Without hubs and seeds no pair is shuffled at all: each edge brings its target's list of nodes to the
user, and blocks of users count what they received and keep ``k`` others each. Users that
would receive more than ``USER_ENTRIES`` are served like seeds, pair by pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tarn.operators.relational import broadcast_if_small, top_k
from tarn.session import materialise, stored

HUB_DEGREE = 10_000
#: List entries that a block of users receives on average, and that one user may receive at most.
BLOCK_ENTRIES, USER_ENTRIES = 2_000_000, 1_000_000
#: Edges to hubs that one slice of nodes holds: some 64 MB in a worker.
SLICE_EDGES = 4_000_000
#: Blocks of classes at least, for as many tasks.
BLOCKS = 16
#: Classes with more than one in so many users have the heads of their lists broadcast ...
LARGE_CLASSES = 1024
#: ... and this is how long a head is.
LIST_HEAD = 1_000


def people_you_may_know(
    edges: DataFrame,
    seeds: DataFrame | None = None,
    k: int = 10,
    hub_degree: int = HUB_DEGREE,
    slice_edges: int = SLICE_EDGES,
    list_head: int = LIST_HEAD,
    user_entries: int = USER_ENTRIES,
) -> DataFrame:
    """``(user, rank, other, shared)``: per user the ``k`` best strangers.

    A stranger is another node with edges of its own, not linked to the user in either
    direction, sharing at least one target. Order: shared descending, id ascending.
    ``seeds(user)`` limits the users served, before anything is joined.
    """
    edges = materialise(edges.select("src", "dst").dropna().distinct())
    hubs = materialise(edges.groupBy("dst").agg(F.count("*").alias("degree")).where(F.col("degree") > hub_degree))
    if not hubs.isEmpty():
        candidates = _with_hubs(edges, hubs, seeds, k, slice_edges, min(list_head, LIST_HEAD))
    elif seeds is None:
        candidates = _from_lists(edges, k, user_entries)
    else:
        candidates = _strangers(_shared(edges, seeds), edges)
    return top_k(candidates, ["user"], [F.desc("shared"), "other"], k).select(
        "user", "rank", "other", "shared"
    )


def _from_lists(edges: DataFrame, k: int, user_entries: int) -> DataFrame:
    """``(user, other, shared)`` with the ``k`` best strangers of each user at least."""
    id_type = edges.schema["src"].dataType.simpleString()
    narrow = edges
    if id_type == "bigint":
        # ids travel in 32 bits where all of them fit
        least, most = edges.select(F.min(F.least("src", "dst")), F.max(F.greatest("src", "dst"))).first()
        if least is not None and -(1 << 31) <= least and most < 1 << 31:
            narrow = edges.select(F.col("src").cast("int"), F.col("dst").cast("int"))
    lists = narrow.groupBy("dst").agg(F.collect_list("src").alias("others"))
    lists = stored(lists.withColumn("degree", F.size("others")), "target-lists")
    received = narrow.join(lists.select("dst", "degree"), "dst").groupBy(F.col("src").alias("user")).agg(F.sum("degree").alias("entries"))
    received = stored(received, "user-entries")
    heavy = received.where(F.col("entries") > user_entries).select("user")
    total = received.where(F.col("entries") <= user_entries).agg(F.sum("entries")).first()[0] or 0
    blocks = 1 + total // BLOCK_ENTRIES
    block = lambda user: F.pmod(F.xxhash64(F.col(user).cast(id_type)), F.lit(blocks)).alias("block")
    # a link counts in both directions; one to a heavy user still tells its friend
    links = narrow.select(F.inline(F.array(F.struct(F.col("src").alias("user"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("user"), F.col("src").alias("other")))))
    links = links.join(received.select("user"), "user", "left_semi")
    asking, some = narrow, not heavy.isEmpty()
    if some:
        heavy = broadcast_if_small(stored(heavy, "heavy-users"))
        asking = asking.join(heavy.withColumnRenamed("user", "src"), "src", "left_anti")
        links = links.join(heavy, "user", "left_anti")
    links = links.groupBy("user").agg(F.collect_list("other").alias("others")).select(block("user"), "user", "others", F.lit(True).alias("linked"))
    met = asking.join(lists.select("dst", "others"), "dst").select(block("src"), F.col("src").alias("user"), "others", F.lit(False).alias("linked"))
    rows = met.unionByName(links)
    parts = max(edges.sparkSession.sparkContext.defaultParallelism, blocks)
    schema = f"user {id_type}, other {id_type}, shared bigint"
    to = pa.schema([("user", to_arrow_type(edges.schema["src"].dataType)), ("other", to_arrow_type(edges.schema["src"].dataType)), ("shared", pa.int64())])
    found = rows.repartition(parts, "block").groupBy("block").applyInArrow(lambda held: _best_of_lists(held, k).cast(to), schema)
    if some:
        wide = heavy.select(F.col("user").cast(id_type).alias("user"))
        found = found.unionByName(_strangers(_shared(edges, wide), edges))
    return found


def _best_of_lists(held: pa.Table, k: int) -> pa.Table:
    """Of each user the ``k`` others met most often, then of the lowest id, that are not linked to it."""
    lists = held.column("others")
    entries, sizes = _flat(lists)
    ids = pa.chunked_array([*held.column("user").chunks, entries]).combine_chunks()
    names = ids.dictionary_encode()
    order = pc.sort_indices(names.dictionary)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    numbers = place[names.indices.to_numpy()]
    user, other = np.repeat(numbers[: held.num_rows], sizes), numbers[held.num_rows :]
    linked = np.repeat(held.column("linked").to_numpy(), sizes)
    pair = user * len(order) + other
    met, shared = np.unique(pair[~linked], return_counts=True)
    strange = ~np.isin(met, pair[linked]) & (met // max(len(order), 1) != met % max(len(order), 1))
    met, shared = met[strange], shared[strange]
    user, other = met // max(len(order), 1), met % max(len(order), 1)
    best = np.lexsort((other, -shared, user))
    user, other, shared = user[best], other[best], shared[best]
    keep = np.arange(len(user)) - np.searchsorted(user, user) < k
    names = names.dictionary.take(order)
    return pa.table({"user": names.take(pa.array(user[keep])), "other": names.take(pa.array(other[keep])), "shared": pa.array(shared[keep], pa.int64())})


def _shared(edges: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Shared targets per pair: each pair once (user < other), or from the seeds' side."""
    left = edges.select(F.col("src").alias("user"), "dst")
    right = edges.select(F.col("src").alias("other"), "dst")
    if seeds is None:
        pairs = left.join(right, "dst").where("user < other")
    else:
        left = left.join(seeds.select("user").distinct(), "user", "left_semi")
        pairs = left.join(right, "dst").where("user <> other")
    return pairs.groupBy("user", "other").agg(F.count("*").alias("shared"))


def _strangers(pairs: DataFrame, edges: DataFrame, ordered: bool = False) -> DataFrame:
    """Drop pairs linked in either direction, with one anti-join on the ordered pair.

    ``ordered`` says that user < other throughout; then the join reuses the partitioning
    that the pairs have from being counted.
    """
    linked = edges.select(
        F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high")
    )
    low, high = F.col("user"), F.col("other")
    if not ordered:
        low, high = F.least(low, high), F.greatest(low, high)
    return pairs.join(linked, (low == linked.low) & (high == linked.high), "left_anti")


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.inline(
            F.expr("array(struct(user, other, shared), struct(other AS user, user AS other, shared))")
        )
    )


def _with_hubs(
    edges: DataFrame, hubs: DataFrame, seeds: DataFrame | None, k: int, slice_edges: int, list_head: int
) -> DataFrame:
    hub_ids = broadcast_if_small(hubs.select("dst"))
    hub_edges = edges.join(hub_ids, "dst", "left_semi")
    sets = materialise(
        hub_edges.groupBy(F.col("src").alias("node")).agg(F.sort_array(F.collect_list("dst")).alias("hubs"))
    )
    ordinary = _shared(edges.join(hub_ids, "dst", "left_anti"), seeds)
    if seeds is None:
        ordinary = _both_ways(ordinary)
    sets_of = {
        side: sets.select(F.col("node").alias(side), F.col("hubs").alias(f"{side}_hubs"))
        for side in ("user", "other")
    }
    hub_share = F.size(F.array_intersect("user_hubs", "other_hubs"))
    ordinary = (
        ordinary.join(sets_of["user"], "user", "left")
        .join(sets_of["other"], "other", "left")
        .select("user", "other", (F.col("shared") + F.when(hub_share > 0, hub_share).otherwise(0)).alias("shared"))
    )

    # A user skips at most itself and its friends, so k + 1 + friends entries suffice.
    friends = (
        edges.select(F.explode(F.array("src", "dst")).alias("node"))
        .groupBy("node")
        .agg(F.count("*").alias("friends"))
    )
    users = sets.join(friends, "node").select(
        F.col("node").alias("user"), "hubs", (F.col("friends") + k + 1).alias("entries")
    )
    if seeds is not None:
        users = users.join(seeds.select("user").distinct(), "user", "left_semi")
    users = materialise(users)
    classes = users.groupBy("hubs").agg(F.max("entries").alias("entries"), F.count("*").alias("users"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()))
    lists = materialise(hub_lists(classes, sets, slice_edges))
    return _strangers(
        ordinary.unionByName(_read_lists(users.join(classes.drop("entries"), "hubs"), classes, lists, list_head))
        .where("user <> other")
        .groupBy("user", "other")
        .agg(F.max("shared").alias("shared")),
        edges,
    )


def hub_lists(classes: DataFrame, sets: DataFrame, slice_edges: int = SLICE_EDGES) -> DataFrame:
    """``(class, rank, other, shared)``: of each class the nodes that share most hubs, ids breaking ties.

    ``classes`` are ``(class, hubs, entries)``, ``sets`` are ``(node, hubs)``; a list is ``entries`` long, or
    ends with the last node that shares anything.
    """
    size = lambda rows: rows.agg(F.sum(F.size("hubs"))).first()[0] or 0
    slices = 1 + int(size(sets)) // slice_edges
    blocks = max(BLOCKS, 1 + int(size(classes)) // slice_edges)
    asked = classes.select(
        "class", "hubs", "entries", F.pmod(F.xxhash64("class"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
    )
    nodes = sets.select(
        "node", "hubs", F.pmod(F.xxhash64("node"), F.lit(slices)).alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    unit = ["block", "slice"]
    id_type = sets.schema["node"].dataType.simpleString()
    found = asked.groupBy(*unit).cogroup(nodes.groupBy(*unit)).applyInArrow(
        _share_hubs, f"class bigint, other {id_type}, shared bigint, entries bigint"
    )
    # of one slice nothing is left to merge but the ranks
    return top_k(found, ["class"], [F.desc("shared"), "other"], 1 << 62).where("rank <= entries").drop("entries")


def _share_hubs(asked: pa.Table, nodes: pa.Table) -> pa.Table:
    """The first ``entries`` nodes of each class by shared hubs, then by id."""
    nodes = nodes.take(pc.sort_indices(nodes.column("node"))).combine_chunks()
    asked = asked.combine_chunks()
    flat = [_flat(t.column("hubs")) for t in (asked, nodes)]
    names = pa.concat_arrays([f[0] for f in flat]).dictionary_encode()
    numbers = names.indices.to_numpy()
    wanted, held = numbers[: len(flat[0][0])], numbers[len(flat[0][0]) :]
    # posting lists: the places of the nodes that have a hub, in order of their ids
    order = np.argsort(held, kind="stable")
    owner = np.repeat(np.arange(nodes.num_rows), flat[1][1])[order]
    starts = np.searchsorted(held[order], np.arange(len(names.dictionary) + 1))
    ends = np.cumsum(flat[0][1])
    entries = asked.column("entries").to_numpy()
    places, shares, owners = [], [], []
    for row, (stop, size, most) in enumerate(zip(ends.tolist(), flat[0][1].tolist(), entries.tolist())):
        lists = [owner[starts[h] : starts[h + 1]] for h in wanted[stop - size : stop].tolist()]
        share = np.bincount(np.concatenate(lists), minlength=nodes.num_rows) if lists else np.zeros(nodes.num_rows, dtype=np.int64)
        # how many nodes share at least so many hubs; the last level that is needed may be cut
        above = np.cumsum(np.bincount(share, minlength=2)[::-1])[::-1]
        level = max(1, int(np.searchsorted(-above, -most, side="right")) - 1)
        best = np.flatnonzero(share > level)
        tied = np.flatnonzero(share == level)[: max(most - len(best), 0)]
        found = np.concatenate((best, tied))
        places.append(found)
        shares.append(share[found])
        owners.append(np.full(len(found), row))
    empty = [np.zeros(0, dtype=np.int64)]
    places, shares, owners = (np.concatenate(x + empty) for x in (places, shares, owners))
    return pa.table(
        {
            "class": asked.column("class").take(pa.array(owners)),
            "other": nodes.column("node").take(pa.array(places)),
            "shared": pa.array(shares, pa.int64()),
            "entries": asked.column("entries").take(pa.array(owners)),
        }
    )


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The lists' values, one after the other, and the lists' lengths."""
    whole = lists.combine_chunks()
    whole = whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
    return whole.flatten(), whole.value_lengths().to_numpy()


def _read_lists(users: DataFrame, classes: DataFrame, lists: DataFrame, list_head: int) -> DataFrame:
    """``(user, other, shared)``: of its class's list each user reads as much as it may need.

    The heads of the few lists that very many users read are broadcast.
    """
    total = classes.agg(F.sum("users")).first()[0] or 0
    large = F.col("users") * LARGE_CLASSES > total
    large_classes = classes.where(large).select("class")
    heads = lists.where(F.col("rank") <= list_head).join(F.broadcast(large_classes), "class", "left_semi")
    from_heads = _entries(users.where(large), 1, F.least("entries", F.lit(list_head)))
    tails = _entries(users.where(large & (F.col("entries") > list_head)), list_head + 1, F.col("entries"))
    others = _entries(users.where(~large), 1, F.col("entries"))
    read = from_heads.join(F.broadcast(heads), ["class", "rank"]).unionByName(
        others.unionByName(tails).join(lists, ["class", "rank"])
    )
    return read.select("user", "other", "shared")


def _entries(users: DataFrame, first: int, last) -> DataFrame:
    """One row per user and list position from ``first`` to ``last``."""
    positions = F.sequence(F.lit(first), last.cast("int"))
    return users.select("user", "class", F.explode(positions).alias("rank"))
