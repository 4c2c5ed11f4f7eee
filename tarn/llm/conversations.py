"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns. Its turns are cut into blocks of ``BLOCK``; a block's digest is
that of its turns, and the digests of a conversation's first blocks together name the prefix they
spell (exclusive or of 128 bits of hash of each block and its place). Conversations are grouped by
these prefixes first. Where all conversations that agree so far also agree in the next block, its
turns are one chain of nodes that needs no grouping; only blocks in which siblings diverge are opened
and grouped turn by turn, and there each distinct block once, weighted by its conversations.

Equal conversations are one path from the start. A node belongs to the smallest conversation that
passes through it; the nodes of one path that belong to its own conversation are a tail of it. So a
subtree's sum is the sum of whole tails over the paths through its top, less the part of the top's
own tail that lies above. Hence all sums are made by the same two groupings, and none walks a tree.

The turns of one very long conversation are numbered in spans of ``SPAN`` and never meet in one list.
The only thing that is a list is the text of the ends' digest, which is hashed piece by piece, in order.

Defined results: turns are ordered by number (null first), then role, then text; null roles and texts are
empty; repeated rows are turns of their own; rows without a conversation id are left out; an empty
table gives no rows, not even the root; a conversation without turns after rebuilding is a member of
the root alone; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import hot_join, store

#: Turns of a block; and of a stretch of a conversation that one task numbers.
BLOCK, SPAN = 8, 1024
#: Range of conversation ids that share a piece of an ends' list.
PIECE = 4096
SEEDS = (101, 202)


def _running(rows: DataFrame, key: str, order: list[Column | str], span: Column, sums: list[str], exclusive: bool = False) -> DataFrame:
    """``rows`` with the columns ``sums`` summed from the first row of a key up to each row, or
    combined by exclusive or.

    ``span`` numbers stretches of a key's rows and must grow with the order. Each stretch is run
    through on its own; of a key only the stretches' totals meet.
    """
    total = F.bit_xor if exclusive else F.sum
    spanned = rows.withColumn("_span", span)
    inside = Window.partitionBy(key, "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    totals = spanned.groupBy(key, "_span").agg(*[total(name).alias(f"_{name}") for name in sums])
    before = totals.select(key, "_span", *[total(f"_{name}").over(earlier).alias(f"_{name}") for name in sums]).dropna()
    local = spanned.withColumns({name: total(name).over(inside) for name in sums}).join(before, [key, "_span"], "left")
    carried = {name: F.coalesce(f"_{name}", F.lit(0)) for name in sums}
    merged = {name: F.col(name).bitwiseXOR(c) if exclusive else F.col(name) + c for name, c in carried.items()}
    return local.withColumns(merged).drop("_span", *[f"_{name}" for name in sums])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, d1, d2, bytes)``: each conversation's turns from 1 on, their digest and their text's size."""
    text, role = (F.coalesce(F.col(name), F.lit("")) for name in ("text", "role"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    span = F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(1 << 62)))
    order = [F.asc_nulls_first("turn"), "role", "text"]
    placed = _running(rows.withColumn("pos", F.lit(1).cast("bigint")), "conv_id", order, span, ["pos"])
    digests = [F.xxhash64(F.lit(seed), "role", "text").alias(f"d{k}") for k, seed in enumerate(SEEDS, 1)]
    return placed.select("conv_id", "pos", *digests, F.octet_length("text").cast("bigint").alias("bytes"))


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of another one: stored ``(conv_id, depth, d1, d2, bytes)``, and all
    ids ``(conv_id)``.

    Conversation c begins with the first h turns of conversation c - c % group and goes on with its own
    turns after its first h, where h is a checksum of c modulo ``heads``.
    """
    entry = F.struct("pos", "d1", "d2", "bytes")
    head = turns.filter(F.col("pos") < heads).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(entry)).alias("head"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    ids = turns.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", taken)
    begun = F.slice(F.coalesce("head", F.array().cast(head.schema["head"].dataType)), 1, F.col("h").cast("int"))
    plan = store(ids.join(head, "base", "left").select("conv_id", "h", begun.alias("begun")), "trie-heads")
    first = plan.select("conv_id", F.explode("begun").alias("turn")).select("conv_id", F.col("turn.pos").alias("depth"), "turn.d1", "turn.d2", "turn.bytes")
    own = hot_join(turns, plan.select("conv_id", "h", F.size("begun").alias("begun")), ["conv_id"]).filter("pos > h")
    own = own.select("conv_id", (F.col("begun") + F.col("pos") - F.col("h")).alias("depth"), "d1", "d2", "bytes")
    return store(first.unionByName(own), "trie-turns"), plan.select("conv_id")


def _blocks(turns: DataFrame) -> DataFrame:
    """``(conv_id, j, turns, p1, p2, q1, q2)``: the blocks, what names the prefix up to and with each (p),
    and the one before it (q)."""
    block = F.floor((F.col("depth") - 1) / BLOCK)
    rows = turns.groupBy("conv_id", block.alias("j")).agg(F.sort_array(F.collect_list(F.struct("depth", "d1", "d2", "bytes"))).alias("turns"))
    own = {f"o{k}": F.xxhash64("j", f"turns.d{k}") for k in (1, 2)}
    rows = rows.withColumns(own).withColumns({"p1": F.col("o1"), "p2": F.col("o2")})
    run = _running(rows, "conv_id", ["j"], F.floor(F.col("j") * BLOCK / SPAN), ["p1", "p2"], exclusive=True)
    return run.withColumns({f"q{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"o{k}")) for k in (1, 2)}).drop("o1", "o2")


def _opened(blocks: DataFrame) -> DataFrame:
    """Each distinct block's turns as nodes: ``(i1, i2, depth, u1, u2, bytes, n, least, p1, p2, alone)``;
    i names the node, u its parent."""
    name = lambda k, size: F.when(size == 0, F.col(f"q{k}")).otherwise(F.col(f"q{k}").bitwiseXOR(F.xxhash64("j", F.slice(f"turns.d{k}", 1, size))))
    nodes = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda t: F.struct(
            name(1, t).alias("i1"), name(2, t).alias("i2"), name(1, t - 1).alias("u1"), name(2, t - 1).alias("u2"),
            F.element_at("turns", t)["depth"].alias("depth"), F.element_at("turns", t)["bytes"].alias("bytes"),
        ),
    )
    return blocks.select(F.explode(nodes).alias("node"), "n", "least", "p1", "p2", "alone").select("node.*", "n", "least", "p1", "p2", "alone")


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """``(p1, p2, ends_sha256)``: the ids that end at each node, in pieces, hashed in order."""
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(PIECE))
    ids = F.sort_array(F.collect_list("conv_id"))
    pieces = ends.groupBy("p1", "p2", first.alias("piece")).agg(F.array_join(ids.cast("array<string>"), ",").alias("ids"))

    def sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            out = []
            for p1, p2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (p1, p2) != node:
                    if node is not None:
                        out.append((*node, running.hexdigest()))
                    node, running = (p1, p2), hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield _ends_batch(out)
        if node is not None:
            yield _ends_batch([(*node, running.hexdigest())])

    ordered = pieces.select("p1", "p2", "piece", "ids").repartition("p1", "p2").sortWithinPartitions("p1", "p2", "piece")
    return ordered.mapInArrow(sha, "p1 bigint, p2 bigint, ends_sha256 string")


def _ends_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["p1", "p2", "ends_sha256"])


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie of stored ``(conv_id, depth, d1, d2, bytes)`` over all conversations ``ids``; one row a node:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    blocks = store(_blocks(turns), "trie-blocks")
    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2"), "j").alias("end"))
    ends = ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"end.p{k}", F.lit(0)).alias(f"p{k}") for k in (1, 2)])
    ends = store(ends, "trie-ends")
    paths = ends.groupBy("p1", "p2").agg(F.count("*").alias("w"), F.min("conv_id").alias("conv_id"))
    members = store(hot_join(blocks, paths.select("conv_id", "w"), ["conv_id"]), "trie-members")
    # blocks first, then turns where siblings diverge
    distinct = members.groupBy("j", "q1", "q2", "p1", "p2").agg(F.sum("w").alias("n"), F.min("conv_id").alias("least"), F.first("turns").alias("turns"))
    distinct = store(distinct, "trie-distinct")
    siblings = distinct.groupBy("q1", "q2").agg((F.count("*") == 1).alias("alone"))
    opened = store(_opened(hot_join(distinct, siblings, ["q1", "q2"])), "trie-opened")
    node = ["i1", "i2", "depth", "u1", "u2", "bytes"]
    merged = opened.filter(~F.col("alone")).groupBy(*node).agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    nodes = opened.filter("alone").select(*node, "n", "least").unionByName(merged)
    nodes = store(nodes, "trie-nodes")
    kids = store(nodes.groupBy(F.col("u1").alias("i1"), F.col("u2").alias("i2")).agg(F.count("*").alias("kids")), "trie-kids")
    nodes = nodes.join(kids, ["i1", "i2"], "left").fillna(0, ["kids"]).withColumn("x", (F.col("n") - 1) * F.col("bytes"))
    nodes = store(nodes.withColumn("upto", F.col("x")), "trie-counted")
    tails = nodes.groupBy(F.col("least").alias("conv_id")).agg(F.sum("x").alias("saved"), F.count_if(F.col("kids") == 0).alias("leaves"))
    tails = store(tails, "trie-tails")
    # the same two groupings once more, with the tails in place of the numbers of conversations
    sums = hot_join(members.select("conv_id", "p1", "p2"), tails, ["conv_id"]).groupBy("p1", "p2").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    sums = opened.select("i1", "i2", "alone", "p1", "p2").join(sums, ["p1", "p2"])
    totals = ["saved", "leaves"]
    split = sums.filter(~F.col("alone")).groupBy("i1", "i2").agg(*[F.sum(t).alias(t) for t in totals])
    sums = sums.filter("alone").select("i1", "i2", *totals).unionByName(split)
    above = _running(nodes, "least", ["depth"], F.floor(F.col("depth") / SPAN), ["upto"])
    rows = above.join(sums, ["i1", "i2"], "left").select(
        "i1", "i2", "u1", "u2", F.col("least").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) - F.col("upto") + F.col("x")).alias("saved_tokens"),
    )
    rows = store(rows, "trie-rows")
    # the root: one row, from a few sums
    whole = ends.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    n_children = kids.filter("i1 = 0 AND i2 = 0").agg(F.coalesce(F.max("kids"), F.lit(0)).alias("kids")).first().kids
    saved, leaves = tails.agg(F.coalesce(F.sum("saved"), F.lit(0)), F.coalesce(F.sum("leaves"), F.lit(0))).first()
    long = lambda value: F.lit(value).cast("bigint")
    root = whole.select(
        long(0).alias("i1"), long(0).alias("i2"), long(None).alias("u1"), long(None).alias("u2"), "conv_id", long(0).alias("depth"), "n_convs",
        long(n_children).alias("n_children"), long(leaves if n_children else 1).alias("n_leaves"), long(saved).alias("saved_tokens"),
    )
    root = store(root, "trie-root")
    every = rows.unionByName(root)
    names = every.select(F.col("i1").alias("u1"), F.col("i2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    parted = hot_join(rows, names, ["u1", "u2"]).unionByName(root.withColumn("parent_conv_id", long(None)))
    hashed = _hashed_ends(ends).select(F.col("p1").alias("i1"), F.col("p2").alias("i2"), "ends_sha256")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return parted.join(hashed, ["i1", "i2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """The prefix trie of a table ``(conv_id, turn, role, text)``, of its conversations as they are or rebuilt."""
    turns = store(numbered_turns(conversations), "trie-numbered")
    if rebuild:
        return prefix_trie(*rebuilt(turns))
    return prefix_trie(turns.withColumnRenamed("pos", "depth"), turns.select("conv_id").distinct())
