"""Conversation prefix trie: shared openings of conversations, by an Euler tour.

Turns are ordered by ``turn`` (NULL first, ties by role, then text); a NULL role
or text is ''. Rows with a NULL ``conv_id`` belong to no conversation. Every
conv_id ``c`` is rebuilt from the first ``h`` turns of conversation
``c - c % 100`` (all if fewer, none if it is absent), followed by its own turns
after its first ``h``; ``h = crc32(decimal c) % 6``. Each distinct sequence of the
first ``d`` rebuilt turns (role, text) is a node of depth ``d``; the root is the
empty sequence. A rebuilt conversation that starts with a node's sequence is a
member of it (the root holds every conversation, even turnless ones).

Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL for
the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in its
subtree, itself included), ``saved_tokens`` (over its subtree, each node's
``(n_convs - 1) *`` code points of its last text) and ``ends_sha256`` (SHA-256 of
the ascending, comma-joined ids of the members that end there; '' if none).

How it runs: rebuilt turns come from a join of each conversation with its base
(at most five turns of it); a conversation's turns are chained into 128-bit node
keys (BLAKE2b of the parent's key, role and text). Nodes and counts are grouped
aggregates. For the subtree sums, each node gets an enter and an exit arc; the
arcs' successors follow first child, next sibling and parent, where siblings are
chained within hash buckets whose number grows with the parent's children, so
no parent's children meet in one task. The tour is list-ranked by pointer
jumping, carrying the sums of leaf marks and savings; each round is stored.
A node's subtree sum is the difference of the suffix sums at its two arcs.
The member ids that end at a node are hashed in id order by one task per node,
streamed in batches, so memory stays bounded while time follows the node.

Defined results: repeated rows are repeated turns; a conversation that holds no
turn of its own is still rebuilt (from its base) and is a member of the root;
an empty table gives the root alone only if a conv_id exists, else no rows.
Extra input columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.components import stored

HEAD = 6  # h = crc32 % HEAD
SPLIT = 10_000  # children of one parent chained in one bucket, about
_EMPTY = hashlib.sha256(b"").hexdigest()


def rebuilt(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, pos, role, text)`` of every rebuilt conversation, and ``(conv_id, n_turns)``."""
    turns = convs.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = turns.withColumn("j", F.row_number().over(order) - 1).drop("turn")
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
        F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEAD)).alias("h"),
    )
    lengths = ids.select(F.col("conv_id").alias("base"), F.col("own").alias("base_len"))
    ids = ids.join(lengths, "base", "left").withColumn(
        "m", F.least(F.col("h"), F.coalesce(F.col("base_len"), F.lit(0)))
    )
    head = turns.where(F.col("j") < HEAD - 1).select(F.col("conv_id").alias("base"), "j", "role", "text")
    prefix = ids.join(head, "base").where(F.col("j") < F.col("h")).select(
        "conv_id", F.col("j").alias("pos"), "role", "text"
    )
    own = turns.join(ids.select("conv_id", "h", "m"), "conv_id").where(F.col("j") >= F.col("h")).select(
        "conv_id", (F.col("m") + F.col("j") - F.col("h")).alias("pos"), "role", "text"
    )
    sizes = ids.select("conv_id", (F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return prefix.unionByName(own), sizes


def _digest(parent: bytes, role: str, text: str) -> bytes:
    r, t = role.encode(), text.encode()
    return hashlib.blake2b(
        parent + len(r).to_bytes(8, "little") + r + len(t).to_bytes(8, "little") + t, digest_size=16
    ).digest()


_MEMBERS = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, last_len long, n_turns long"


def _chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per conversation, one row per depth with the node's key and its parent's."""
    for frame in frames:
        out = {name: [] for name in ("conv_id", "depth", "k1", "k2", "p1", "p2", "last_len", "n_turns")}
        for conv, turns in zip(frame["conv_id"], frame["turns"]):
            turns = list(turns) if turns is not None else []
            key, parent = bytes(16), None
            for d in range(len(turns) + 1):
                if d:
                    role, text = turns[d - 1]["role"], turns[d - 1]["text"]
                    parent, key = key, _digest(key, role, text)
                out["conv_id"].append(conv)
                out["depth"].append(d)
                out["k1"].append(int.from_bytes(key[:8], "little", signed=True))
                out["k2"].append(int.from_bytes(key[8:], "little", signed=True))
                out["p1"].append(None if parent is None else int.from_bytes(parent[:8], "little", signed=True))
                out["p2"].append(None if parent is None else int.from_bytes(parent[8:], "little", signed=True))
                out["last_len"].append(len(turns[d - 1]["text"]) if d else 0)
                out["n_turns"].append(len(turns))
        yield pd.DataFrame({k: pd.array(v, dtype="Int64") for k, v in out.items()})


def _ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the comma-joined ids per key; rows come sorted by key, then id."""
    key, hasher, first = None, None, True
    done = {"k1": [], "k2": [], "ends_sha256": []}
    for frame in frames:
        for k1, k2, conv in zip(frame["k1"], frame["k2"], frame["conv_id"]):
            if (k1, k2) != key:
                if key is not None:
                    done["k1"].append(key[0]); done["k2"].append(key[1]); done["ends_sha256"].append(hasher.hexdigest())  # noqa: E702
                key, hasher, first = (k1, k2), hashlib.sha256(), True
            hasher.update((b"" if first else b",") + str(int(conv)).encode())
            first = False
        if len(done["k1"]) >= 10_000:
            yield pd.DataFrame(done)
            done = {"k1": [], "k2": [], "ends_sha256": []}
    if key is not None:
        done["k1"].append(key[0]); done["k2"].append(key[1]); done["ends_sha256"].append(hasher.hexdigest())  # noqa: E702
    yield pd.DataFrame(done, columns=["k1", "k2", "ends_sha256"])


def members(convs: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth: the node it passes there."""
    turns, sizes = rebuilt(convs)
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    joined = sizes.select("conv_id").join(lists, "conv_id", "left")
    return joined.mapInPandas(_chain, _MEMBERS)


def _siblings(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(k1, k2, s1, s2)`` next sibling of each child, and ``(p1, p2, f1, f2)`` first child of each parent.

    Siblings are ordered by smallest member; a parent's children are chained in
    ``ceil(n / SPLIT)`` hash buckets, then the buckets in order.
    """
    kids = nodes.where(F.col("p1").isNotNull()).select("k1", "k2", "p1", "p2", "conv_id", "n_children_of_parent")
    kids = kids.withColumn("bucket", F.pmod(
        F.xxhash64("k1", "k2"), F.ceil(F.col("n_children_of_parent") / SPLIT).cast("long")
    ))
    in_bucket = Window.partitionBy("p1", "p2", "bucket").orderBy("conv_id")
    chained = kids.select(
        "k1", "k2", "p1", "p2", "bucket",
        F.lead("k1").over(in_bucket).alias("s1"), F.lead("k2").over(in_bucket).alias("s2"),
    )
    ends = kids.groupBy("p1", "p2", "bucket").agg(
        F.min_by(F.struct("k1", "k2"), "conv_id").alias("first"),
        F.max_by(F.struct("k1", "k2"), "conv_id").alias("last"),
    )
    by_bucket = Window.partitionBy("p1", "p2").orderBy("bucket")
    ends = ends.select(
        "p1", "p2", "first", "last", F.lead("first").over(by_bucket).alias("following"),
        (F.row_number().over(by_bucket) == 1).alias("is_first"),
    )
    bridge = ends.select(F.col("last.k1").alias("k1"), F.col("last.k2").alias("k2"), "following")
    nexts = chained.join(bridge, ["k1", "k2"], "left").select(
        "k1", "k2",
        F.coalesce(F.col("s1"), F.col("following.k1")).alias("s1"),
        F.coalesce(F.col("s2"), F.col("following.k2")).alias("s2"),
    )
    firsts = ends.where("is_first").select("p1", "p2", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"))
    return nexts, firsts


def rank_tour(arcs: DataFrame) -> DataFrame:
    """Suffix sums of ``leaf`` and ``save`` along the list ``(a1, a2, ak) -> (n1, n2, nk)``, by pointer jumping."""
    key = ["a1", "a2", "ak"]
    arcs = stored(arcs.select(*key, "n1", "n2", "nk", "leaf", "save"), "tour")
    while arcs.where(F.col("n1").isNotNull()).limit(1).count():
        ahead = arcs.select(
            F.col("a1").alias("n1"), F.col("a2").alias("n2"), F.col("ak").alias("nk"),
            F.col("n1").alias("m1"), F.col("n2").alias("m2"), F.col("nk").alias("mk"),
            F.col("leaf").alias("leaf2"), F.col("save").alias("save2"),
        )
        jumped = arcs.join(ahead, ["n1", "n2", "nk"], "left").select(
            *key, F.col("m1").alias("n1"), F.col("m2").alias("n2"), F.col("mk").alias("nk"),
            (F.col("leaf") + F.coalesce(F.col("leaf2"), F.lit(0))).alias("leaf"),
            (F.col("save") + F.coalesce(F.col("save2"), F.lit(0))).alias("save"),
        )
        arcs = stored(jumped, "tour")
    return arcs.select(*key, "leaf", "save")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node; see the module's notes."""
    passes = stored(members(convs), "members")
    nodes = passes.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("last_len").alias("last_len"),
    )
    children = nodes.where(F.col("p1").isNotNull()).groupBy(
        F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, ["k1", "k2"], "left").withColumn(
        "n_children", F.coalesce(F.col("n_children"), F.lit(0))
    ), "nodes")
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("n_children").alias("n_children_of_parent"),
                           F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["p1", "p2"], "left")
    nexts, firsts = _siblings(nodes)
    linked = nodes.join(nexts, ["k1", "k2"], "left").join(
        firsts.withColumnRenamed("p1", "k1").withColumnRenamed("p2", "k2"), ["k1", "k2"], "left"
    )
    enter = linked.select(
        F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.lit(0).alias("ak"),
        F.coalesce("f1", "k1").alias("n1"), F.coalesce("f2", "k2").alias("n2"),
        F.when(F.col("f1").isNull(), 1).otherwise(0).alias("nk"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("last_len")).alias("save"),
    )
    leave = linked.select(
        F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.lit(1).alias("ak"),
        F.coalesce("s1", "p1").alias("n1"), F.coalesce("s2", "p2").alias("n2"),
        F.when(F.col("s1").isNull() & F.col("p1").isNull(), None)
        .when(F.col("s1").isNull(), 1).otherwise(0).alias("nk"),
        F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("save"),
    )
    ranked = rank_tour(enter.unionByName(leave))
    at_enter = ranked.where("ak = 0").select(F.col("a1").alias("k1"), F.col("a2").alias("k2"),
                                             F.col("leaf").alias("leaf_in"), F.col("save").alias("save_in"))
    at_exit = ranked.where("ak = 1").select(F.col("a1").alias("k1"), F.col("a2").alias("k2"),
                                            F.col("leaf").alias("leaf_out"), F.col("save").alias("save_out"))
    ends = passes.where(F.col("depth") == F.col("n_turns")).select("k1", "k2", "conv_id") \
        .repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id") \
        .mapInPandas(_ends, "k1 long, k2 long, ends_sha256 string")
    return nodes.join(at_enter, ["k1", "k2"]).join(at_exit, ["k1", "k2"]).join(ends, ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf_in") - F.col("leaf_out")).alias("n_leaves"),
        (F.col("save_in") - F.col("save_out")).alias("saved_tokens"),
        F.coalesce(F.col("ends_sha256"), F.lit(_EMPTY)).alias("ends_sha256"),
    )
