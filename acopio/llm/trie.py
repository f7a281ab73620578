"""Prefix trie of conversations, found by depth-first intersection of vertical bitmaps.

Turns are indexed by (position, turn): each posting is the bitset of the conversations of a
shard that have this turn at this place. A node's children are the intersections of its own
bitset with the postings of the next position, its members a popcount. Shards hold a bounded
number of conversations and a bounded range of positions, so a task holds bitsets of one
shard only, however many conversations share a prefix and however long one of them is.

Shards know a node by its path: the exclusive or of the postings on the way, each a 120-bit
digest of (position, role, text). Merging the shards by path gives the whole trie.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acopio.session import stage

#: Conversations of a shard, and positions of a shard's part: what one task holds at most.
CONVERSATIONS, POSITIONS = 1024, 256

_NODE = (
    "shard long, a long, b long, up_a long, up_b long, depth long, tokens long, way long, "
    "conv_id long, n_convs long, members array<long>, ends array<long>"
)


_PLACED = ("part", "depth", "tokens", "a", "b", "in_a", "in_b", "in_way")


def turn_digest(role: Column, text: Column) -> Column:
    """Name of a turn: equal for the same role and text only. Nulls are empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def postings(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, tokens, a, b) of turns (conv_id, depth, tokens, digest): (a, b) names the turn at its place."""
    placed = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest").cast("binary"), 256)
    half = lambda first: F.conv(F.substring(placed, first, 15), 16, 10).cast("long")
    return turns.select("conv_id", "depth", "tokens", half(1).alias("a"), half(16).alias("b"))


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, shard, local) with ids in ascending order over the shards and within each."""
    sorted_ids = stage(conversations.select("conv_id").orderBy("conv_id").select("conv_id", F.monotonically_increasing_id().alias("at")), "trie-ids")
    # ids are dense within a written range, whose number is in the upper bits
    return sorted_ids.select(
        "conv_id", F.expr(f"at div {CONVERSATIONS}").alias("shard"), (F.col("at") % CONVERSATIONS).cast("int").alias("local")
    )


def _parts(rows: DataFrame) -> DataFrame:
    """Turns with the part of the shard they belong to, and the path that leads to their part.

    A conversation is cut every ``POSITIONS`` turns; the path to a part is worked out from sums
    per part, so a very long conversation is never in one task.
    """
    rows = rows.withColumn("part", F.expr(f"(depth - 1) div {POSITIONS}"))
    own = rows.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("tokens").alias("tokens"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    entry = own.select(
        "conv_id", "part", F.coalesce(F.bit_xor("a").over(before), F.lit(0)).alias("in_a"), F.coalesce(F.bit_xor("b").over(before), F.lit(0)).alias("in_b"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("in_way"),
    )
    return rows.join(entry, ["conv_id", "part"])


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """All nodes of a part of a shard, from its postings; the root of the trie belongs to the first part."""
    shard, first = int(group["shard"].iloc[0]), int(group["part"].iloc[0]) * POSITIONS
    ids: dict[int, int] = {}
    lengths: dict[int, int] = {}
    index: dict[tuple, int] = defaultdict(int)
    turn_at: dict[tuple[int, int], tuple] = {}
    starts: dict[tuple, int] = defaultdict(int)
    for row in group.itertuples(index=False):
        bit = 1 << row.local
        ids[row.local], lengths[row.local] = row.conv_id, row.length
        if row.depth <= first + 1:
            starts[row.in_a, row.in_b, row.in_way] |= bit
        if row.depth:
            posting = (row.depth, row.a, row.b)
            index[posting] |= bit
            turn_at[row.local, row.depth] = (posting, row.tokens)
    nodes: list[tuple] = []

    def add(bits: int, depth: int, path: tuple[int, int], up: tuple[int, int], tokens: int, way: int) -> None:
        members = []
        while bits:
            low = bits & -bits
            members.append(low.bit_length() - 1)
            bits ^= low
        own = [ids[m] for m in members]
        nodes.append((shard, *path, *up, depth, tokens, way, own[0], len(own), own, [ids[m] for m in members if lengths[m] == depth]))

    pending = [(bits, first, (a, b), way) for (a, b, way), bits in starts.items()]
    if first == 0:
        add(pending[0][0], 0, (0, 0), (0, 0), 0, 0)
    while pending:
        bits, depth, path, way = pending.pop()
        if depth == first + POSITIONS:
            continue
        # the first conversation left names the next child, whose members leave the parent's bitset together
        while bits:
            low = bits & -bits
            found = turn_at.get((low.bit_length() - 1, depth + 1))
            if found is None:
                bits ^= low
                continue
            posting, tokens = found
            child = bits & index[posting]
            bits ^= child
            below = (path[0] ^ posting[1], path[1] ^ posting[2])
            add(child, depth + 1, below, path, tokens, way + tokens)
            pending.append((child, depth + 1, below, way + tokens))
    return pd.DataFrame(nodes, columns=[f.split()[0] for f in _NODE.split(", ")])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of the ids of each node; the rows of a node come one after the other, its ids ascending."""
    current, digest = None, None
    for batch in batches:
        done = []
        for a, b, ids in zip(batch["a"], batch["b"], batch["ends"]):
            if (a, b) != current:
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = (a, b), hashlib.sha256()
                digest.update(",".join(map(str, ids)).encode())
            else:
                digest.update(("," + ",".join(map(str, ids))).encode())
        yield pd.DataFrame(done, columns=["a", "b", "ends_sha256"])
    if current is not None:
        yield pd.DataFrame([(*current, digest.hexdigest())], columns=["a", "b", "ends_sha256"])


def prefix_trie(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """Every distinct prefix of turns, from conversations (conv_id) and turns (conv_id, depth, tokens, digest).

    Conversations have distinct ids; depths of a conversation run from 1 without gaps, and
    turns of the same digest have the same tokens. Conversations without turns are members of
    the root. Returns per node: conv_id (its smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves (childless nodes of its subtree, itself included),
    saved_tokens (over its subtree, each node's members but one times its last turn's tokens) and
    ends_sha256 (of the ids that end here, ascending, comma-joined). Rows without a conv_id,
    and turns of conversations not named, are left out; without conversations there are no nodes.

    Subtree sums need no walk over the tree. A conversation is the smallest member of all nodes
    from some depth on; before it, it repeats what a smaller one said. What a subtree saves is
    what its members repeat from there on, which are sums over members: one weighted popcount.
    """
    named = stage(_numbered(conversations.where("conv_id IS NOT NULL").distinct()), "trie-shards")
    placed = stage(_parts(postings(turns)), "trie-postings")
    length = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"), F.sum("tokens").alias("whole"))
    sized = stage(named.join(length, "conv_id", "left").na.fill(0, ["length", "whole"]), "trie-lengths")
    silent = sized.where("length = 0").select("conv_id", "shard", "local", "length", *(F.lit(0).cast("long").alias(c) for c in _PLACED))
    rows = sized.drop("whole").join(placed, "conv_id").select("conv_id", "shard", "local", "length", *_PLACED).unionByName(silent)
    found = stage(rows.groupBy("shard", "part").applyInPandas(_walk, _NODE), "trie-found")

    path = ["a", "b"]
    same = [F.first(c).alias(c) for c in ("up_a", "up_b", "depth", "tokens", "way")]
    merged = stage(found.groupBy(*path).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *same), "trie-merged")
    below = merged.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(merged.join(below, path, "left").na.fill(0, ["n_children"]), "trie-nodes")

    # what a conversation says until it stops repeating others, and whether it owns a leaf
    owned = nodes.groupBy("conv_id").agg(
        F.min_by(F.col("way") - F.col("tokens"), "depth").alias("repeats"), F.max((F.col("n_children") == 0).cast("long")).alias("leaves")
    )
    weights = sized.join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("repeats", "whole").alias("repeats"), F.coalesce("leaves", F.lit(0)).alias("leaves")
    )
    shared = nodes.where("n_convs > 1")
    inside = found.join(shared.select(*path), path, "left_semi").select(*path, F.explode("members").alias("conv_id"))
    summed = inside.join(weights, "conv_id").groupBy(*path).agg(F.sum("repeats").alias("repeats"), F.sum("leaves").alias("n_leaves"))
    saved = F.col("repeats") - F.col("own") - (F.col("n_convs") - 1) * (F.col("way") - F.col("tokens"))
    own = weights.select("conv_id", F.col("repeats").alias("own"))
    sums = shared.join(summed, path).join(own, "conv_id").select(*path, saved.alias("saved_tokens"), "n_leaves")

    ended = found.where(F.size("ends") > 0).select("shard", *path, "ends")
    in_order = ended.repartition(*path).sortWithinPartitions(*path, "shard").select(*path, "ends")
    hashes = in_order.mapInPandas(_digests, "a long, b long, ends_sha256 string")

    parents = nodes.where("n_children > 0").select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent"))
    whole = nodes.join(sums, path, "left").join(hashes, path, "left").join(parents, ["up_a", "up_b"], "left")
    return whole.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
