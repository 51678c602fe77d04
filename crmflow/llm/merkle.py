"""Merkle manifest of a table: proofs for every row by a butterfly exchange of subtree roots.

A row is a leaf; the leaves of a group (null is one), in order of a column, are hashed in runs
of ``FANOUT`` up to the subroot of the group, and the subroots in order of the groups, null
first, up to the root. While more than one node is left, every run becomes the hash of its
concatenated hex digests, the last run too, even if it holds one node.

Leaves are cut in aligned blocks of ``FANOUT ** BLOCK_LEVELS``, each hashed by one task call.
Then blocks exchange roots: in round r, the up to eight blocks that differ in digit r of
their number only (base eight) meet, and each of them hashes their parent, which it needs in
the next round. Every block so hashes all its ancestors itself and gathers the siblings on
its path; nothing is sent down again and no meeting has more than eight members. Where the
last subtree has fewer blocks than the others, its blocks stand in for the missing ones. The
groups go on in the same way: block b of a group meets block b of the seven others, and groups
of fewer blocks stand in again. Numbers of rounds are logarithms of the numbers of blocks and
groups.

Rows of one group and order value are taken in order of their leaf digests; equal rows are
interchangeable. Null order values come first. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.ordering import global_positions
from crmflow.storage import materialize

FANOUT = 8
#: A block holds FANOUT to this power of leaves.
BLOCK_LEVELS = 3


def field(column: Column) -> Column:
    """A value with its number of UTF-8 bytes before it; null is a dash."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def height(count: int, fanout: int) -> int:
    """Levels above ``count`` nodes until one is left."""
    levels = 0
    while count > 1:
        count, levels = -(-count // fanout), levels + 1
    return levels


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(digests: list[str], count: int, fanout: int) -> list[list[str]]:
    """The nodes of a subtree, level by level, ``count`` levels above its leaves."""
    found = [digests]
    for _ in range(count):
        below = found[-1]
        found.append([_digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return found


def _placed(leaves: DataFrame, fanout: int, block_size: int) -> DataFrame:
    """Leaves with the number of their group, the group's size, and their block and place in it."""
    rows = global_positions(leaves, ["group", "order", "leaf"])
    # A group lies in consecutive range parts: a row per part and group carries its start.
    parts = rows.groupBy("_part", "group").agg(
        F.min("_position").alias("low"), F.count(F.lit(1)).alias("rows")
    )
    parts = materialize(parts, "merkle-parts")
    groups = parts.groupBy("group").agg(F.min("low").alias("start"), F.sum("rows").alias("size"))
    numbers = global_positions(groups, ["group"], distinct=True)
    numbers = numbers.select(
        F.col("group").alias("named"), "start", "size", (F.col("_position") - 1).alias("tree")
    )
    known = parts.join(numbers, F.col("group").eqNullSafe(F.col("named")))
    known = known.select(F.col("_part").alias("of"), "named", "start", "size", "tree")
    same = (F.col("_part") == F.col("of")) & F.col("group").eqNullSafe(F.col("named"))
    place = F.col("_position") - F.col("start")
    return rows.join(known, same).select(
        "tree",
        "size",
        F.expr(f"(_position - start) div {block_size}").alias("block"),
        F.pmod(place, F.lit(block_size)).alias("place"),
        "order",
        "leaf",
        "presented",
    )


def _block_roots(placed: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """Per block: tree, block, blocks of the tree, and the digest of the block's subtree."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        size = table.column("size")[0].as_py()
        levels = min(block_levels, height(size, fanout))
        root = _levels(table.column("leaf").to_pylist(), levels, fanout)[-1][0]
        blocks = -(-size // fanout**block_levels)
        first = table.slice(0, 1)
        return pa.table(
            {
                "tree": first.column("tree"), "block": first.column("block"),
                "blocks": pa.array([blocks], pa.int64()), "digest": pa.array([root]),
            }
        )

    chosen = placed.select("tree", "block", "size", "place", "leaf")
    roots = chosen.groupBy("tree", "block").applyInArrow(run, "tree bigint, block bigint, blocks bigint, digest string")
    empty = F.array().cast("array<struct<before:string,after:string>>")
    return roots.withColumn("proof", empty)


def _digit(index: Column, width: int, fanout: int) -> Column:
    return F.pmod(F.floor(index / F.lit(width)).cast("bigint"), F.lit(fanout))


def _stand_ins(index: Column, count: Column, width: int, fanout: int) -> Column:
    """The indexes that a node's member speaks for in a round: its own, then missing ones.

    Nodes are runs of ``width`` members. The last run may have fewer; its members then take
    the places of the missing ones in turn, unless the run meets no other.
    """
    first = F.floor((count - 1) / F.lit(width)).cast("bigint") * width
    held = count - first
    short = (index >= first) & (held < width) & (_digit(index, width, fanout) > 0)
    more = index + held < first + width
    own = F.array(index)
    return F.when(short & more, F.sequence(index, first + F.lit(width - 1), held)).otherwise(own)


def _swap(messages: DataFrame, keys: list[str]) -> DataFrame:
    """Members with the digest of their parent, and the siblings met added to their proof.

    Rows of ``messages``: keys of the meeting, digit, digest, and ``member`` (null for stand-ins).
    A meeting has one row per digit.
    """
    met = messages.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("digit", "digest", "member"))).alias("nodes")
    )
    digests = F.transform("nodes", lambda n: n["digest"])
    met = met.select(
        F.col("nodes"), digests.alias("digests"), F.posexplode("nodes").alias("at", "node")
    ).filter("node.member IS NOT NULL")
    before = F.array_join(F.slice("digests", F.lit(1), F.col("at")), "")
    after = F.array_join(F.slice("digests", F.col("at") + 2, F.size("digests")), "")
    member = "node.member"
    return met.select(
        f"{member}.*",
        F.sha2(F.array_join("digests", ""), 256).alias("digest"),
        F.struct(before.alias("before"), after.alias("after")).alias("step"),
    )


def _block_round(state: DataFrame, width: int, fanout: int) -> DataFrame:
    """One round inside the groups; trees of one node by now stay as they are."""
    open_ = F.col("blocks") > width
    index = F.col("seat")
    member = F.struct("tree", "block", "blocks", "proof")
    messages = (
        state.filter(open_)
        .withColumn("seat", F.explode(_stand_ins(F.col("block"), F.col("blocks"), width, fanout)))
        .select(
            "tree",
            (index - _digit(index, width, fanout) * width).alias("meeting"),
            _digit(index, width, fanout).alias("digit"),
            "digest",
            F.when(index == F.col("block"), member).alias("member"),
        )
    )
    return _advanced(messages, ["tree", "meeting"], state).unionByName(state.filter(~open_))


def _advanced(messages: DataFrame, keys: list[str], state: DataFrame) -> DataFrame:
    grown = _swap(messages, keys).withColumn("proof", F.concat("proof", F.array("step")))
    return grown.select(*state.columns)


def _group_round(state: DataFrame, sizes: DataFrame, trees: int, width: int, fanout: int) -> DataFrame:
    """One round across groups: block b of each group meets block b of up to seven others."""
    index, count = F.col("seat"), F.lit(trees).cast("bigint")
    seats = sizes.withColumn("seat", F.explode(_stand_ins(F.col("tree"), count, width, fanout)))
    meeting = index - _digit(index, width, fanout) * width
    seats = seats.withColumn("meeting", meeting)
    # As many meetings side by side as the largest group in them has blocks.
    lanes = (
        seats.filter(index == F.col("tree")).groupBy("meeting").agg(F.max("copies").alias("lanes"))
    )
    seats = seats.join(lanes, "meeting").select("tree", "seat", "meeting", "lanes")
    member = F.struct("tree", "block", "blocks", "proof", "subroot")
    own = index == F.col("tree")
    lanes = F.sequence(F.col("block"), F.col("lanes") - 1, F.col("blocks"))
    lane = F.explode(F.when(F.col("block") < F.col("lanes"), lanes))
    messages = (
        state.join(seats, "tree")
        .withColumn("lane", lane)
        .select(
            "meeting",
            "lane",
            _digit(index, width, fanout).alias("digit"),
            "digest",
            F.when(own & (F.col("lane") == F.col("block")), member).alias("member"),
        )
    )
    return _advanced(messages, ["meeting", "lane"], state)


def upper_proofs(roots: DataFrame, fanout: int) -> DataFrame:
    """Per block: the proof above it, the subroot of its group and the root."""
    sizes = materialize(roots.groupBy("tree").agg(F.max("blocks").alias("copies")), "merkle-groups")
    most, trees = sizes.agg(F.max("copies"), F.count(F.lit(1))).first()
    state, width = roots, 1
    while most is not None and width < most:
        state = materialize(_block_round(state, width, fanout), "merkle-round")
        width *= fanout
    state, width = state.withColumn("subroot", F.col("digest")), 1
    while width < trees:
        state = materialize(_group_round(state, sizes, trees, width, fanout), "merkle-round")
        width *= fanout
    return state.select("tree", "block", "proof", "subroot", F.col("digest").alias("root"))


def _folder(fanout: int, block_levels: int):
    """Folds each presented leaf of a block with its siblings, up to the root."""

    def run(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("place")
        size, own = leaves.column("size")[0].as_py(), leaves.column("leaf").to_pylist()
        levels = _levels(own, min(block_levels, height(size, fanout)), fanout)[:-1]
        above = upper.column("proof")[0].as_py()
        above_text = "".join(step["before"] + step["after"] for step in above).encode()
        proofs, folded = [], []
        for place, digest in enumerate(leaves.column("presented").to_pylist()):
            siblings = hashlib.sha256()
            for nodes in levels:
                start = place - place % fanout
                before = "".join(nodes[start:place])
                after = "".join(nodes[place + 1 : start + fanout])
                siblings.update((before + after).encode())
                digest = _digest(before + digest + after)
                place //= fanout
            siblings.update(above_text)
            for step in above:
                digest = _digest(step["before"] + digest + step["after"])
            proofs.append(siblings.hexdigest())
            folded.append(digest)
        root, subroot = upper.column("root")[0].as_py(), upper.column("subroot")[0].as_py()
        rows = len(own)
        return pa.table(
            {
                "order": leaves.column("order"),
                "leaf": pa.array(own),
                "subroot": pa.array([subroot] * rows),
                "root": pa.array([root] * rows),
                "proof_sha256": pa.array(proofs),
                "folded_root": pa.array(folded),
                "verified": pa.array([f == root for f in folded]),
            }
        )

    return run


def manifest(
    docs: DataFrame,
    leaf: Column,
    presented: Column | None = None,
    group_column: str = "lang",
    order_column: str = "doc_id",
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: the order column, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``leaf`` is the digest of a row (``leaf_digest``); ``presented`` the digest that is folded
    with the row's siblings in its stead, to see whether it still leads to the root. The proof
    is hashed as the siblings of each level, from the leaf up, left to right. An empty table
    has no rows.
    """
    leaves = materialize(
        docs.select(
            docs[group_column].cast("string").alias("group"),
            docs[order_column].alias("order"),
            leaf.alias("leaf"),
            (leaf if presented is None else presented).alias("presented"),
        ),
        "merkle-leaves",
    )
    placed = materialize(_placed(leaves, fanout, fanout**block_levels), "merkle-placed")
    roots = materialize(_block_roots(placed, fanout, block_levels), "merkle-roots")
    upper = materialize(upper_proofs(roots, fanout), "merkle-upper")
    kind = leaves.schema["order"].dataType
    keys = ["tree", "block"]
    found = (
        placed.groupBy(*keys)
        .cogroup(upper.groupBy(*keys))
        .applyInArrow(
            _folder(fanout, block_levels),
            f"`order` {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean",
        )
    )
    return found.withColumnRenamed("order", order_column)
