"""Merkle manifest of a dataset: a tree for each group of rows, a tree over their roots, and every row's proof.

Leaves ascend within their group; while a level has more than one node, every ``fanout`` consecutive
nodes become one, whose digest is the SHA-256 of theirs, concatenated as hex text. The roots of the
groups, in order of the groups, are the leaves of a last tree.

Method: butterfly exchange. A *partition* is ``fanout ** depth`` aligned leaves of a group; its task
hashes its own subtree. From there on every partition keeps the digest of its present ancestor and
its proof so far. In round r the partitions under one node at level r all know that node's digest; one
partition of each of up to ``fanout`` sibling nodes, those at the same place below their node, meet
and swap digests. Each then hashes the parent by itself and adds the siblings to its proof, so that the
work on ancestors is done redundantly, every exchange has ``fanout`` members at most, and after the
last round every partition has the root and its whole upper proof; nothing is sent down again.
Where the last node of a level has fewer partitions than its siblings, its partitions stand in for
those that are missing: each is copied ``fanout - 1`` times at most in a round, and there are never
more of these stand-ins than ``fanout`` times the partitions. Then each partition's rows meet its proof and
get the lower part of theirs. Rounds grow with the logarithm of the largest group, and no group, however
large, lies in one task: ranges number its rows, and partitions are dealt one by one.

``verify`` recomputes a root from a leaf and its proof with built-in functions.

Cases: a null group is one like others and comes first; other groups ascend by their text, bytewise. Null keys
come first. Rows that repeat a key ascend by their digest; rows alike in both are interchangeable. A lone leaf
is its group's root. An empty table has no rows. The caller's columns pass through in the order given; those named
like the added ones are replaced. A null leaf fails.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import dense_position
from ..session import settle
from .common import columns_of, prepare, row_of

FANOUT = 8
#: Levels that a partition hashes by itself.
DEPTH = 3

STEP = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("siblings", T.ArrayType(T.StringType()))])
PROOF = T.ArrayType(STEP)
_STEP = pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))])
ADDED = ("leaf", "position", "subroot", "root", "proof")


def leaf_digest(columns: Iterable[Column]) -> Column:
    """SHA-256 in hex of columns' values: each ``-`` if null, else its number of UTF-8 bytes, ``:`` and the value as text."""
    texts = [c.cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def proof_siblings(proof: Column) -> Column:
    """All digests of a proof in one text, level by level, left to right."""
    return F.array_join(F.flatten(F.transform(proof, lambda step: step["siblings"])), "")


def verify(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""

    def parent(digest: Column, step: Column) -> Column:
        left = F.array_join(F.slice(step["siblings"], F.lit(1), step["place"]), "")
        right = F.array_join(F.slice(step["siblings"], step["place"] + 1, F.size(step["siblings"])), "")
        return F.sha2(F.concat(left, digest, right), 256)

    return F.aggregate(proof, leaf, parent)


def levels_above(nodes: int, fanout: int = FANOUT) -> int:
    """How many levels lie above so many nodes."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def _parents(nodes: list[str], fanout: int) -> list[str]:
    return [sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]


def _subtree(table: pa.Table, fanout: int, depth: int) -> tuple[pa.Table, list[list[str]]]:
    """A partition's rows in order, and its nodes level by level, as far as both the partition and the tree go."""
    table = table.take(pc.sort_indices(table, [("_pos", "ascending")]))
    levels = [table["_digest"].to_pylist()]
    for _ in range(min(depth, levels_above(table["_n"][0].as_py(), fanout))):
        levels.append(_parents(levels[-1], fanout))
    return table, levels


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each row's place in its group, from 0, and the group's size. Rows alike in all else are told apart by their place as stored."""
    stored = settle(rows).withColumn("_tie", F.monotonically_increasing_id())
    placed = dense_position(stored, ["_group"], keys[0], [*keys[1:], "_digest", "_tie"], name="_pos", total="_n")
    return placed.select("_group", (F.col("_pos") - 1).alias("_pos"), "_n", "_digest", "_row")


def _div(column: str, by: int) -> Column:
    return F.expr(f"{column} div {by}L")


def _partition_roots(numbered: DataFrame, fanout: int, depth: int) -> DataFrame:
    """One row for each partition of leaves: the digest of its own subtree."""
    schema = "_group string, _part bigint, _n bigint, _digest string"

    def hashed(key: tuple, table: pa.Table) -> pa.Table:
        _, levels = _subtree(table, fanout, depth)
        return pa.table({"_group": [key[0].as_py()], "_part": [key[1].as_py()], "_n": [table["_n"][0].as_py()], "_digest": levels[-1]})

    narrow = numbered.select("_group", _div("_pos", fanout**depth).alias("_part"), "_pos", "_n", "_digest")
    return narrow.groupBy("_group", "_part").applyInArrow(hashed, schema)


def _exchanged(parts: DataFrame, rounds: int, fanout: int, depth: int) -> DataFrame:
    """The butterfly: every partition with the root of its tree as ``_digest`` and its proof above its own subtree as ``_path``."""
    parts = parts.withColumn("_path", F.array().cast(PROOF))
    for r in range(rounds):
        below = fanout**r  # partitions below a node of this level
        leaves = fanout**depth * below
        state = parts.select(
            "*",
            F.expr(f"(_n + {leaves - 1}L) div {leaves}L").alias("_nodes"),
            _div("_part", below).alias("_node"),
            F.expr(f"_part % {below}L").alias("_low"),
        )
        state = state.withColumn("_digit", F.expr(f"cast(_node % {fanout}L as int)"))
        meeting = Window.partitionBy("_group", _div("_node", fanout), "_low")
        real = F.when(F.col("_node") < F.col("_nodes"), F.struct("_digit", "_digest"))
        state = state.withColumn("_met", F.sort_array(F.collect_list(real).over(meeting)))
        others = F.filter("_met", lambda x: x["_digit"] != F.col("_digit"))
        step = F.struct(F.col("_digit").alias("place"), F.transform(others, lambda x: x["_digest"]).alias("siblings"))
        parent = F.sha2(F.array_join(F.transform("_met", lambda x: x["_digest"]), ""), 256)
        goes_on = F.col("_nodes") > 1
        # Stand-ins for the partitions that the last node of this level lacks, if its parent has siblings to meet.
        lacks = F.when((F.col("_nodes") > fanout) & (F.col("_node") == F.col("_nodes") - 1), fanout - 1 - F.col("_digit")).otherwise(0)
        parts = state.select(
            "_group",
            F.explode(F.transform(F.sequence(F.lit(0), lacks), lambda copy: F.col("_part") + copy * F.lit(below).cast("long"))).alias("_part"),
            "_n",
            F.when(goes_on, parent).otherwise(F.col("_digest")).alias("_digest"),
            F.when(goes_on, F.concat("_path", F.array(step))).otherwise(F.col("_path")).cast(PROOF).alias("_path"),
        )
    return parts.filter(F.expr(f"_part * {fanout**depth}L < _n"))


def _tree(rows: DataFrame, keys: list[str], fanout: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Numbered rows, and the partitions with their roots and upper proofs, of all groups' trees."""
    numbered = _numbered(rows, keys)
    roots = settle(_partition_roots(numbered, fanout, depth))
    largest = roots.agg(F.max("_n")).first()[0] or 0
    rounds = max(0, levels_above(largest, fanout) - depth)
    return numbered, settle(_exchanged(roots, rounds, fanout, depth))


def _proven(numbered: DataFrame, parts: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Every row with its partition's ``_subroot`` and ``_root`` and its whole proof."""
    row = numbered.schema["_row"]
    schema = T.StructType(
        [row, T.StructField("leaf", T.StringType()), T.StructField("position", T.LongType()), T.StructField("subroot", T.StringType()),
         T.StructField("root", T.StringType()), T.StructField("proof", PROOF)]
    )

    def proven(left: pa.Table, right: pa.Table) -> pa.Table:
        left, levels = _subtree(left, fanout, depth)
        upper = right["_path"][0].as_py()
        steps, chosen = [], [[] for _ in range(left.num_rows)]
        for level, nodes in enumerate(levels[:-1]):
            width = fanout**level
            for i in range(len(nodes)):
                run = i - i % fanout
                steps.append({"place": i % fanout, "siblings": nodes[run:i] + nodes[i + 1 : run + fanout]})
                for row in range(i * width, min((i + 1) * width, left.num_rows)):
                    chosen[row].append(len(steps) - 1)
        shared = list(range(len(steps), len(steps) + len(upper)))
        every = [x for own in chosen for x in (*own, *shared)]
        size = len(levels) - 1 + len(upper)
        taken = pa.array(steps + upper, _STEP).take(pa.array(every, pa.int32()))
        ends = pa.array(range(0, size * left.num_rows + 1, size) if size else [0] * (left.num_rows + 1), pa.int32())
        return pa.table({
            "_row": left["_row"], "leaf": left["_digest"], "position": left["_pos"],
            "subroot": pa.repeat(right["_subroot"][0], left.num_rows), "root": pa.repeat(right["_root"][0], left.num_rows),
            "proof": pa.ListArray.from_arrays(ends, taken),
        })

    left = numbered.withColumn("_part", _div("_pos", fanout**depth)).groupBy("_group", "_part")
    return left.cogroup(parts.groupBy("_group", "_part")).applyInArrow(proven, schema)


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """All rows with ``leaf``, their ``position`` in their group, its ``subroot``, the dataset's ``root`` and their ``proof``.

    ``leaf`` names the column with the rows' digests. The proof has a step for each level up to the root of all: the
    node's place in its run and the digests of the run's other nodes.
    """
    prepare(rows.sparkSession)
    kept = [c for c in rows.columns if c not in ADDED]
    # A text that is never null, in which the null group comes first.
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    keys = [f"_key{i}" for i in range(len(order))]
    leaves = rows.select(
        name.alias("_group"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys)],
        F.col(f"`{leaf}`").alias("_digest"),
        row_of(kept),
    )
    numbered, parts = _tree(leaves, keys, fanout, depth)
    subroots = parts.filter("_part = 0").select(F.lit("").alias("_group"), F.col("_group").alias("_key0"), "_digest", F.struct("_group").alias("_row"))
    groups, tops = _tree(subroots, ["_key0"], fanout, depth)
    tops = tops.select("_group", "_part", F.lit(None).cast("string").alias("_subroot"), F.col("_digest").alias("_root"), "_path")
    upper = settle(_proven(groups, tops, fanout, depth).select(F.col("_row._group").alias("_group"), "root", F.col("proof").alias("_upper")))
    parts = parts.join(upper, "_group").select(
        "_group", "_part", F.col("_digest").alias("_subroot"), F.col("root").alias("_root"), F.concat("_path", "_upper").alias("_path")
    )
    proven = _proven(numbered, parts, fanout, depth)
    return proven.select(*columns_of(kept), *ADDED)
