"""Exact top-k search by inner product with sorted lists and no random access.

Every coordinate of a block of candidates is a list sorted by value. A query reads all lists in step, each from the end
that adds most to its score, and keeps for each candidate a lower bound (what was read, and the far end of each
list not yet read) and an upper bound (what was read, and each other list's present value). Candidates whose
upper bound lies below the k-th lower bound cannot qualify, those not seen at all included. It stops reading when few
others remain, and resolves their final scores. Queries of a block read in step, so their bounds are products of
matrices, and each step adds only what it has newly read.

The same bounds, with nothing read, hold for a block as a whole: no score in it is above the sum of each weight times the
coordinate's highest or lowest value there. So lists are read in two rounds:

1. Candidates are dealt into blocks of like vectors once: by the nearest of ``PIVOTS`` pivots, which are fitted on a sample of at
   most ``SAMPLE`` vectors (they decide how tight the bounds are, never a result), and by hash within one. A block is stored as
   one row with its lists' ends; a table of the ends alone is small, a row of two vectors for ``CANDIDATES`` candidates.
2. Every query meets that table and is sent to the ``FIRST`` blocks with the highest bounds. The k-th score found there is its bar.
3. It is sent to the other blocks whose bound reaches its bar; most are never read. There the bar stops the reading as well.

Candidates are not copied: a block is one row that its queries come to, unless over ``ASKING`` of them do, when it is read by
several tasks. Equal vectors count as one with the k + 1 smallest of their ids, which is all that any query can need.

Scores are integers below 2 ** 53 in size, so sums of doubles are exact.

Cases: vectors that are null or empty, or hold null or non-finite components, take no part, nor do
rows without an id. Candidates with the query's id are left out. Only vectors of the same length are
compared. Ties go to the smaller id. Rows alike in id and vector count once; an id with several vectors is so many
candidates, and as a query it takes the best scores of all of them. Other columns are not carried. Fewer candidates than k give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .common import prepare

#: Candidates of a block; queries, and block ends, that meet in one group.
CANDIDATES, QUERIES, ENDS = 4096, 512, 1024
#: Pivots of the blocks, and the vectors that they are fitted on.
PIVOTS, SAMPLE = 64, 4096
#: Blocks that give the bar, and queries that one task brings to a block.
FIRST, ASKING = 2, 1 << 15
#: Shares of the lists that are read step by step, and the share of candidates that are few.
STEPS, FEW = (0.1, 0.25, 0.5, 0.75), 0.03


def integers(vector: Column, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down; null if one is null or not finite."""
    fine = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(fine & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Lists:
    """The sorted lists of a block, read to the same depth by all of its queries."""

    def __init__(self, vectors: np.ndarray, queries: np.ndarray):
        self.vectors, self.queries = vectors, queries
        order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, order, 0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(vectors))[:, None], 0)
        self.plus, self.minus = np.maximum(queries, 0), np.minimum(queries, 0)
        self.depth = 0
        # Of what was read: the scores, and what the same coordinates have at the far ends.
        self.read = np.zeros((len(vectors), len(queries)))
        self.far = np.zeros_like(self.read)

    def ends(self, at: int, other: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights times a position of each list from the top, and one from the bottom."""
        return self.plus * self.values[at], self.minus * self.values[other]

    def go_to(self, depth: int) -> None:
        """Read on to a depth: only the positions between are added."""
        n = len(self.vectors)
        top = (self.rank >= n - depth) & (self.rank < n - self.depth)
        bottom = (self.rank < depth) & (self.rank >= self.depth)
        self.read += np.concatenate([self.vectors * top, self.vectors * bottom], 1) @ np.concatenate([self.plus, self.minus], 1).T
        self.far += np.concatenate([top, bottom], 1) @ np.concatenate(self.ends(0, n - 1), 1).T
        self.depth = depth

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all candidates (rows) for all queries."""
        n, depth = len(self.vectors), self.depth
        far, near = np.concatenate(self.ends(0, n - 1), 1), np.concatenate(self.ends(n - max(depth, 1), max(depth, 1) - 1), 1)
        unread = np.concatenate([self.rank < n - depth, self.rank >= depth], 1)
        return self.read + far.sum(1) - self.far, self.read + unread @ near.T

    def drop(self, stay: np.ndarray) -> None:
        """Leave queries that are done."""
        self.queries, self.plus, self.minus = self.queries[stay], self.plus[stay], self.minus[stay]
        self.read, self.far = self.read[:, stay], self.far[:, stay]


def best_of_block(vectors: np.ndarray, own: np.ndarray, queries: np.ndarray, bars: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the candidates that may be among its k best, with their scores.

    ``own``: candidates that a query must not find, by rows; ``bars``: scores below which it needs none. All with
    the k-th score are there, as ties are settled by ids.
    """
    n = len(vectors)
    lists = Lists(vectors.astype(float), queries.astype(float))
    out: list = [None] * len(queries)
    waiting = np.arange(len(queries))
    for step in (*STEPS, 1.0):
        lists.go_to(max(lists.depth, int(n * step)))
        lower, upper = lists.bounds()
        lower[own[:, waiting]] = -np.inf
        bar = np.partition(lower, n - k, axis=0)[n - k] if n >= k else np.full(len(waiting), -np.inf)
        may = (upper >= np.maximum(bar, bars[waiting])) & ~own[:, waiting]
        done = (may.sum(0) <= max(4 * k, FEW * n)) | (step == 1.0)
        for at in np.flatnonzero(done):
            found = np.flatnonzero(may[:, at])
            scores = lists.vectors[found] @ lists.queries[at]  # what was not read of those that remain
            least = max(bars[waiting[at]], np.sort(scores)[-k] if len(scores) >= k else -np.inf)
            out[waiting[at]] = (found[scores >= least], scores[scores >= least].astype(np.int64))
        if done.all():
            break
        lists.drop(~done)
        waiting = waiting[~done]
    return out


def block_bounds(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """The most that a query (column) can score in a block (row)."""
    return high @ np.maximum(queries, 0).T + low @ np.minimum(queries, 0).T


def pivots(vectors: np.ndarray) -> np.ndarray:
    """Centres of a sample, by a few rounds of nearest means from evenly spread beginnings."""
    if not len(vectors):
        return vectors
    centres = vectors[np.linspace(0, len(vectors) - 1, min(PIVOTS, len(vectors))).astype(int)]
    for _ in range(5):
        near = nearest(vectors, centres)
        centres = np.array([vectors[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2 * vectors @ centres.T).argmin(1)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of vectors of one length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array(whole.to_pylist(), np.int64).reshape(len(whole), -1)


def _list(rows: np.ndarray) -> pa.Array:
    return pa.array(rows.tolist(), pa.list_(pa.int64()))


def stored_blocks(candidates: DataFrame) -> DataFrame:
    """size, block, n, ids (of each vector), vectors (one after the other), low and high (ends of the lists); stored. Of ids and vectors."""
    samples: dict[int, list] = {}
    chosen = candidates.select("size", "vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE)
    for row in chosen.collect():
        samples.setdefault(row["size"], []).append(row["vector"])
    centres = {size: pivots(np.array(v, float)) for size, v in samples.items()}
    sent = candidates.sparkSession.sparkContext.broadcast(centres)

    def dealt(batches):
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            pivot = np.zeros(len(sizes), np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if size in sent.value:
                    pivot[at] = nearest(_matrix(batch.column(2).take(pa.array(at))).astype(float), sent.value[size])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=["size", "ids", "vector", "pivot"])

    rows = candidates.select("size", "ids", "vector").mapInArrow(dealt, "size int, ids array<bigint>, vector array<bigint>, pivot int")
    rows = settle(rows)
    chunks = rows.groupBy("size", "pivot").agg(F.ceil(F.count("*") / CANDIDATES).cast("int").alias("chunks"))
    rows = rows.join(chunks, ["size", "pivot"]).withColumn("chunk", F.expr("cast(pmod(xxhash64(vector), chunks) as int)"))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        vectors = _matrix(table["vector"])
        return pa.table({
            "size": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py() << 32 | key[2].as_py()], pa.int64()),
            "ids": pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))), "vectors": _list(vectors.reshape(1, -1)),
            "low": _list(vectors.min(0)[None]), "high": _list(vectors.max(0)[None]),
        })

    schema = "size int, block bigint, ids array<array<bigint>>, vectors array<bigint>, low array<bigint>, high array<bigint>"
    return settle(rows.groupBy("size", "pivot", "chunk").applyInArrow(packed, schema))


def destinations(asked: DataFrame, blocks: DataFrame, first: bool) -> DataFrame:
    """query_id, vector, size, bar and the block that they go to: the ``FIRST`` with the highest bounds, or all others that reach the bar.

    Queries meet the ends of all blocks, in groups of ``QUERIES`` by ``ENDS``.
    """
    parts, many = (max(1, -(-n // by)) for n, by in ((asked.count(), QUERIES), (blocks.count(), ENDS)))
    left = asked.withColumn("q", F.expr(f"cast(pmod(xxhash64(query_id, vector), {parts}) as int)")).withColumn("e", F.explode(F.expr(f"sequence(0, {many - 1})")))
    right = blocks.select("size", "block", "low", "high", F.expr(f"cast(pmod(xxhash64(block), {many}) as int)").alias("e"))
    right = right.withColumn("q", F.explode(F.expr(f"sequence(0, {parts - 1})")))

    def meet(asking: pa.Table, ends: pa.Table) -> pa.Table:
        out = {"at": [], "block": [], "bound": []}
        if asking.num_rows and ends.num_rows:
            bound = block_bounds(*(_matrix(ends[c]).astype(float) for c in ("low", "high")), _matrix(asking["vector"]).astype(float))
            if first:
                best = np.argsort(-bound, axis=0, kind="stable")[:FIRST]
                block, at = best.ravel(), np.tile(np.arange(bound.shape[1]), len(best))
            else:
                block, at = np.nonzero(bound >= asking["bar"].to_numpy()[None, :])
            out = {"at": at, "block": ends["block"].to_numpy()[block], "bound": bound[block, at]}
        chosen = asking.take(pa.array(out["at"], pa.int64()))
        return pa.table({
            "query_id": chosen["query_id"], "vector": chosen["vector"], "size": chosen["size"], "bar": chosen["bar"],
            "block": pa.array(out["block"], pa.int64()), "bound": pa.array(out["bound"], pa.float64()),
        })

    keys = ["size", "q", "e"]
    schema = "query_id bigint, vector array<bigint>, size int, bar double, block bigint, bound double"
    told = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
    if first:
        rank = F.row_number().over(Window.partitionBy("query_id", "vector").orderBy(F.col("bound").desc(), "block"))
        told = told.withColumn("_rank", rank).filter(F.col("_rank") <= FIRST).drop("_rank")
    return settle(told.drop("bound"))


def read_blocks(going: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: what the queries find in the blocks that they go to, the k best of a block at least; stored."""
    asked = settle(going.groupBy("size", "block").agg(F.ceil(F.count("*") / ASKING).cast("int").alias("tasks")))
    queries = going.join(asked, ["size", "block"]).withColumn("task", F.expr("cast(pmod(xxhash64(query_id, vector), tasks) as int)")).drop("tasks")
    stored = blocks.select("size", "block", "ids", "vectors").join(asked, ["size", "block"]).withColumn("task", F.explode(F.expr("sequence(0, tasks - 1)"))).drop("tasks")

    def read(asking: pa.Table, block: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if asking.num_rows and block.num_rows:
            ids = block["ids"][0].as_py()
            vectors = np.array(block["vectors"][0].as_py(), np.int64).reshape(len(ids), -1)
            # A vector is a query's own if it has no other id.
            alone = np.array([x[0] if len(x) == 1 else np.iinfo(np.int64).min for x in ids])
            for first in range(0, asking.num_rows, QUERIES):
                some = asking.slice(first, QUERIES)
                own_ids = some["query_id"].to_numpy()
                own = (alone[:, None] == own_ids[None, :]) & (alone[:, None] != np.iinfo(np.int64).min)
                told = best_of_block(vectors, own, _matrix(some["vector"]), some["bar"].to_numpy(), k)
                for query, (places, scores) in zip(own_ids.tolist(), told):
                    pairs = sorted((-s, i) for p, s in zip(places.tolist(), scores.tolist()) for i in ids[p] if i != query)
                    found += [(query, i, -s) for s, i in pairs[:k]]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], names=["query_id", "vec_id", "score"])

    keys = ["size", "block", "task"]
    tasks = int(going.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = queries.repartition(tasks, *keys).groupBy(*keys).cogroup(stored.repartition(tasks, *keys).groupBy(*keys))
    return settle(pairs.applyInArrow(read, "query_id bigint, vec_id bigint, score bigint"))


def search(table: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of the table for each query."""
    prepare(table.sparkSession)

    def told(rows: DataFrame, name: str) -> DataFrame:
        chosen = rows.select(F.col(f"`{id_column}`").cast("long").alias(name), integers(F.col(f"`{vector_column}`"), scale).alias("vector"))
        chosen = chosen.filter(F.col(name).isNotNull() & F.col("vector").isNotNull())
        return chosen.distinct().withColumn("size", F.size("vector"))

    # Spark cuts the window to k + 1 rows of each vector in every task before the shuffle.
    order = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    smallest = told(table, "id").withColumn("_order", order).filter(F.col("_order") <= k + 1)
    candidates = settle(smallest.groupBy("vector", "size").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = settle(told(queries, "query_id").withColumn("bar", F.lit(float("-inf"))))
    blocks = stored_blocks(candidates)

    def best(rows: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        return rows.distinct().withColumn("rank", rank).filter(F.col("rank") <= k)

    near = destinations(asked, blocks, first=True)
    begun = read_blocks(near, blocks, k)
    bars = settle(best(begun).filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("bar")))
    asked = settle(asked.drop("bar").join(bars, "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf")))))
    rest = destinations(asked, blocks, first=False).join(near.select("query_id", "vector", "block"), ["query_id", "vector", "block"], "left_anti")
    found = begun.unionByName(read_blocks(settle(rest), blocks, k))
    return best(found).select("query_id", "rank", "vec_id", "score")
