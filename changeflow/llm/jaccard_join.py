"""N-gram Jaccard join through count-vector R-trees, and the groups of linked documents.

Method. A text is the set of its word shingles. The hashes of the shingles are divided into groups;
the numbers of shingles in 64 groups are a text's point. The overlap of two sets is at most the sum
of the smaller coordinates of their points, and of two nodes of an R-tree at most the sum of the smaller
coordinates of their upper corners. Pairs of nodes are descended as far as that bound allows; pairs of
sets that survive are verified on the whole sets.

A tree over all points alone would compare a constant share of all pairs: the points of unrelated
long texts lie close together. So sets are first dealt into buckets, exactly, by the same idea of groups: sets
that reach the threshold differ in at most D elements, so when their hashes are cut into G > D groups, one
group is equal as a whole, and they meet in the *bucket* of that group. The D + 1 largest groups of a set suffice, and the
smallest ones, which unrelated texts share by chance the more the more texts there are, make no bucket. Near copies meet in many buckets with nearly
the same members, so buckets that share a set are one *pool*: every set lies in one pool at most, and every link
inside a pool. Each pool is searched by R-trees, which are bulk-loaded: inner nodes halve their points at the coordinate
that spreads most. All links come out of these trees.

Only components are returned, so a search joins as it goes: sets that are connected already are not
compared, subtrees of one component are skipped, and a search hands on a spanning forest, fewer links
than its sets. A pool is cut into tiles of at most ``TILE`` sets (or ``TILE_BYTES``) of like sizes that meet the same smallest set.
First each tile is searched by itself; then, of buckets that reach over tiles and still hold several components, the
sets in neighbouring tiles, which connects groups of copies of any size with two rows for a set; then those in any two tiles.
A task holds two tiles at most.

Equal sets are one class from the start.

Cases: null, empty or wordless texts have no shingles and are linked with nothing, each its own
component. Rows without an id take no part and come back without a component. Rows that repeat an id give a row
each. Hashes have 64 bits: among d different sets, two are taken for one with odds of about d * d / 2 ** 65. Columns
other than the two named are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_position
from ..session import new_folder, scratch, settle
from .common import _BASE, map_batches, mix, prepare, shingles_of, signed, text_chunks, words_of

#: Coordinates of a point.
COORDINATES = 64
#: Ratio of neighbouring limits of the size classes.
CLASS_RATIO = 1.5
#: Groups of a class, as percent of the elements in which its sets may differ.
SPARE = 115
#: Points in a leaf; sets of a tile, and bytes of their hashes.
LEAF, TILE, TILE_BYTES = 16, 4096, 32 << 20
#: Links that one task joins by itself.
LINKS = 1 << 18


def size_class(n: np.ndarray | int) -> np.ndarray | int:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(CLASS_RATIO) + 1e-9).astype(int)


@functools.cache
def class_limits(k: int) -> tuple[int, int]:
    """Smallest and largest size in a class."""
    sizes = np.arange(max(1, int(CLASS_RATIO**k) - 2), int(CLASS_RATIO ** (k + 1)) + 3)
    own = sizes[size_class(sizes) == k]
    return (int(own[0]), int(own[-1])) if len(own) else (0, -1)


def most_different(total: int, percent: int) -> int:
    """Most elements in which two sets of so many elements in total may differ and still be linked."""
    return total * (100 - percent) // (100 + percent)


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """One hash for each of the largest groups of the set, in the classes in which it can be a pair's smaller set.

    A pair belongs to the class of its smaller set. The larger one joins that class too if a partner
    can be there. Of D different elements none spoils more than one group, so of both sets' groups in order of size, the largest
    first and equal sizes by number, the first equal one is among the first D + 1.
    """
    n, out = len(hashes), []
    own = int(size_class(n))
    smallest = -(-n * percent // 100)
    for k in range(int(size_class(smallest)), own + 1):
        low, high = class_limits(k)
        if high < low:
            continue
        groups = most_different(high + high * 100 // percent, percent) * SPARE // 100 + 2
        group = ((hashes >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
        edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        content = np.add.reduceat(mix(hashes), edges)
        of_class = np.uint64((k + 1) * int(_BASE) % 2**64)
        salt = mix(of_class + group[edges])
        partner = n * 100 // percent if k == own else min(high, n)
        wanted = most_different(n + partner, percent) + 1
        largest = np.argsort(-np.diff(np.append(edges, n)), kind="stable")[:wanted]
        out.append(mix(content + salt)[largest])
        if len(edges) < wanted:
            # So few groups have elements that the equal one may be empty in both sets.
            empty = np.setdiff1d(np.arange(groups, dtype=np.uint64), group[edges])[: wanted - len(edges)]
            out.append(mix(mix(of_class + empty) ^ np.uint64(0x5BD1E995)))
    return np.concatenate(out)


def node_of(hashes: np.ndarray) -> int:
    """The name of a set."""
    return int(signed(mix(np.add.reduce(mix(hashes), keepdims=True) + np.uint64(len(hashes))))[0])


def points(documents: DataFrame, columns: tuple[str, str], size: int, percent: int) -> DataFrame:
    """id, n (size of the set), node (name of the set), sigs."""

    def work(batch: pa.RecordBatch) -> dict:
        n, node, sigs = [], [], []
        for first, last, data, bounds in text_chunks(batch.column(1)):
            words, _, first_words = words_of(data, bounds, lower=True)
            for i in range(last - first):
                hashes = shingles_of(words[first_words[i] : first_words[i + 1]], size)
                n.append(len(hashes))
                node.append(node_of(hashes))
                sigs.append(signed(signatures(hashes, percent)) if len(hashes) else [])
        return {
            "id": batch.column(0), "n": pa.array(n, pa.int64()), "node": pa.array(node, pa.int64()), "sigs": pa.array(sigs, pa.list_(pa.int64())),
        }

    rows = documents.select(F.col(f"`{columns[0]}`").cast("long").alias("id"), F.col(f"`{columns[1]}`").cast("string").alias("text"))
    return map_batches(rows, work, "id bigint, n bigint, node bigint, sigs array<bigint>")


def shingle_sets(documents: DataFrame, ids: DataFrame, columns: tuple[str, str], size: int) -> DataFrame:
    """node, n and the sorted shingle hashes, for the texts of the given distinct ids."""

    def work(batch: pa.RecordBatch) -> dict:
        sets = []
        for first, last, data, bounds in text_chunks(batch.column(1)):
            words, _, first_words = words_of(data, bounds, lower=True)
            sets += [shingles_of(words[first_words[i] : first_words[i + 1]], size) for i in range(last - first)]
        nodes, sizes = pa.array([node_of(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64())
        return {"node": nodes, "n": sizes, "shingles": pa.array([signed(x) for x in sets], pa.list_(pa.int64()))}

    rows = documents.select(F.col(f"`{columns[0]}`").cast("long").alias("id"), F.col(f"`{columns[1]}`").cast("string").alias("text"))
    return map_batches(rows.join(ids, "id", "left_semi"), work, "node bigint, n bigint, shingles array<bigint>")


class Tree:
    """A bulk-loaded R-tree over count vectors. Node 0 is the root; ``order`` has the points' places as they lie in the leaves."""

    def __init__(self, at: np.ndarray, n: np.ndarray):
        self.order = np.arange(len(n))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        corners, low, high = [], [], []
        pending = [(0, len(n), -1, 0)]
        while pending:
            a, z, parent, side = pending.pop()
            name = len(self.spans)
            if parent >= 0:
                self.children[parent] = (*self.children[parent][:side], name, *self.children[parent][side + 1 :])
            own = at[self.order[a:z]]
            self.spans.append((a, z))
            corners.append(own.max(0))
            low.append(n[self.order[a:z]].min())
            high.append(n[self.order[a:z]].max())
            if z - a <= LEAF:
                self.children.append(None)
                continue
            self.children.append((-1, -1))
            widest = int((corners[-1] - own.min(0)).argmax())
            self.order[a:z] = self.order[a:z][np.argsort(own[:, widest], kind="stable")]
            middle = (a + z) // 2
            pending += [(a, middle, name, 0), (middle, z, name, 1)]
        self.corners, self.low, self.high = np.array(corners), np.array(low), np.array(high)


def search(sets: list[np.ndarray], labels: np.ndarray, percent: int, allowed: np.ndarray, side: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """Links between the sets (sorted hashes) that connect their components, as far as there are any, and the pairs verified.

    ``labels`` has each set's component so far, ``side`` 0 or 1 for each; sides may be compared as ``allowed`` says.
    """
    n = np.array([len(x) for x in sets])
    at = np.array([np.bincount((x.view(np.uint64) >> np.uint64(58)).astype(np.int64), minlength=COORDINATES) for x in sets], np.int32)
    tree = Tree(at, n)
    # From here on all arrays are in the order of the leaves.
    order = tree.order
    n, at, labels, side = n[order], at[order], np.unique(labels[order], return_inverse=True)[1], side[order]
    links, tested, total = [], 0, 100 + percent

    def linked(i: int, j: int) -> bool:
        x, y = sets[order[i]], sets[order[j]]
        if len(x) < len(y):
            x, y = y, x
        place = x.searchsorted(y)
        place[place == len(x)] = 0
        common = int((x[place] == y).sum())
        return total * common >= percent * (len(x) + len(y))

    pending = [(0, 0)]
    while pending:
        x, y = pending.pop()
        (a, z), (b, e) = tree.spans[x], tree.spans[y]
        if 100 * tree.high[y] < percent * tree.low[x] or 100 * tree.high[x] < percent * tree.low[y]:
            continue
        label = labels[a]
        if (labels[a:z] == label).all() and (labels[b:e] == label).all():
            continue
        if x != y and total * int(np.minimum(tree.corners[x], tree.corners[y]).sum()) < percent * int(tree.low[x] + tree.low[y]):
            continue
        one, two = tree.children[x], tree.children[y]
        if one is None and two is None:
            bound = np.minimum(at[a:z, None, :], at[None, b:e, :]).sum(2)
            near = (total * bound >= percent * (n[a:z, None] + n[None, b:e])) & (labels[a:z, None] != labels[None, b:e])
            near &= allowed[side[a:z, None], side[None, b:e]]
            for p, q in zip(*np.nonzero(np.triu(near, 1) if x == y else near)):
                i, j = a + p, b + q
                if labels[i] != labels[j]:
                    tested += 1
                    if linked(i, j):
                        links.append((int(order[i]), int(order[j])))
                        labels[labels == labels[j]] = labels[i]
        elif x == y:
            pending += [one, (one[0], one[0]), (one[1], one[1])]
        elif two is None or (one is not None and z - a >= e - b):
            pending += [(one[0], y), (one[1], y)]
        else:
            pending += [(x, two[0]), (x, two[1])]
    return links, tested


def tree_links(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of sets that are searched together (``meetings``), found by their trees; stored.

    Of a tile with itself all pairs are searched, else those between the two.
    """
    rows = met.join(sets.select("node", "shingles"), "node")

    def run(table: pa.Table) -> pa.Table:
        _, first = np.unique(table["node"].to_numpy(), return_index=True)
        labels, tile = (table[c].to_numpy()[first] for c in ("component", "tile"))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        found = table["shingles"].combine_chunks()
        edges, values = found.offsets.to_numpy(), found.values.to_numpy()
        own = [values[edges[x] : edges[x + 1]].view(np.uint64) for x in first]
        links, _ = search(own, labels, percent, np.array([[i == j, True], [True, i == j]]), (tile != i).astype(int))
        return pa.table({"a": pa.array([labels[x] for x, _ in links], pa.int64()), "b": pa.array([labels[y] for _, y in links], pa.int64())})

    # The work grows with the sets, not with their bytes, so it is dealt into many tasks.
    tasks = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(rows.repartition(tasks, "pool", "i", "j").groupBy("pool", "i", "j").applyInArrow(run, "a bigint, b bigint"))


def contents(edges: DataFrame) -> tuple:
    """The number of distinct rows and sums of their hashes: alike for the same rows in any order."""
    sums = [F.sum(F.xxhash64("u", "v", F.lit(i)).cast("decimal(38,0)")) for i in range(2)]
    return tuple(edges.agg(F.count("*"), *sums).first())


def contracted(links: DataFrame, parts: int) -> DataFrame:
    """Distinct edges (u, v), v the smaller, that connect what the links (a, b) do; stored.

    Links are dealt into so many groups, and each group hands on every node with the smallest one that it reaches there.
    """

    def joined(table: pa.Table) -> pa.Table:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (above := up.setdefault(top, top)) != top:
                top = above
            while up[x] != top:
                up[x], x = top, up[x]
            return top

        for a, b in zip(table["a"].to_pylist(), table["b"].to_pylist()):
            if (x := root(a)) != (y := root(b)):
                up[max(x, y)] = min(x, y)
        ends = [(x, top) for x in list(up) if (top := root(x)) != x]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*ends) if ends else ([], []))], names=["u", "v"])

    dealt = links.select("a", "b", F.expr(f"pmod(xxhash64(a, b), {parts})").alias("_part"))
    return settle(dealt.groupBy("_part").applyInArrow(joined, "u bigint, v bigint").distinct())


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node it can reach; stored.

    Groups of about ``LINKS`` links are joined first, each by a task. What they hand on goes through rounds of large star and small star: neighbours
    are joined to the smallest one around, first the larger ones, then the smaller ones, until nothing changes; where one
    group had all links, nothing is left to do. Each round is written, so that losing an executor repeats one round at most.
    """
    parts = -(-max(1, links.count()) // LINKS)
    edges = contracted(links, parts)
    state = contents(edges)
    while parts > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, contents(edges)
        if state == before:
            break
    return settle(
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )


def pools(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of sets (node, sigs) those that meet others: node, pool and the smallest set that it meets (``leader``), and the
    members (sig, node) of their buckets; both stored.

    In a bucket every set is tied to the smallest one, and what is tied together is a pool. Signatures grow with the documents, so
    they are met by a shuffle at every size, the only one of them all: counted and kept where they were dealt.
    """
    dealt = rows.select("node", F.explode("sigs").alias("sig")).repartition("sig")
    several = dealt.groupBy("sig").agg(F.count("*").alias("n"), F.min("node").alias("first")).filter("n > 1").select("sig", "first")
    members = settle(dealt.join(several.hint("merge"), "sig").select("sig", "node", "first"))
    ties = settle(members.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    leaders = ties.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("leader"))
    pooled = components(ties).withColumnRenamed("component", "pool").join(leaders, "node", "left")
    return settle(pooled.withColumn("leader", F.least("node", "leader"))), members.select("sig", "node")


def of_like_sizes(pooled: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The sets of pools (with their ``n``) without pools of two whose sizes allow no link, as most that share a passage are; stored."""
    sized = pooled.join(sizes, "node")
    pairs = sized.groupBy("pool").agg(F.count("*").alias("sets"), F.min("n").alias("low"), F.max("n").alias("high"))
    apart = pairs.filter(f"sets = 2 AND 100 * low < {percent} * high").select("pool")
    return settle(sized.join(apart, "pool", "left_anti"))


def tiles(sized: DataFrame) -> DataFrame:
    """pool, tile, node of every set in a pool, sets of one leader beside each other; stored."""
    # Classes are wide, as sets near a limit meet across it; a tile's bytes are bounded by the largest sets of its class.
    size_class = F.expr("cast(floor((log2(n) + 1) / 4) as int)")
    numbered = dense_position(sized.withColumn("_class", size_class), ["pool", "_class"], "leader", ["n", "node"], name="_place")
    most = F.expr(f"greatest(2L, least({TILE}L, cast({TILE_BYTES} / pow(2, 4 * _class + 6) as bigint)))")
    numbered = numbered.withColumn("_most", most)
    return settle(numbered.select("pool", F.expr("_class * 1099511627776L + (_place - 1) div _most").alias("tile"), "node"))


def across_tiles(placed: DataFrame, members: DataFrame) -> DataFrame:
    """The members (sig, node) of buckets that reach over several tiles; stored. Most do not."""
    tiled = members.join(placed.select("node", "tile"), "node")
    wide = tiled.groupBy("sig").agg(F.min("tile").alias("least"), F.max("tile").alias("most")).filter("least < most").select("sig")
    return settle(members.join(settle(wide), "sig", "left_semi"))


def meetings(named: DataFrame, members: DataFrame, turn: str) -> DataFrame:
    """Who is searched together in a turn: pool, i, j (tiles), tile, node, component; stored.

    ``alone``: each tile with several components. Else two tiles that share a bucket with several components, and of them the
    sets in such buckets: a tile and the bucket's next one (``neighbours``), or any two (``all``). ``members`` are those of
    buckets that reach over tiles.
    """
    if turn == "alone":
        several = named.groupBy("pool", "tile").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
        rows = named.join(several.select("pool", "tile"), ["pool", "tile"], "left_semi")
        return settle(rows.select("pool", F.col("tile").alias("i"), F.col("tile").alias("j"), "tile", "node", "component"))
    placed = members.join(named, "node")
    still = placed.groupBy("sig").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("sig")
    placed = settle(placed.join(still, "sig", "left_semi"))
    shared = placed.select("sig", "tile").distinct().withColumn("_place", F.row_number().over(Window.partitionBy("sig").orderBy("tile")))
    one, two = (shared.select("sig", F.col("tile").alias(x), F.col("_place").alias(f"_{x}")) for x in "ij")
    pairs = one.join(two, "sig").filter("_j = _i + 1" if turn == "neighbours" else "_j > _i + 1").select("sig", "i", "j")
    ends = pairs.select("sig", "i", "j", F.explode(F.array("i", "j")).alias("tile"))
    return settle(placed.join(ends, ["sig", "tile"]).select("pool", "i", "j", "tile", "node", "component").distinct())


def stored(rows: DataFrame, folder: str) -> DataFrame:
    """Rows written to a folder and read from there."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def linked_components(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """id, n_shingles, component_id: the smallest id that links reach, over all texts with an id.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their sets of ``size``-word shingles.
    """
    prepare(documents.sparkSession)
    folders = [new_folder(documents.sparkSession, f"linked-{name}") for name in ("components", "sets", "pools", "members")]
    # Tables on the way go as soon as what they are for is stored, those with all signatures first.
    with scratch():
        return stored(_linked(documents, (id_column, text_column), size, percent, folders[1:]), folders[0])


def _linked(documents: DataFrame, columns: tuple[str, str], size: int, percent: int, folders: list[str]) -> DataFrame:
    with scratch():
        every = settle(points(documents, columns, size, percent))
        told = stored(every.select("id", "n", "node"), folders[0])
        wordy = every.filter("n > 0 AND id IS NOT NULL")
        # One row for each different set: its smallest id stands for it.
        firsts = settle(wordy.groupBy("node").agg(F.min("id").alias("id")))
        pooled, members = pools(wordy.join(firsts, ["node", "id"], "left_semi"))
        pooled, members = stored(pooled, folders[1]), stored(members, folders[2])
    classes = settle(told.filter("n > 0 AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("id")))
    sizes = told.filter("n > 0 AND id IS NOT NULL").groupBy("node").agg(F.min("n").alias("n"))
    sized = of_like_sizes(pooled, sizes, percent)
    wanted = settle(classes.join(sized, "node", "left_semi").select("id").distinct())
    sets = settle(shingle_sets(documents, wanted, columns, size))
    named = tiles(sized).withColumn("component", F.col("node"))
    wide = across_tiles(named, members)

    for turn in ("alone", "neighbours", "all"):
        met = meetings(named, wide, turn)
        links = None if met.isEmpty() else tree_links(met, sets, percent)
        if links is not None and not links.isEmpty():
            # Components that are linked become one.
            merged = components(links).select(F.col("node").alias("component"), F.col("component").alias("_new"))
            named = named.join(merged, "component", "left").withColumn("component", F.coalesce("_new", "component")).drop("_new")
            named = settle(named)

    groups = classes.join(named.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = groups.groupBy("component").agg(F.min("id").alias("component_id"))
    named = settle(groups.join(smallest, "component").select("node", "component_id"))
    keyed = told.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("node")).alias("node")).join(named, "node", "left")
    return keyed.select(
        F.col("id").alias(columns[0]), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
