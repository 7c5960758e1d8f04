"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` places on a ring; a key belongs to the first place clockwise of its hash.
A shard takes rows up to its bound and no more; keys that find it full continue clockwise to the next
place whose shard has room. The bounds are those of the law ``rows``: with n rows and s shards, n mod
s shards (those with the smallest numbers) may hold one row more than the others, so counts are at
most one apart. The bound is exact, so keys move a little further than with a loose one.

The order in which keys come is defined on the ring: arcs (the stretches that end at a place) first
keep what their own shards have room for, in clockwise order; then what is left over of each arc, in
the same order, goes on clockwise. Inside an arc rows are taken in order of their hash, doc_id, size
and checksum. So the result depends on the rows alone, not on how they lie in files.

Plan. Equal rows are summed before the shuffle. Rows are numbered inside their arc without gathering
an arc: they are counted in narrow stretches of the ring of about ``STRETCH`` rows, stretches are
summed along the ring, and only rows of one stretch are sorted together. What each arc gives to which
shard is a table of at most arcs + shards rows, worked out from the counts of the arcs, whose number
is a parameter; it is broadcast.

Cases: null and empty texts have size 1. A null id is a key as well. Rows that are alike in id, size
and checksum are interchangeable: each gets a slot of its own. Other columns are not carried. More shards
than rows leave shards empty.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: Places of a shard on the ring; cells into which the ring is divided for finding a key's place.
NODES, CELLS = 64, 1 << 14
#: Rows in a stretch, which one task numbers together.
STRETCH = 4096
#: Rows alike in all that are written out together.
RUN = 4096
LAW = "rows"


def ring(shards: int, nodes: int = NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of the places in ring order; a place that finds its cell taken steps on clockwise."""
    if shards * nodes > cells:
        raise ValueError("the ring has too few cells for so many places")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(nodes):
            cell = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8]) % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def allotted(places: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """What each arc gives to whom: (arc, first row, row after the last, shard, first slot), rows numbered from 0 in the arc."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out, over = [], []
    for arc, (_, shard) in enumerate(places):
        n = counts.get(arc, 0)
        stay = min(n, room[shard] - used[shard])
        if stay:
            out.append((arc, 0, stay, shard, used[shard]))
            used[shard] += stay
        if n > stay:
            over.append((arc, stay, n))
    for arc, first, n in over:
        at = arc
        while first < n:
            at = (at + 1) % len(places)
            shard = places[at][1]
            if take := min(n - first, room[shard] - used[shard]):
                out.append((arc, first, first + take, shard, used[shard]))
                used[shard] += take
                first += take
    return out


def assign(documents: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", nodes: int = NODES) -> DataFrame:
    """key, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot (from 0 without gaps), home_shard (before any overflow)."""
    spark = documents.sparkSession
    data = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
    rows = documents.select(
        F.col(f"`{key}`").alias("_key"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).cast("long").alias("text_crc32"),
    )
    alike = rows.groupBy("_key", "size", "text_crc32").agg(F.count("*").alias("_copies"))
    # The place on the ring, from 0 to 2 ** 62.
    # Rows without an id have no key to share, so they are spread by what they hold.
    content = F.when(F.col("_key").isNull(), F.concat_ws(" ", "size", "text_crc32"))
    alike = settle(alike.withColumn("_at", F.shiftrightunsigned(F.xxhash64(F.lit("ring"), F.col("_key").cast("string"), content), 2)))
    n = alike.agg(F.sum("_copies")).first()[0] or 0

    places = ring(shards, nodes)
    cells = [c for c, _ in places]
    per_cell = [(c, bisect.bisect_left(cells, c) % len(places)) for c in range(CELLS)]
    arcs = F.broadcast(spark.createDataFrame(per_cell, "_cell int, _arc int"))
    cell_bits = 62 - int(math.log2(CELLS))
    bits = max(0, min(40, math.ceil(math.log2(max(1, n / STRETCH)))))
    placed = alike.withColumns({"_cell": F.shiftright("_at", cell_bits).cast("int"), "_stretch": F.shiftright("_at", 62 - bits)})
    placed = placed.join(arcs, "_cell")
    # The arc over the ring's origin begins with the cells behind the last place.
    placed = placed.withColumn("_turn", (F.col("_cell") <= cells[-1]).cast("int"))

    stretches = settle(placed.groupBy("_arc", "_turn", "_stretch").agg(F.sum("_copies").alias("_rows")))
    in_arc = Window.partitionBy("_arc").orderBy("_turn", "_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn("_before", F.coalesce(F.sum("_rows").over(in_arc), F.lit(0))).drop("_rows")
    counts = {r[0]: r[1] for r in placed.groupBy("_arc").agg(F.sum("_copies")).collect()}
    shares = allotted(places, counts, shards)
    schema = "_arc int, _first long, _last long, shard int, _slot long"
    homes = F.broadcast(spark.createDataFrame([(a, s) for a, (_, s) in enumerate(places)], "_arc int, home_shard int"))

    order = Window.partitionBy("_arc", "_turn", "_stretch").orderBy("_at", "_key", "size", "text_crc32")
    numbered = placed.withColumn("_inside", F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies"))
    numbered = numbered.join(stretches, ["_arc", "_turn", "_stretch"])
    # Rows alike in all are written out in runs, and the runs of a row with many copies are dealt to many tasks.
    runs = numbered.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {RUN}L)")))
    many = runs.filter(F.col("_copies") > RUN).repartition("_key", "size", "text_crc32", "_run")
    runs = runs.filter(F.col("_copies") <= RUN).unionByName(many)
    last = F.least(F.col("_copies"), (F.col("_run") + 1) * RUN) - 1
    each = runs.withColumn("_copy", F.explode(F.sequence(F.col("_run") * RUN, last)))
    each = each.withColumn("_row", F.col("_before") + F.col("_inside") + F.col("_copy"))
    given = F.broadcast(spark.createDataFrame(shares, schema))
    out = each.join(given, "_arc").filter("_row >= _first AND _row < _last").join(homes, "_arc")
    return out.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_slot") + F.col("_row") - F.col("_first")).alias("slot"), "home_shard",
    )
