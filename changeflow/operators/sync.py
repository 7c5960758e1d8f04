"""Re-sync on request: who asks for what, which rows match, and where each change goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import area_of, branch_of, client_prefix, first_row
from ..session import settle
from .windows import last_key_per_branch, with_branch

# Table types of the registry.
TO_ALL, TO_OWNER, TO_DESTINATION, TO_AREA = "0", "1", "2", "3"


def active_clients(clients: DataFrame, branches: DataFrame, self_id: str) -> DataFrame:
    """Clients of active branches, without the asking client itself."""
    active = branches.filter(F.col("cRecdStat") == "1").select("sBranchCd")
    return clients.filter(F.col("sClientID") != self_id).join(active, "sBranchCd", "left_semi")


def build_sync_request(
    log: DataFrame, clients: DataFrame, branches: DataFrame, self_id: str, export_code: str
) -> DataFrame:
    """Every active client with the last key the asker holds of it, '' when none."""
    asked = active_clients(clients, branches, self_id).withColumn("branch", client_prefix("sClientID"))
    return asked.join(last_key_per_branch(log, asked), "branch", "left").select(
        F.lit(export_code).alias("sExportCd"), "sClientID", F.coalesce("sLastKey", F.lit("")).alias("sExportFr")
    )


def bound_sync_request(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Adds sExportTr, the last key the responder holds of the client, '' when none."""
    asked = requests.withColumn("branch", client_prefix("sClientID"))
    return asked.join(last_key_per_branch(log, asked), "branch", "left").select(
        *[c for c in requests.columns if c != "sExportTr"], F.coalesce("sLastKey", F.lit("")).alias("sExportTr")
    )


def request_range_match(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Log rows inside any requested range, each once however many ranges hold it."""
    ranges = requests.select(
        client_prefix("sClientID").alias("_prefix"), F.col("sExportFr").alias("_from"), F.col("sExportTr").alias("_thru")
    )
    rows = with_branch(log)
    inside = (rows.branch == F.col("_prefix")) & rows.sTransNox.between(F.col("_from"), F.col("_thru"))
    matched = rows.join(settle(ranges), inside, "left_semi")
    return matched.select(*log.columns)


def merge_ranges(ranges: DataFrame, group: list[str], first: str, last: str) -> DataFrame:
    """The ranges of each group without overlap: group, ``first`` and ``last`` of each stretch that they cover, both inclusive.

    Ranges are taken by their beginnings; one that begins behind all that went before it begins a new stretch. What went before
    is a running maximum, in two steps, so that a group with most of the ranges is no single task's: ranges of
    (group, first) are sorted by many tasks, each finds the maximum so far among its own, and adds that of the tasks before
    it, a table of one row per task and group. Stretches are numbered in the same way. Ranges that end before they begin, or
    lack an end, cover nothing.
    """
    sound = ranges.filter(F.col(first) <= F.col(last)).select(*group, first, last)
    order = [*group, first, last]
    placed = sound.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = settle(placed).withColumn("_task", F.shiftright("_place", 33))
    own = Window.partitionBy("_task", *group).orderBy("_place")
    placed = placed.withColumn("_before", F.max(last).over(own.rowsBetween(Window.unboundedPreceding, -1)))

    def earlier(runs: DataFrame, value: Column) -> DataFrame:
        """Per task and group what its earlier tasks come to, for tasks that have any."""
        in_order = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        return settle(runs.withColumn("_carried", value.over(in_order)).select("_task", *group, "_carried"))

    def carried(rows: DataFrame, runs: DataFrame) -> DataFrame:
        same = [rows["_task"] == runs["_task"], *[rows[c].eqNullSafe(runs[c]) for c in group]]
        return rows.join(runs, same, "left").select(*[rows[c] for c in rows.columns], runs["_carried"])

    highest = placed.groupBy("_task", *group).agg(F.max(last).alias("_run"))
    begun = carried(placed, earlier(highest, F.max("_run")))
    reached = F.greatest("_before", "_carried")  # null only where nothing went before
    begun = settle(begun.withColumn("_begins", F.coalesce(F.col(first) > reached, F.lit(True)).cast("long")).drop("_before", "_carried"))
    numbers = begun.withColumn("_own", F.sum("_begins").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    counts = begun.groupBy("_task", *group).agg(F.sum("_begins").alias("_run"))
    numbers = carried(numbers, earlier(counts, F.sum("_run")))
    stretch = (F.col("_own") + F.coalesce("_carried", F.lit(0))).alias("_stretch")
    return numbers.select(*group, first, last, stretch).groupBy(*group, "_stretch").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_stretch")


def requested_ranges(requests: DataFrame) -> DataFrame:
    """What all requests together ask for: disjoint ranges per prefix (``branch``, sExportFr, sExportTr)."""
    asked = requests.select(client_prefix("sClientID").alias("branch"), "sExportFr", "sExportTr")
    return settle(merge_ranges(asked, ["branch"], "sExportFr", "sExportTr"))


def merged_range_match(log: DataFrame, requests: DataFrame) -> DataFrame:
    """As ``request_range_match``, for many overlapping ranges: they are merged first, so a row meets one range at most."""
    ranges = requested_ranges(requests).withColumnRenamed("branch", "_prefix")
    rows = with_branch(log)
    inside = (rows.branch == F.col("_prefix")) & rows.sTransNox.between(F.col("sExportFr"), F.col("sExportTr"))
    return rows.join(ranges, inside).select(*[rows[c] for c in log.columns])


def route_changes(log: DataFrame, registry: DataFrame, target: str, main_office: bool = False) -> DataFrame:
    """Changes that one target gets, by the type of their table. A main office gets all of them."""
    if main_office:
        return log
    kind, owner = F.col("cTableTyp"), F.col("sBranchCd")
    goes = (
        (kind == TO_ALL)
        | ((kind == TO_OWNER) & (owner == target))
        | ((kind == TO_DESTINATION) & (F.col("sDestinat") == target))
        | ((kind == TO_AREA) & owner.startswith(target[:1]))
        # Written elsewhere about the target, whatever the table's type.
        | ((owner == target) & ~F.col("sTransNox").startswith(target))
    )
    return log.join(registry.select("sTableNme", "cTableTyp"), "sTableNme").filter(goes).select(*log.columns)


def _address(scope: str, target: Column) -> Column:
    return F.struct(F.lit(scope).alias("sScopexxx"), target.alias("sTargetxx"))


def route_changes_all(log: DataFrame, registry: DataFrame) -> DataFrame:
    """Every change with its address or addresses: sScopexxx 'all', 'branch' or 'area', and sTargetxx.

    A change for all branches stays one row, and a change for an area one row, so the result does
    not grow with the number of branches; ``route_summary`` turns addresses into targets. The
    addresses of one row are worked out inside the row and never reach the same target twice, so no
    shuffle and no duplicate removal is needed.
    """
    kind, owner = F.col("cTableTyp"), F.col("sBranchCd")

    to_owner = F.when(owner.isNotNull(), F.array(_address("branch", owner)))
    written_elsewhere = F.when(owner != branch_of("sTransNox"), F.array(_address("branch", owner)))
    to_destination = F.when(F.col("sDestinat").isNotNull(), F.array(_address("branch", F.col("sDestinat"))))
    none = F.array().cast("array<struct<sScopexxx:string,sTargetxx:string>>")
    addresses = (
        F.when(kind == TO_ALL, F.array(_address("all", F.lit("*"))))
        .when(kind == TO_OWNER, to_owner)
        .when(kind == TO_DESTINATION, F.array_union(F.coalesce(to_destination, none), F.coalesce(written_elsewhere, none)))
        .when(kind == TO_AREA, F.when(owner.isNotNull(), F.array(_address("area", area_of(owner)))))
        .otherwise(written_elsewhere)
    )
    routed = log.join(registry.select("sTableNme", "cTableTyp"), "sTableNme")
    return routed.select(F.inline(addresses), *[F.col(c) for c in log.columns])


def _expand_routes(routes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target and address, for the given targets (column ``target``); only for rows counted by address."""
    subscriptions = targets.select(
        "target",
        F.inline(
            F.array(
                _address("all", F.lit("*")), _address("branch", F.col("target")), _address("area", area_of("target"))
            )
        ),
    )
    return routes.join(settle(subscriptions), ["sScopexxx", "sTargetxx"]).drop("sScopexxx", "sTargetxx")


def route_summary(routes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target the number of changes it gets and its first and last key.

    Changes are counted per address before addresses are turned into targets, so a change for all
    branches is not repeated for each.
    """
    per_address = routes.groupBy("sScopexxx", "sTargetxx").agg(
        F.count("*").alias("n"), F.min("sTransNox").alias("first"), F.max("sTransNox").alias("last")
    )
    return _expand_routes(per_address, targets).groupBy("target").agg(
        F.sum("n").alias("nRowsxxxx"), F.min("first").alias("sFirstKey"), F.max("last").alias("sLastKey")
    )


def subscriptions(requests: DataFrame) -> DataFrame:
    """What every requester wants to hear: sScopexxx, sTargetxx (an address as in ``route_changes_all``), the requester as
    ``target``, and a range of one prefix (``branch``, sExportFr, sExportTr). The requester is the branch that made the request,
    the first four characters of sExportCd."""
    target = branch_of("sExportCd")
    addresses = F.array(_address("all", F.lit("*")), _address("branch", target), _address("area", area_of(target)))
    wanted = requests.select(target.alias("target"), client_prefix("sClientID").alias("branch"), "sExportFr", "sExportTr", F.explode(addresses).alias("_to"))
    return wanted.select("_to.*", "target", "branch", "sExportFr", "sExportTr")


def addressed_changes(log: DataFrame, registry: DataFrame, wanted: DataFrame) -> DataFrame:
    """Changes by address that at least one requester wants, each once per address: sScopexxx, sTargetxx and the change.

    The ranges of all requesters behind one address are merged, so a routed row meets one range at most.
    """
    heard = ["sScopexxx", "sTargetxx", "branch"]
    ranges = settle(merge_ranges(wanted, heard, "sExportFr", "sExportTr"))
    routes = route_changes_all(log, registry)
    routes = routes.withColumn("branch", branch_of("sTransNox"))
    same = [routes[c] == ranges[c] for c in heard]
    return routes.join(ranges, [*same, routes.sTransNox.between(ranges.sExportFr, ranges.sExportTr)]).select(
        routes.sScopexxx, routes.sTargetxx, *[routes[c] for c in log.columns]
    )


def apply_order(log: DataFrame) -> DataFrame:
    """Rows by (dModified, sTransNox), the order in which changes are applied."""
    return log.orderBy("dModified", "sTransNox")


def advance_client_watermark(clients: DataFrame, requests: DataFrame) -> DataFrame:
    """New client registry: sExportNo raised to the answered sExportTr, never lowered, compared case-blind."""
    highest = first_row(requests, ["sClientID"], [F.lower("sExportTr").desc(), F.col("sExportTr").desc()])
    answered = highest.select("sClientID", F.col("sExportTr").alias("_new"))
    higher = F.lower("_new") > F.lower(F.coalesce("sExportNo", F.lit("")))
    return (
        clients.join(answered, "sClientID", "left")
        .withColumn("sExportNo", F.when(higher, F.col("_new")).otherwise(F.col("sExportNo")))
        .select(*clients.columns)
    )
