"""Re-sync: the answers to request files."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dense_position
from ..operators import sync
from ..session import settle


def answer(log: DataFrame, requests: DataFrame, registry: DataFrame, target: str, main_office: bool = False) -> DataFrame:
    """Changes that a requesting branch gets, in the order in which it applies them. A main office gets all that match."""
    bounded = sync.bound_sync_request(requests, log)
    matched = sync.request_range_match(log, bounded)
    return sync.apply_order(sync.route_changes(matched, registry, target, main_office))


class Answers(NamedTuple):
    """``changes``: sScopexxx, sTargetxx, the change, and its place ``nPlacexxx`` among those of the address, in the order of
    applying. ``wanted``: which requester takes which range of which address."""

    changes: DataFrame
    wanted: DataFrame

    def of(self, target: str) -> DataFrame:
        """One requester's answer, put together from its addresses."""
        mine = self.wanted.filter(F.col("target") == target).drop("target")
        heard = ["sScopexxx", "sTargetxx", "branch"]
        mine = settle(sync.merge_ranges(mine, heard, "sExportFr", "sExportTr"))
        changes = self.changes.drop("nPlacexxx").withColumn("branch", F.substring("sTransNox", 1, 4))
        same = [changes[c] == mine[c] for c in heard]
        taken = changes.join(mine, [*same, changes.sTransNox.between(mine.sExportFr, mine.sExportTr)], "left_semi")
        return sync.apply_order(taken.drop(*heard))


def answers(log: DataFrame, requests: DataFrame, registry: DataFrame) -> Answers:
    """The answers to the requests of all branches in one job over the log.

    A change for all branches or for an area is stored once, however many requesters want it: they refer to it by their ranges,
    so the result has at most two rows for a change and three for a request, never requesters times changes. Places are
    numbered by ranges, so an address with most of the changes is worked on by many tasks.
    """
    bounded = settle(sync.bound_sync_request(requests, log))
    wanted = settle(sync.subscriptions(bounded))
    changes = sync.addressed_changes(log, registry, wanted)
    order = ["sTransNox", "sModified"]
    return Answers(dense_position(changes, ["sScopexxx", "sTargetxx"], "dModified", order, name="nPlacexxx"), wanted)
