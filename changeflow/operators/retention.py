"""Retention and ownership trimming. Every function returns the rows to keep or to purge; nothing is deleted."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import branch_of
from ..sources.runs import Runs
from .windows import with_branch

# Fixed value: months a foreign log row is kept.
KEEP_MONTHS = 6
# The two divisions that have lists of their own.
DIVISION_MP, DIVISION_MC = "0", "1"


def _expired(as_of: date, months: int) -> Column:
    return F.col("dModified") <= F.add_months(F.lit(as_of), -months).cast("timestamp_ntz")


def retain_log(
    log: DataFrame, own: str, as_of: date, branches: DataFrame | None = None, months: int = KEEP_MONTHS
) -> DataFrame:
    """Log rows to keep: own rows and rows younger than the limit, with a registry also rows of branches not in it."""
    rows, expired = with_branch(log), _expired(as_of, months)
    if branches is None:
        kept = rows.filter(~F.coalesce((F.col("branch") != own) & expired, F.lit(False)))
    else:
        kept = rows.join(_others(branches, own), (F.col("branch") == F.col("_other")) & expired, "left_anti")
    return kept.select(*log.columns)


def purge_log(
    log: DataFrame, own: str, as_of: date, branches: DataFrame | None = None, months: int = KEEP_MONTHS
) -> DataFrame:
    """Log rows to purge: the complement of ``retain_log``.

    Age and branch are filters on the scan itself, so of a log stored by branch the own folder is not
    read, nor are row groups that are too young.
    """
    rows = with_branch(log).filter((F.col("branch") != own) & _expired(as_of, months))
    if branches is not None:
        rows = rows.join(_others(branches, own), F.col("branch") == F.col("_other"), "left_semi")
    return rows.select(*log.columns)


def purge_plan(log: Runs, own: str, as_of: date, branches: DataFrame | None = None, months: int = KEEP_MONTHS, before: int | None = None) -> DataFrame:
    """From the zone map the files of a log in runs that hold rows to purge: path, and ``whole`` if they hold no others."""
    zones = log.zones(before)
    theirs = F.col("branch") != own
    if branches is not None:
        zones = zones.join(_others(branches, own).distinct().withColumn("_known", F.lit(True)), F.col("branch") == F.col("_other"), "left")
        theirs = theirs & F.coalesce("_known", F.lit(False))
    limit = F.add_months(F.lit(as_of), -months).cast("timestamp_ntz")
    some, every = theirs & (F.col("dOldestxx") <= limit), theirs & (F.col("dLatestxx") <= limit)
    return zones.groupBy("path").agg(F.bool_or(some).alias("_some"), F.bool_and(every).alias("whole")).filter("_some").select("path", "whole")


def purge_files(
    log: Runs, own: str, as_of: date, step: int, branches: DataFrame | None = None, months: int = KEEP_MONTHS, files_per_part: int = 100
) -> None:
    """Purge the stored log itself, as one of its steps: files whose rows all go are left out, mixed ones are rewritten without the
    rows to purge, others are not touched. Stopped half-way and run again, it goes on where it was."""
    plan = purge_plan(log, own, as_of, branches, months, step)
    log.rewrite(plan, lambda rows: retain_log(rows, own, as_of, branches, months), step, files_per_part)


def _others(branches: DataFrame, own: str) -> DataFrame:
    return branches.filter(F.col("sBranchCd") != own).select(F.col("sBranchCd").alias("_other"))


def trim_by_branch(rows: DataFrame, branches: DataFrame, own: str, column: str = "sBranchCd") -> DataFrame:
    """Rows whose branch column is not one of the other branches."""
    others = _others(branches, own)
    return rows.join(others, F.col(column) == F.col("_other"), "left_anti")


def trim_by_key_prefix(rows: DataFrame, branches: DataFrame, own: str, key: str = "sTransNox") -> DataFrame:
    """Rows whose key was not written by one of the other branches."""
    others = _others(branches, own)
    written_by = F.col("branch") if key == "sTransNox" and "branch" in rows.columns else branch_of(key)
    return rows.join(others, written_by == F.col("_other"), "left_anti")


def trim_plan(actions: DataFrame, division: str, log_only: bool = False) -> DataFrame:
    """What to do with each table: truncate, branch, prefix or keep.

    ``actions`` (sTableNme, sGroupxxx) lists tables by group: 'common', 'mc', 'mp' to be truncated,
    'mc_branch', 'mc_prefix', 'mp_branch', 'mp_prefix' to be trimmed. Common tables are always
    truncated. Division 0 truncates the mc list and trims the mp lists, division 1 the other way
    round, another division does nothing more. ``log_only`` keeps every table. A table on several
    lists gets the strongest action.
    """
    group = F.col("sGroupxxx")
    if log_only:
        rank = F.lit(0)
    else:
        cleared, trimmed = {DIVISION_MP: ("mc", "mp"), DIVISION_MC: ("mp", "mc")}.get(division, (None, None))
        rank = F.when(group == "common", 3)
        if cleared:
            rank = rank.when(group == cleared, 3).when(group == f"{trimmed}_branch", 2).when(group == f"{trimmed}_prefix", 1)
        rank = rank.otherwise(0)
    strongest = actions.groupBy("sTableNme").agg(F.max(rank).alias("_rank"))
    names = F.array(*[F.lit(n) for n in ("keep", "prefix", "branch", "truncate")])
    return strongest.select("sTableNme", F.get(names, F.col("_rank")).alias("sActionxx"))
