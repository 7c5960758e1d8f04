"""Ageing of requested accounts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from ..operators import ageing


def age_requested(requested: DataFrame, accounts: DataFrame, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Ageing of the requested open accounts, and the requests that cannot be answered."""
    opened = ageing.open_accounts(accounts)
    wanted = opened.join(requested.select("sAcctNmbr"), "sAcctNmbr", "left_semi")
    return ageing.account_ageing(wanted, as_of), ageing.ageing_errors(requested, opened)
