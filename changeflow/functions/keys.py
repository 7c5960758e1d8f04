"""Parts of keys and codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def branch_of(key: Column | str) -> Column:
    """The branch code: the first four characters of a key or of a batch file name."""
    return F.substring(key, 1, 4)


def client_prefix(client_id: Column | str) -> Column:
    """The key prefix that a client writes with: the last four characters of its id."""
    return F.right(F.col(client_id) if isinstance(client_id, str) else client_id, F.lit(4))


def area_of(code: Column | str) -> Column:
    """The area letter of a branch code."""
    return F.substring(code, 1, 1)
