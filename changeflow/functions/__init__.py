"""Column expressions. All are built-in Spark functions, so they stay inside whole-stage codegen."""

from .keys import area_of, branch_of, client_prefix
from .numbers import default_fill, months_between_calendars, round_half_up, zero_if_null
from .ranking import dense_position, first_row
from .text import address_line, full_name, plain_base64, short_name
from .times import moment, read_time, write_time

__all__ = [
    "address_line", "area_of", "branch_of", "client_prefix", "default_fill", "dense_position", "first_row", "full_name", "moment",
    "months_between_calendars", "plain_base64", "read_time", "round_half_up", "short_name", "write_time",
    "zero_if_null",
]
