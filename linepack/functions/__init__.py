"""Column functions: one rule each, all native expressions except ``batch``."""

from .codes import cycle_rank, mapped, nn_flow, oa_flow, sg_direction, sg_flow
from .keys import gf_loc_id, gf_number, loc_id, pipe_id, pipe_of_gf_loc_id, signed
from .lift import batch
from .text import (
    date_of_posting,
    file_safe,
    last_part,
    null_or_empty,
    pipe_label,
    pipe_of_posting,
    post_time_of_posting,
    posting_name,
    read_path,
    strip,
    unit_of_posting,
    without_null_marks,
    zfill,
)
from .values import (
    day_text,
    gas_month,
    nn_day,
    nn_posting_day,
    number,
    oa_day,
    quantity,
    seconds_between,
)

__all__ = [
    "batch", "cycle_rank", "date_of_posting", "day_text", "file_safe", "gas_month", "gf_loc_id",
    "gf_number", "last_part", "loc_id", "mapped", "nn_day", "nn_flow", "nn_posting_day",
    "null_or_empty", "number", "oa_day", "oa_flow", "pipe_id", "pipe_label",
    "pipe_of_gf_loc_id", "pipe_of_posting", "post_time_of_posting", "posting_name", "quantity", "read_path", "seconds_between",
    "sg_direction", "sg_flow", "signed", "strip", "unit_of_posting", "without_null_marks", "zfill",
]
