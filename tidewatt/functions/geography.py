"""Region lookup of the 51 supported states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatt.contracts import REGION_BY_STATE


def region_of(state_code: Column) -> Column:
    """Region of a state as a literal map lookup; NULL for an unknown code."""
    pairs = [F.lit(part) for item in REGION_BY_STATE.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), state_code)
