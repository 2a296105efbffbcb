"""Typed projection of source records onto a declared layout."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnMapping:
    """Read ``source``, cast it to ``data_type``, call it ``target``."""

    source: str
    target: str
    data_type: str
    lower: bool = False


def check_mappings(mappings: Sequence[ColumnMapping]) -> None:
    repeated = sorted(
        name for name, uses in Counter(m.target for m in mappings).items() if uses > 1
    )
    if repeated:
        raise ValueError(f"mapped more than once: {', '.join(repeated)}")


def map_columns(
    frame: DataFrame,
    mappings: Sequence[ColumnMapping],
    additional_columns: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Project and cast; a failed cast or an absent source column becomes NULL."""
    check_mappings(mappings)
    present = set(frame.columns)

    def typed(mapping: ColumnMapping) -> Column:
        if mapping.source not in present:
            return F.lit(None).cast(mapping.data_type).alias(mapping.target)
        value = F.col(mapping.source).try_cast(mapping.data_type)
        return (F.lower(value) if mapping.lower else value).alias(mapping.target)

    audit = [value.alias(name) for name, value in (additional_columns or {}).items()]
    return frame.select(*[typed(mapping) for mapping in mappings], *audit)
