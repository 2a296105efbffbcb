"""Governed metrics: semantic models, metrics, saved queries and their translation to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.arithmetic import real_ratio
from tidewatt.operators.distinct import distinct_counts

TIME_GRAINS = ("hour", "day", "week", "month", "quarter", "year")
METRIC_TIME = "metric_time"
#: Aggregation of stored bitmaps (``operators.distinct``) in the columns of their own names.
MERGED_DISTINCT = "merged_distinct"


@dataclass(frozen=True)
class Entity:
    name: str
    kind: str
    expr: str


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: str | None = None

    def column(self) -> Column:
        return F.expr(self.expr or self.name)


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str

    def column(self) -> Column:
        value = F.expr(self.expr)
        if self.agg == "sum":
            return F.sum(value)
        if self.agg == "count":
            return F.count(value)
        if self.agg == "count_distinct":
            return F.count_distinct(value)
        if self.agg == "average":
            return real_ratio(F.sum(value), F.count(value))
        raise ValueError(f"unknown aggregation {self.agg!r}")


@dataclass(frozen=True)
class SemanticModel:
    name: str
    source: str
    entities: tuple[Entity, ...]
    dimensions: tuple[Dimension, ...] = ()
    measures: tuple[Measure, ...] = ()
    time_expr: str | None = None
    time_grain: str = "hour"

    def entity(self, name: str, kind: str | None = None) -> Entity | None:
        found = [e for e in self.entities if e.name == name and kind in (None, e.kind)]
        return found[0] if found else None

    def dimension(self, name: str) -> Dimension | None:
        found = [d for d in self.dimensions if d.name == name]
        return found[0] if found else None


@dataclass(frozen=True)
class Metric:
    """A measure, or the ratio of two other metrics."""

    name: str
    label: str
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None


@dataclass(frozen=True)
class SavedQuery:
    name: str
    label: str
    metrics: tuple[str, ...]
    group_by: tuple[str, ...]


METER_READINGS = SemanticModel(
    "meter_readings",
    "int_meter_readings",
    entities=(Entity("reading", "primary", "event_id"), Entity("meter", "foreign", "meter_id")),
    dimensions=(
        Dimension("schema_version"),
        Dimension("region", "us_region"),
        Dimension("state_code"),
    ),
    measures=(
        Measure("energy_consumed_kwh", "sum", "energy_kwh"),
        Measure("reading_count", "count", "event_id"),
        Measure("distinct_meter_count", "count_distinct", "meter_id"),
        Measure("average_voltage_v", "average", "voltage_v"),
        Measure("average_current_a", "average", "current_a"),
        Measure("average_power_factor", "average", "power_factor"),
    ),
    time_expr="event_time",
)
HOURLY_BILLING = SemanticModel(
    "hourly_energy_billing",
    "fact_hourly_energy_billing",
    entities=(
        Entity("meter_hour_bill", "primary", "meter_key || '|' || cast(reading_hour as string)"),
        Entity("meter", "foreign", "meter_key"),
        Entity("pricing_zone", "foreign", "pricing_zone_key"),
    ),
    measures=(
        Measure("billed_energy_amount_kwh", "sum", "energy_kwh"),
        Measure("usage_revenue_amount", "sum", "usage_revenue"),
        Measure("billed_meter_count", "count_distinct", "meter_key"),
    ),
    time_expr="reading_hour",
)
BILLING_METER = SemanticModel(
    "billing_meter_dimension",
    "dim_meter",
    entities=(Entity("meter", "primary", "meter_key"),),
    dimensions=(Dimension("meter_id"), Dimension("region", "us_region"), Dimension("state_code")),
)
BILLING_ZONE = SemanticModel(
    "billing_pricing_zone_dimension",
    "dim_pricing_zone",
    entities=(Entity("pricing_zone", "primary", "pricing_zone_key"),),
    dimensions=(Dimension("currency_code"),),
)
# Stored hours of plans.activity: distinct meters at any grain without a look at the readings.
METER_ACTIVITY = SemanticModel(
    "meter_activity",
    "meter_activity_hourly",
    entities=(Entity("activity", "primary", "bitmap_bucket"),),
    dimensions=(Dimension("region", "us_region"), Dimension("state_code")),
    measures=(Measure("active_meter_count", MERGED_DISTINCT, "bitmap"),),
    time_expr="activity_hour",
)
MODELS = (METER_READINGS, HOURLY_BILLING, BILLING_METER, BILLING_ZONE, METER_ACTIVITY)
METRICS = (
    Metric("total_energy_consumed_kwh", "Total Energy Consumed (kWh)", "energy_consumed_kwh"),
    Metric("total_readings", "Total Meter Readings", "reading_count"),
    Metric("reporting_meters", "Reporting Meters", "distinct_meter_count"),
    Metric("active_meters", "Active Meters", "active_meter_count"),
    Metric("avg_voltage_v", "Average Voltage (V)", "average_voltage_v"),
    Metric("avg_current_a", "Average Current (A)", "average_current_a"),
    Metric("avg_power_factor", "Average Power Factor", "average_power_factor"),
    Metric(
        "energy_per_reporting_meter_kwh",
        "Energy per Reporting Meter (kWh)",
        numerator="total_energy_consumed_kwh",
        denominator="reporting_meters",
    ),
    Metric("billed_energy_kwh", "Billed Energy (kWh)", "billed_energy_amount_kwh"),
    Metric("usage_revenue", "Usage Revenue", "usage_revenue_amount"),
    Metric("billed_meters", "Billed Meters", "billed_meter_count"),
    Metric(
        "realized_usage_price_per_kwh",
        "Realized Usage Price per kWh",
        numerator="usage_revenue",
        denominator="billed_energy_kwh",
    ),
)
SAVED_QUERIES = (
    SavedQuery(
        "daily_meter_kpis",
        "Daily Smart Meter KPIs",
        ("total_energy_consumed_kwh", "total_readings", "reporting_meters", "avg_voltage_v",
         "avg_power_factor"),
        ("reading__region", "reading__state_code", "metric_time__day"),
    ),
    SavedQuery(
        "meter_electrical_kpis",
        "Meter Electrical KPIs",
        ("total_energy_consumed_kwh", "total_readings", "avg_voltage_v", "avg_power_factor"),
        ("meter", "metric_time__day"),
    ),
    SavedQuery(
        "daily_regional_billing_kpis",
        "Daily Regional Billing KPIs",
        ("billed_energy_kwh", "usage_revenue", "billed_meters", "realized_usage_price_per_kwh"),
        ("meter__region", "meter__state_code", "metric_time__day"),
    ),
)


Table = DataFrame | Callable[[], DataFrame]


class MetricLayer:
    """Semantic models bound to tables, or to functions called when a query needs the table."""

    def __init__(
        self,
        tables: Mapping[str, Table],
        models: Sequence[SemanticModel] = MODELS,
        metrics: Sequence[Metric] = METRICS,
        saved_queries: Sequence[SavedQuery] = SAVED_QUERIES,
    ) -> None:
        self.tables = tables
        self.models = tuple(models)
        self.metrics = {metric.name: metric for metric in metrics}
        self.saved = {query.name: query for query in saved_queries}

    def _table(self, name: str) -> DataFrame:
        table = self.tables[name]
        return table if isinstance(table, DataFrame) else table()

    def saved_query(self, name: str) -> DataFrame:
        query = self.saved[name]
        return self.query(query.metrics, query.group_by)

    def query(
        self,
        metrics: Sequence[str],
        group_by: Sequence[str] = (),
        where: Mapping[str, Callable[[Column], Column]] | None = None,
    ) -> DataFrame:
        """Metrics by ``entity__dimension``, ``entity`` or ``metric_time__<grain>``.

        ``where`` filters rows before they are aggregated: name -> predicate on that column.
        Each model is aggregated once; results of several models meet on the group columns.
        """
        needed = self._measures(metrics)
        parts = [
            self._aggregate(model, measures, tuple(group_by), dict(where or {}))
            for model, measures in needed
        ]
        merged = reduce(lambda left, right: _combine(left, right, group_by), parts)
        return merged.select(*group_by, *[self._value(name).alias(name) for name in metrics])

    def _leaves(self, name: str) -> list[str]:
        metric = self.metrics[name]
        if metric.measure is not None:
            return [metric.measure]
        return self._leaves(metric.numerator) + self._leaves(metric.denominator)

    def _measures(self, metrics: Sequence[str]) -> list[tuple[SemanticModel, list[Measure]]]:
        wanted = dict.fromkeys(leaf for name in metrics for leaf in self._leaves(name))
        found = []
        for model in self.models:
            own = [measure for measure in model.measures if measure.name in wanted]
            if own:
                found.append((model, own))
        return found

    def _value(self, name: str) -> Column:
        metric = self.metrics[name]
        if metric.measure is not None:
            return F.col(metric.measure)
        return real_ratio(self._value(metric.numerator), self._value(metric.denominator))

    def _owner(self, model: SemanticModel, entity: str, dimension: str) -> SemanticModel:
        """Model that owns a dimension: this one, or one whose primary entity is referenced here
        by the same expression. Equal entity names over different values are refused."""
        if model.entity(entity, "primary") and model.dimension(dimension):
            return model
        local = model.entity(entity)
        if local is None:
            raise ValueError(f"{model.name} has no entity {entity!r}")
        owners = [
            other
            for other in self.models
            if other is not model and other.entity(entity, "primary") and other.dimension(dimension)
        ]
        matching = [other for other in owners if other.entity(entity).expr == local.expr]
        if not matching:
            raise ValueError(
                f"{entity}__{dimension} cannot be reached from {model.name}: "
                + ("the entity is built from another expression" if owners else "no such dimension")
            )
        return matching[0]

    def _aggregate(
        self,
        model: SemanticModel,
        measures: Sequence[Measure],
        group_by: tuple[str, ...],
        where: dict[str, Callable[[Column], Column]],
    ) -> DataFrame:
        frame = self._table(model.source)
        local: dict[str, Column] = {}
        joined: dict[str, tuple[SemanticModel, dict[str, Column]]] = {}
        for name in dict.fromkeys([*group_by, *where]):
            entity, _, dimension = name.partition("__")
            if entity == METRIC_TIME:
                if dimension not in TIME_GRAINS:
                    raise ValueError(f"unknown time grain {dimension!r}")
                local[name] = F.date_trunc(dimension, F.expr(model.time_expr))
            elif not dimension:
                if model.entity(entity) is None:
                    raise ValueError(f"{model.name} has no entity {entity!r}")
                local[name] = F.expr(model.entity(entity).expr)
            else:
                owner = self._owner(model, entity, dimension)
                column = owner.dimension(dimension).column()
                if owner is model:
                    local[name] = column
                else:
                    joined.setdefault(entity, (owner, {}))[1][name] = column
        frame = frame.withColumns(local) if local else frame
        for entity, (owner, columns) in joined.items():
            key = f"__{entity}"
            dims = self._table(owner.source).select(
                F.expr(owner.entity(entity).expr).alias(key),
                *[column.alias(name) for name, column in columns.items()],
            )
            frame = frame.withColumn(key, F.expr(model.entity(entity).expr)).join(
                dims, key, "left"
            )
        for name, predicate in where.items():
            frame = frame.filter(predicate(F.col(name)))
        merged = [measure for measure in measures if measure.agg == MERGED_DISTINCT]
        plain = [measure for measure in measures if measure.agg != MERGED_DISTINCT]
        parts = [distinct_counts(frame, group_by, measure.name) for measure in merged]
        if plain:
            parts.append(frame.groupBy(*group_by).agg(*[measure.column().alias(measure.name) for measure in plain]))
        return reduce(lambda left, right: _combine(left, right, group_by), parts)


def _combine(left: DataFrame, right: DataFrame, group_by: Sequence[str]) -> DataFrame:
    if not group_by:
        # Two one-row totals.
        return left.select("*", *[
            right.select(name).scalar().alias(name) for name in right.columns
        ])
    a, b = left.alias("a"), right.alias("b")
    on = [F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}")) for name in group_by]
    keys = [F.coalesce(f"a.{name}", f"b.{name}").alias(name) for name in group_by]
    values = [f"a.{name}" for name in left.columns if name not in group_by]
    values += [f"b.{name}" for name in right.columns if name not in group_by]
    return a.join(b, on, "full_outer").select(*keys, *values)
