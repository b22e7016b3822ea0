"""Job specs: a dict names sources, range and steps; running it composes operators into one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.aggregate import Aggregation, bucket_aggregate, grouping_sets_aggregate
from adlake.operators.dedupe import dedupe
from adlake.operators.enrich import (
    Feature,
    FeatureJoin,
    FieldMapping,
    derived_columns,
    join_features,
    map_features,
    partition_columns,
    with_time_columns,
)
from adlake.operators.normalize import density_histograms, line_series
from adlake.operators.rolling import rolling_sums
from adlake.operators.timeseries import temporal_decay
from adlake.operators.training import TrainingTask, fit_task
from adlake.sources.ranges import TimeRange, lookback_hours, trim
from adlake.sources.tables import ColumnSpec, Source, read_source, write_table


@dataclass(frozen=True)
class Rolling:
    name: str
    lookback_seconds: int
    apply_to: Sequence[str]


@dataclass(frozen=True)
class EtlParams:
    group_by: Sequence[str]
    time_column: str
    time_bucket: str | None = "hour"
    aggregations: Sequence[Aggregation] = ()
    rolling_windows: Sequence[Rolling] = ()
    dedupe_by: Sequence[str] = ()
    dedupe_mode: str = "keep_first"
    dedupe_order: Sequence[str] = ()
    output_groupings: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def lookback(self) -> int:
        return lookback_hours([w.lookback_seconds for w in self.rolling_windows])


def etl(df: DataFrame, params: EtlParams, time_range: TimeRange | None = None) -> DataFrame:
    """Dedupe, bucket and aggregate, rolling sums, trim the history, add date and hour.

    ``df`` must already reach ``params.lookback`` hours before the range.
    """
    if params.dedupe_by:
        df = dedupe(df, params.dedupe_by, params.dedupe_mode, params.dedupe_order)
    if params.output_groupings:
        if params.rolling_windows:
            raise ValueError("several output groupings cannot share rolling windows")
        bucketed = df.withColumn("time_bucket", F.date_trunc(params.time_bucket, params.time_column).cast("timestamp_ntz"))
        sets = {name: ["time_bucket", *cols] for name, cols in params.output_groupings.items()}
        return partition_columns(trim(grouping_sets_aggregate(bucketed, sets, params.aggregations), time_range))
    if params.aggregations:
        df = bucket_aggregate(df, params.group_by, params.aggregations, params.time_column, params.time_bucket)
    elif params.time_column != "time_bucket":
        df = df.withColumn("time_bucket", F.date_trunc(params.time_bucket, params.time_column).cast("timestamp_ntz"))
    if params.rolling_windows:
        by_columns: dict[tuple, dict[str, int]] = {}
        for w in params.rolling_windows:
            by_columns.setdefault(tuple(w.apply_to), {})[w.name] = w.lookback_seconds
        for columns, windows in by_columns.items():
            df = rolling_sums(
                df, params.group_by, "time_bucket", windows, columns, one_row_per_time=bool(params.aggregations)
            )
    return partition_columns(trim(df, time_range))


def enrichment(
    base: DataFrame,
    feature_tables: Mapping[str, DataFrame],
    time_column: str,
    joins: Mapping[str, FeatureJoin],
    group_by: Sequence[str] = (),
    aggregations: Sequence[Aggregation] = (),
    output_columns: Sequence[str] | None = None,
    time_range: TimeRange | None = None,
    feature_time: str | None = None,
) -> DataFrame:
    """Time columns, aggregation of the base, feature joins, column list. The range's end day counts on both sides."""
    df = with_time_columns(base, time_column)
    if aggregations:
        df = df.groupBy(*group_by).agg(*[a.column(df) for a in aggregations])
    for name, spec in joins.items():
        df = join_features(df, feature_tables[name], spec, time_range, feature_time)
    return df.select(*output_columns) if output_columns else df


class SpecError(ValueError):
    pass


def check_spec(spec: Mapping[str, Any]) -> None:
    """References, lineage and mappings. Raises with every problem found."""
    problems: list[str] = []
    sources, features = spec.get("sources", {}), spec.get("features", {})
    for name, source in sources.items():
        for column, c in source.get("columns", {}).items():
            for feature in c.get("provides", ()):
                if feature not in features:
                    problems.append(f"source {name}: column {column} provides unknown feature {feature}")
    for name, job in spec.get("jobs", {}).items():
        source = sources.get(job["input"]["source"])
        if source is None:
            problems.append(f"job {name}: unknown source {job['input']['source']}")
            continue
        columns = source.get("columns", {})
        for m in job["input"].get("mappings", ()):
            if m["feature"] not in features:
                problems.append(f"job {name}: unknown feature {m['feature']}")
            elif columns and m["source_col"] not in columns:
                problems.append(f"job {name}: source has no column {m['source_col']}")
            elif columns and m["feature"] not in columns[m["source_col"]].get("provides", ()):
                problems.append(f"job {name}: column {m['source_col']} does not provide {m['feature']}")
        for join in job.get("params", {}).get("feature_joins", ()):
            if join["source"] not in sources:
                problems.append(f"job {name}: unknown feature source {join['source']}")
    if problems:
        raise SpecError("; ".join(problems))


def _source(raw: Mapping[str, Any], values: Mapping[str, str]) -> Source:
    columns = {n: ColumnSpec(**{**c, "provides": tuple(c.get("provides", ()))}) for n, c in raw.get("columns", {}).items()}
    return Source(
        path=raw["path"].format(**values),
        format=raw.get("format", "parquet"),
        columns=columns,
        partition_cols=tuple(raw.get("partition_cols", ())),
        time_column=raw.get("time_column"),
    )


def run_job(
    spark: SparkSession,
    spec: Mapping[str, Any],
    name: str,
    date_from: str | None = None,
    date_to: str | None = None,
    values: Mapping[str, str] | None = None,
    write: bool = True,
) -> DataFrame:
    """Run one job of a spec and write its output if it names one. ``values`` fill ``{name}`` places in paths."""
    check_spec(spec)
    values = values or {}
    job = spec["jobs"][name]
    given = job["input"].get("date_range", {})
    time_range = TimeRange(date_from or given.get("from"), date_to or given.get("to"))
    params = dict(job.get("params", {}))
    source = _source(spec["sources"][job["input"]["source"]], values)
    kind = job["type"]
    if kind == "etl":
        params["aggregations"] = [Aggregation(**a) for a in params.get("aggregations", ())]
        params["rolling_windows"] = [Rolling(**w) for w in params.get("rolling_windows", ())]
        typed = EtlParams(**params)
        out = etl(_load(spark, job, source, time_range, typed.lookback), typed, time_range)
    elif kind == "enrichment":
        raw_joins = params.pop("feature_joins", ())
        tables = {j["source"]: read_source(spark, _source(spec["sources"][j["source"]], values)) for j in raw_joins}
        joins = {j["source"]: FeatureJoin(**{k: v for k, v in j.items() if k != "source"}) for j in raw_joins}
        params["aggregations"] = [Aggregation(**a) for a in params.get("aggregations", ())]
        out = enrichment(
            _load(spark, job, source, time_range, 0), tables, joins=joins,
            time_column=params.pop("time_column", source.time_column), time_range=time_range, **params,
        )
    elif kind == "mapping":
        features = {n: Feature(**{k: tuple(v) if k == "allowed_values" else v for k, v in f.items()}) for n, f in spec["features"].items()}
        out = map_features(
            _load(spark, job, source, time_range, 0), [FieldMapping(**m) for m in job["input"]["mappings"]], features
        )
    elif kind == "training":
        task = TrainingTask(**{k: v for k, v in params.items() if k not in ("id_column", "model_path")})
        model, out = fit_task(_load(spark, job, source, time_range, 0), task, params["id_column"])
        if params.get("model_path") and write:
            model.write().overwrite().save(params["model_path"].format(**values))
    elif kind == "visualization":
        out = figure_data(_load(spark, job, source, time_range, 0), params, time_range)
    else:
        raise SpecError(f"job {name}: unknown type {kind}")
    target = job.get("output")
    if target and write:
        write_table(
            out, target["path"].format(**values), target.get("format", "parquet"), target.get("mode", "overwrite"),
            target.get("partition_by", ()),
        )
    return out


def figure_data(df: DataFrame, params: Mapping[str, Any], time_range: TimeRange | None = None) -> DataFrame:
    """Rows behind a figure: aggregate, derive, decay, then histogram or line data. Drawing is left to the caller."""
    if params.get("aggregations"):
        aggregations = [Aggregation(**a) for a in params["aggregations"]]
        df = df.groupBy(*params["group_by"]).agg(*[a.column(df) for a in aggregations])
    df = derived_columns(df, params.get("derived", {}))
    if decay := params.get("decay"):
        end = decay.get("end_date") or (time_range.end[:10] if time_range and time_range.end else None)
        df = temporal_decay(df, decay["rates"], decay["date"], end, decay.get("suffix", "_decayed"))
    figure = params["figure"]
    if figure["kind"] == "histogram":
        return density_histograms(df, figure["columns"], figure.get("bins", 50))
    if figure["kind"] == "line":
        return line_series(df, figure["x"], figure["y"])
    raise SpecError(f"unknown figure {figure['kind']}")


def _load(spark: SparkSession, job: Mapping[str, Any], source: Source, time_range: TimeRange, lookback: int) -> DataFrame:
    given = job["input"]
    return read_source(
        spark, source, time_range, lookback, given.get("filter_expr"), given.get("select_columns")
    )
