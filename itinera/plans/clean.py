"""Booking cleaner: accepted route rows, rejected rows with reasons, metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itinera.functions import flights as fl
from itinera.functions.text import blank_to_null
from itinera.operators.dedupe import dedupe_segments, flag_known, flag_repeats, pruned_target
from itinera.operators.filters import any_slot_in_range
from itinera.operators.profile import reconcile, rejection_summary
from itinera.operators.reshape import legs_of, widen_route, with_slots
from itinera.operators.segment import by_time, routes_anchored
from itinera.session import scratch_path
from itinera.spec import SourceSpec

ROUTE_NO = "route_no"
_EMPTY_SLOT = (fl.NUMBER_NULL, fl.DATE_NULL, fl.BOTH_NULL, fl.NUMBER_EMPTY)


@dataclass(frozen=True)
class CleanResult:
    """Outputs of one cleaning run, read from its stored rows."""

    source: DataFrame
    accepted: DataFrame
    rejected: DataFrame

    def summary(self) -> DataFrame:
        return rejection_summary(self.rejected)

    def reconciliation(self) -> DataFrame:
        return reconcile(self.source, self.accepted, self.rejected)


def stage_rows(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add ``__routes`` (arrays of valid legs by date, none for a rejected row) and ``__failure`` (array of at most one reason
    and detail). No shuffle.

    Both outputs are arrays that are exploded later: a filter on the reason would be pushed below these projections
    and repeat their expressions.
    """
    staged = with_slots(df, spec, "__slots")
    dates = [F.get("__slots", F.lit(i))["dt"] for i in range(spec.slots)]
    # an empty later slot is no failure; everything else is
    failed = F.filter(
        "__slots",
        lambda s: s["reason"].isNotNull() & ~((s["slot"] > 1) & s["reason"].isin(*_EMPTY_SLOT)),
    )
    staged = staged.withColumns(
        {
            "__in_range": any_slot_in_range(dates, spec.year_min, spec.year_max),
            "__valid": by_time(legs_of("__slots")),
            "__failed": failed,
        }
    )
    listed = F.array_join(
        F.transform(
            "__failed", lambda s: F.concat(F.lit("FltNo"), s["slot"].cast("string"), F.lit("("), s["reason"], F.lit(")"))
        ),
        ", ",
    )
    note = lambda reason, detail: F.array(F.struct(reason.alias("reason"), detail.alias("detail")))
    failure = (
        F.when(
            ~F.col("__in_range"),
            note(F.lit(fl.INVALID_DATE_RANGE), F.lit(f"All dates outside {spec.year_min}-{spec.year_max}")),
        )
        .when(F.size("__valid") > 0, F.array().cast("array<struct<reason:string,detail:string>>"))
        .when(
            F.size("__failed") > 0,
            note(F.get("__failed", F.lit(0))["reason"], F.concat(F.lit("No valid segments. Slots: "), listed)),
        )
        .otherwise(note(F.lit(fl.NO_VALID_SEGMENTS), F.lit("All flight slots null or invalid")))
    )
    legs = F.when(F.col("__in_range"), F.col("__valid"))
    staged = staged.withColumns({"__failure": failure, "__sorted": legs})
    staged = staged.withColumn("__legs", dedupe_segments(F.col("__sorted")))
    # cut here and not by the readers: the stored rows are read several times
    return staged.withColumn("__routes", routes_anchored(F.col("__legs"), spec.route_hours * 3600)).drop(
        "__slots", "__failed", "__valid", "__in_range", "__sorted", "__legs"
    )


def failed_rows(staged: DataFrame, spec: SourceSpec, row_id: str) -> DataFrame:
    """Rejected source rows as text, with reason and detail."""
    raw = [F.col(f"`{c}`").cast("string").alias(c) for c in spec.columns]
    rows = staged.select(row_id, *raw, F.inline(F.slice("__failure", 1, 1)))
    return rows.select(
        row_id,
        F.lit(None).cast("int").alias(ROUTE_NO),
        *[f"`{c}`" for c in spec.columns],
        F.col("reason").alias("RejectionReason"),
        F.col("detail").alias("RejectionDetail"),
    )


def route_rows(staged: DataFrame, spec: SourceSpec, row_id: str) -> DataFrame:
    """One wide row per route of the rows that passed, keyed by (row id, route number), with the raw row kept."""
    text = {f.name for f in staged.schema.fields if isinstance(f.dataType, T.StringType)}
    raw = F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in spec.columns]).alias("__raw")
    rows = staged.select(
        row_id, *[F.col(f"`{c}`") for c in spec.base], raw, F.posexplode("__routes").alias("__pos", "__route")
    ).withColumn(ROUTE_NO, F.col("__pos") + 1)
    wide = widen_route(F.col("__route"), spec.slots, spec.number, spec.date, spec.airport_names)
    clean = lambda name, c: blank_to_null(c) if name in text else c
    out = [F.col(row_id), F.col(ROUTE_NO), *[clean(c, F.col(f"`{c}`")).alias(c) for c in spec.base]]
    for name, value in wide.items():
        out.append((value if name in spec.date_names else blank_to_null(value)).alias(name))
    return rows.select(*out, "__raw")


def turned_down(
    rows: DataFrame, spec: SourceSpec, row_id: str, target: DataFrame | None, trim_equal: Sequence[str], prune: bool = False
) -> DataFrame:
    """(row id, route number, status) of the routes that are not accepted; only key columns are read and shuffled."""
    keys = list(dict.fromkeys([*spec.key_columns, *(spec.target_key_columns if target is not None else ())]))
    narrow = rows.select(row_id, ROUTE_NO, *[F.col(f"`{k}`") for k in keys if k not in (row_id, ROUTE_NO)])
    flagged = flag_repeats(narrow, spec.key_columns, [row_id, ROUTE_NO], "__repeat")
    status = F.when(F.col("__repeat"), fl.BATCH_DUPLICATE)
    if target is not None:
        # the run's keys by themselves: the flagged rows have the same ones behind a join
        near = pruned_target(narrow, target, spec.target_key_columns, trim_equal) if prune else target
        flagged = flag_known(flagged, near, spec.target_key_columns, "__known", trim_equal)
        status = status.when(F.col("__known"), fl.TARGET_CONFLICT)
    return flagged.select(row_id, ROUTE_NO, status.alias("__status")).filter(F.col("__status").isNotNull())


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def clean_bookings(
    df: DataFrame,
    spec: SourceSpec,
    row_id: str,
    target: DataFrame | None = None,
    trim_equal: Sequence[str] = (),
    rejected_at: Column | None = None,
) -> CleanResult:
    """Clean one extract against the rows already in the target. Eager: the parsed rows and the labels of the routes turned
    down are written once, below the checkpoint folder, and all outputs read them.

    ``row_id`` must be unique. Duplicates inside this run are ``BATCH DUPLICATE`` (the lowest row id and route number
    stays), keys already in the target are ``DB UNIQUE VIOLATION``. Keys compare null-safe; ``trim_equal`` names key
    columns that compare trimmed and never match on null.
    """
    # one pass over the input; routes, failures and labels each read what they need of the stored rows
    return clean_staged(df, _stored(stage_rows(df, spec), "staged"), spec, row_id, target, trim_equal, rejected_at)


def clean_staged(
    source: DataFrame,
    staged: DataFrame,
    spec: SourceSpec,
    row_id: str,
    target: DataFrame | None = None,
    trim_equal: Sequence[str] = (),
    rejected_at: Column | None = None,
    prune: bool = False,
) -> CleanResult:
    """The same for rows that :func:`stage_rows` has parsed and that are stored. ``prune`` is for a target much larger than the
    extract: only its rows that may hold a key of the extract are shuffled."""
    routes, failed = route_rows(staged, spec, row_id), failed_rows(staged, spec, row_id)
    labels = _stored(turned_down(routes, spec, row_id, target, trim_equal, prune), "labels")
    detail = F.when(F.col("__status") == fl.BATCH_DUPLICATE, "Duplicate within batch").otherwise(
        "Composite key already in target"
    )
    repeated = routes.join(labels, [row_id, ROUTE_NO]).select(
        row_id,
        ROUTE_NO,
        *[F.col("__raw").getField(c).alias(c) for c in spec.columns],
        F.col("__status").alias("RejectionReason"),
        detail.alias("RejectionDetail"),
    )
    stamp = rejected_at if rejected_at is not None else F.lit(None).cast("timestamp_ntz")
    rejected = failed.unionByName(repeated).withColumn("RejectedAt", stamp)
    accepted = routes.drop("__raw").join(labels, [row_id, ROUTE_NO], "left_anti")
    return CleanResult(source, accepted, rejected)
