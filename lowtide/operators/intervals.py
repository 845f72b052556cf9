"""Date-window primitives that never pair rows of one patient with each other.

Two shapes cover every window rule of the metrics:

``exists_within``   is there an event at most N days before this row?
``prior_summary``   aggregates over all events up to this row (count, first, last).

A join on the patient with a date residual would produce visits x claims rows
per patient and put a hot patient into one task. Both primitives first reduce
the events with map-side combining and then work on parts of a patient's time.

``exists_within`` cuts time into buckets; where a patient has many rows in one
bucket, ``skew.Deal`` splits them. ``prior_summary`` and ``neighbours`` are prefix
scans over ranges of (patient, time): the ranges are calendar days, each is
folded once in one pass over the input, one edge row a day carries the state of
the days before, and a second pass over the folded rows adds the two. A patient
of any size spreads over as many tasks as days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lowtide.functions.dates import DAY_MICROS
from lowtide.operators.skew import Deal, join_facts
from lowtide.sources.sinks import stage


def _bucket(at: Column, span_days: Column) -> Column:
    micros, width = F.unix_micros(at), span_days.cast("long") * DAY_MICROS
    return ((micros - F.pmod(micros, width)) / width).cast("long")


def exists_within(rows: DataFrame, events: DataFrame, keys: list[str], span_days: Column, flag: str,
                  at: str = "TEST_DATE", event_at: str = "at", open_end: bool = False, by: Deal | None = None) -> DataFrame:
    """Add ``flag``: an event with the same keys lies in ``[at - span, at]``.

    ``open_end`` leaves out events exactly ``span`` days old. ``span_days`` must
    be computable on both sides. Time is cut into buckets one span wide; a row
    then needs only the first event of its own bucket and the last event of the
    bucket before, so each event bucket shrinks to one line and the join is an
    equi-join with at most one partner. ``by`` deals the rows of heavy keys.
    """
    bucket = _bucket(F.col(event_at), span_days)
    slots = F.array(
        F.struct(bucket.alias("_b"), F.col(event_at).alias("_own"), F.lit(None).cast("timestamp").alias("_old")),
        F.struct((bucket + 1).alias("_b"), F.lit(None).cast("timestamp").alias("_own"), F.col(event_at).alias("_old")),
    )
    lines = (
        events.filter(F.col(event_at).isNotNull())
        .select(*keys, F.inline(slots))
        .groupBy(*keys, "_b")
        .agg(F.min("_own").alias("_own"), F.max("_old").alias("_old"))
    )
    oldest = F.unix_micros(F.col(at)) - span_days.cast("long") * DAY_MICROS
    old = F.unix_micros("_old")
    hit = (F.col("_own") <= F.col(at)) | ((old > oldest) if open_end else (old >= oldest))
    return (join_facts(rows.withColumn("_b", _bucket(F.col(at), span_days)), lines, [*keys, "_b"], "left", by)
            .withColumn(flag, F.coalesce(hit, F.lit(False)))
            .drop("_b", "_own", "_old"))


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def prior_summary(rows: DataFrame, events: DataFrame, keys: list[str], measures: dict[str, tuple[str, Column]],
                  at: str = "TEST_DATE", event_at: str = "at", strict: bool = False) -> DataFrame:
    """Add one column per measure: its aggregate over events up to ``at``.

    ``measures`` maps a new column to (``sum`` | ``min`` | ``max``, expression on
    the events). Rows and events of one key and day are folded in time order,
    read once; the last row of a day holds the day's total, and the totals of
    the days before are added from one line a day. ``strict`` leaves out events
    at the very same instant.
    """
    reduced = events.groupBy(*keys, F.col(event_at).alias("_at")).agg(
        *[_MERGE[how](expr).alias(name) for name, (how, expr) in measures.items()])
    names = list(measures)
    carried = [c for c in rows.columns if c not in keys]
    kinds = dict(zip([f.name for f in reduced.schema], [f.dataType for f in reduced.schema]))
    event_first = F.lit(2 if strict else 0).alias("_kind")
    row_types = {f.name: f.dataType for f in rows.schema}
    stream = reduced.select(*keys, "_at", event_first, *names,
                            *[F.lit(None).cast(row_types[c]).alias(c) for c in carried]).unionByName(
        rows.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                    *[F.lit(None).cast(kinds[n]).alias(n) for n in names], *carried))
    stream = stream.withColumn("_day", F.to_date("_at"))

    in_order = W.partitionBy(*keys, "_day").orderBy("_at", "_kind")
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    folded = stream.select(*keys, "_day", "_kind", *carried, F.lead("_kind").over(in_order).isNull().alias("_edge"),
                           *[_MERGE[how](F.col(n)).over(so_far).alias(n) for n, (how, _) in measures.items()])
    # events inside a day have done their part
    folded = stage(folded.filter("_kind = 1 or _edge"), "folded")

    before = W.partitionBy(*keys).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    carry = folded.filter("_edge").select(*keys, "_day", *[_MERGE[how](F.col(n)).over(before).alias(f"_pre_{n}")
                                                           for n, (how, _) in measures.items()])

    def merged(name: str, how: str) -> Column:
        now, past = F.col(name), F.col(f"_pre_{name}")
        if how == "sum":
            return F.coalesce(now, F.lit(0)) + F.coalesce(past, F.lit(0))
        return (F.least if how == "min" else F.greatest)(now, past)

    return folded.filter("_kind = 1").join(carry, [*keys, "_day"], "left").select(
        *rows.columns, *[merged(n, how).alias(n) for n, (how, _) in measures.items()])


def neighbours(events: DataFrame, key: str, at: str) -> DataFrame:
    """Gap in days to the previous and to the next event of the same key.

    Inside a day by ``lag``/``lead`` on (key, day), read once; across days from
    the day's first and last event, one line per (key, day).
    """
    dated = events.withColumn("_day", F.to_date(at))
    in_day = W.partitionBy(key, "_day").orderBy(at, *[c for c in events.columns if c not in (key, at)])
    near = stage(dated.select("*", F.lag(at).over(in_day).alias("_prev"), F.lead(at).over(in_day).alias("_next")), "folded")
    by_day = W.partitionBy(key).orderBy("_day")
    ends = near.filter("_prev is null or _next is null").groupBy(key, "_day").agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    ends = ends.select(key, "_day", F.lag("_last").over(by_day).alias("_before"),
                       F.lead("_first").over(by_day).alias("_after"))
    joined = near.join(ends, [key, "_day"])
    micros = float(DAY_MICROS)
    here = F.unix_micros(at)
    return joined.select(
        *events.columns,
        ((F.unix_micros(F.coalesce("_next", "_after")) - here) / micros).alias("to_next"),
        ((here - F.unix_micros(F.coalesce("_prev", "_before"))) / micros).alias("since_last"),
    )


#: Mirror point for looking forward in time with the same machinery (year 2200).
_MIRROR = 2 * 3_629_059_200_000_000


def _mirrored(at: Column) -> Column:
    return F.timestamp_micros(F.lit(_MIRROR) - F.unix_micros(at))


def following_summary(rows: DataFrame, events: DataFrame, keys: list[str], measures: dict[str, tuple[str, Column]],
                      at: str = "TEST_DATE", event_at: str = "at", strict: bool = True) -> DataFrame:
    """``prior_summary`` over the events after ``at``."""
    flipped = rows.withColumn("_when", _mirrored(F.col(at)))
    ahead = events.withColumn("_when", _mirrored(F.col(event_at)))
    return prior_summary(flipped, ahead, keys, measures, at="_when", event_at="_when", strict=strict).drop("_when")
