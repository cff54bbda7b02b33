"""Event masking: date windows around coded events, and removal of observations inside them."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortweave.functions.values import as_date, strip
from cohortweave.operators.codes import dotted_children, match_codes, pattern_keys
from cohortweave.runtime import local_table, quoted, settle

log = logging.getLogger(__name__)

INTERVAL_COLUMNS = ("sample_ID", "event_type", "window_start", "window_end")

# Runs of 2**22 days hold all dates.
TOP_LEVEL = 22

# Sizes of the runs of days that windows are filed under, as powers of two. Two of the last hold all days that a date can name.
LEVELS = (4, 8, 12, 16, 20, 24, 28, 31)


@dataclass(frozen=True)
class EventDefinition:
    name: str
    source: str
    codes: tuple[str, ...]
    offset_before: int = 0
    offset_after: int = 0


EVENT_COLUMNS = {"event_type": pa.string(), "code": pa.string(), "source": pa.string(), "offset_before": pa.int32(), "offset_after": pa.int32()}


def event_table(spark: SparkSession, events: Iterable[EventDefinition] | DataFrame) -> DataFrame:
    """Event definitions as a table, one row per (event, code); a table is taken as it is."""
    if isinstance(events, DataFrame):
        return events.select(*[F.col(c).cast("int" if c.startswith("offset") else "string").alias(c) for c in EVENT_COLUMNS])
    rows = [(e.name, str(c), e.source, int(e.offset_before), int(e.offset_after)) for e in events for c in e.codes]
    return local_table(spark, {name: [r[i] for r in rows] for i, name in enumerate(EVENT_COLUMNS)}, EVENT_COLUMNS)


def event_code_select(long: DataFrame, events: Iterable[EventDefinition] | DataFrame, raw_prefix: bool = True) -> DataFrame:
    """Rows of `long` that mark an event, with event_type, offset_before and offset_after.

    `long` names the coded phenotype of each row in `source`; `events` are definitions or a table of any size, as
    `event_definitions_from_table` gives it. The distinct codes meet the patterns of all events at once and a row appears once per
    event it marks. By default every listed code also matches as a plain prefix.
    """
    listed = event_table(long.sparkSession, events).withColumn("code", strip(F.col("code"))).where("code <> ''")
    ways = [pattern_keys(dotted_children(F.col("code")))]
    if raw_prefix:
        ways.append(F.struct(F.col("code").alias("key"), (F.char_length("code") > 1).alias("is_prefix")))
    patterns = listed.select("event_type", "offset_before", "offset_after", F.col("source").alias("pattern_source"), F.inline(F.array(*ways))).distinct()
    coded = long.withColumn("_code", F.col("value").cast("string"))
    met = match_codes(coded.select("source", F.col("_code").alias("code")).distinct(), patterns)
    met = met.toDF("_source", "_met", "event_type", "offset_before", "offset_after")
    joined = coded.join(met, (F.col("source") == F.col("_source")) & (F.col("_code") == F.col("_met")))
    return joined.select(*[quoted(c) for c in long.columns], "event_type", "offset_before", "offset_after")


def event_windows(marked: DataFrame) -> DataFrame:
    """One window per marked row; rows whose date cannot be read are dropped."""
    day = as_date(marked, "occurrence_date")
    return marked.where(day.isNotNull() & F.col("sample_ID").isNotNull()).select(
        "sample_ID", "event_type",
        F.date_add(day, F.col("offset_before")).alias("window_start"),
        F.date_add(day, F.col("offset_after")).alias("window_end"),
    )


def merge_intervals(windows: DataFrame, keys: Iterable[str] = ("sample_ID", "event_type")) -> DataFrame:
    """Union of the windows of each key as disjoint windows; shared end days merge, next days do not.

    Equal starts are folded first, on the map side: it makes the order below unambiguous and bounds
    a group by the number of calendar days, however many rows its sample has.
    """
    keys = list(keys)
    starts = windows.groupBy(*keys, "window_start").agg(F.max("window_end").alias("window_end"))
    ordered = W.partitionBy(*keys).orderBy("window_start")
    reached = F.max("window_end").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("window_start") <= reached, 0).otherwise(1)
    islands = starts.withColumn("_opens", opens).withColumn(
        "_island", F.sum("_opens").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return islands.groupBy(*keys, "_island").agg(
        F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end")).drop("_island")


def mask_intervals(long: DataFrame, events: Iterable[EventDefinition] | DataFrame, raw_prefix: bool = True) -> DataFrame:
    """Merged windows of all events: (sample_ID, event_type, window_start, window_end)."""
    return merge_intervals(event_windows(event_code_select(long, events, raw_prefix))).select(*INTERVAL_COLUMNS)


def events_without_windows(intervals: DataFrame, events: Iterable[EventDefinition] | DataFrame) -> DataFrame:
    """Names of the events no code matched."""
    names = event_table(intervals.sparkSession, events).select("event_type").distinct()
    return names.join(intervals.select("event_type").distinct(), "event_type", "left_anti")


def _checked_intervals(intervals: DataFrame) -> DataFrame:
    missing = set(INTERVAL_COLUMNS) - set(intervals.columns)
    if missing:
        raise ValueError(f"mask intervals lack the columns {sorted(missing)}")
    return intervals.select(
        "sample_ID", "event_type",
        as_date(intervals, "window_start").alias("window_start"),
        as_date(intervals, "window_end").alias("window_end"),
    ).where(F.col("window_start") <= F.col("window_end"))


def mask_event_types(intervals: DataFrame, event_types: Iterable[str]) -> DataFrame:
    """Windows of the wanted events, merged over event types: (sample_ID, window_start, window_end)."""
    wanted = _checked_intervals(intervals).where(F.col("event_type").isin(*event_types))
    return merge_intervals(wanted.select("sample_ID", "window_start", "window_end"), ["sample_ID"])


def _nodes(start: Column, end: Column) -> Column:
    """The fewest aligned runs of 2**level days that cover the days from `start` to `end`: array of (level, node).

    At each level at most one run is taken at either end, so a window of n days has at most 2 log2(n) of them.
    """
    low, above = F.unix_date(start), F.unix_date(end) + 1

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), level)
        first, last = F.call_function("shiftright", low + size - 1, level), F.call_function("shiftright", above, level)
        run = lambda taken, node: F.when((first < last) & taken, F.struct(level.alias("level"), node.alias("node")))
        odd = lambda n: n.bitwiseAND(F.lit(1)) == 1
        return F.array(run(odd(first), first), run(odd(last), last - 1))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(TOP_LEVEL)), at)))


def _places(start: Column, end: Column) -> Column:
    """The one or two aligned runs of days that a window lies in: array of (level, node), the run having 2**level days.

    The level is the smallest of LEVELS whose runs are no shorter than the window. Disjoint windows of a level are longer than
    a sixteenth of its run (but for the lowest), so that at most some seventeen meet in a run.
    """
    length = F.date_diff(end, start) + 1
    level = F.lit(LEVELS[-1])
    for n in reversed(LEVELS[:-1]):
        level = F.when(length <= 1 << n, n).otherwise(level)
    run = lambda day: F.struct(level.alias("level"), F.call_function("shiftright", F.unix_date(day), level).alias("node"))
    return F.array_distinct(F.array(run(start), run(end)))


def _outside(long: DataFrame, windows: DataFrame, extra: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows of `long` in no window of their sample; `extra` tests a row against the event types of the windows on its day.

    A window is filed under the runs of days it lies in, two rows at most whatever its length, and the distinct (sample, day) pairs
    are looked up in the runs of the sizes that occur; they meet by equality and are then compared, so the days of a huge sample
    spread. The rows then meet the masked days by equality. The filed windows are written once, as the sizes are asked of them first.
    """
    types = F.col("event_type") if "event_type" in windows.columns else F.lit("")
    filed = settle(windows.select(
        F.col("sample_ID").alias("_s"), types.alias("_type"), F.col("window_start").alias("_from"), F.col("window_end").alias("_to"),
        F.inline(_places(F.col("window_start"), F.col("window_end")))))
    levels = filed.agg(F.collect_set("level").alias("levels")).scalar()
    left = long.withColumn("_day", as_date(long, "occurrence_date"))
    days = left.where("_day IS NOT NULL AND sample_ID IS NOT NULL").select(F.col("sample_ID").alias("_s"), "_day").distinct()
    place = lambda n: F.struct(n.alias("level"), F.call_function("shiftright", F.unix_date("_day"), n).alias("node"))
    near = days.withColumn("_levels", levels).select("_s", "_day", F.inline(F.transform("_levels", place))).join(filed, ["_s", "level", "node"])
    hits = near.where("_day BETWEEN _from AND _to").select("_s", F.col("_day").alias("_hit"), "_type").distinct()
    inside = (F.col("sample_ID") == F.col("_s")) & (F.col("_day") == F.col("_hit"))
    if extra is not None:
        inside = inside & extra(F.array("_type"))
    return left.join(hits, inside, "left_anti").drop("_day")


def _maskable(long: DataFrame, spare_synthetic: bool) -> Column:
    if spare_synthetic and "date_is_synthetic" in long.columns:
        return ~F.col("date_is_synthetic")
    return F.lit(True)


def apply_mask(long: DataFrame, intervals: DataFrame, event_types: Iterable[str],
               has_dates: bool = True, spare_synthetic: bool = False) -> DataFrame:
    """Drop rows dated inside a window of the wanted events, both ends included.

    Rows without a readable date stay. A phenotype without real dates (`has_dates=False`) passes
    unchanged; `spare_synthetic` exempts single rows marked `date_is_synthetic`.
    """
    if not has_dates:
        log.warning("mask skipped: all dates come from the reference date")
        return long
    missing = {"sample_ID", "occurrence_date"} - set(long.columns)
    if missing:
        raise ValueError(f"long table lacks the columns {sorted(missing)}")
    windows = mask_event_types(intervals, list(event_types))
    return _outside(long, windows, (lambda types: _maskable(long, True)) if spare_synthetic else None)


def apply_mask_batch(long: DataFrame, intervals: DataFrame, opt_in: dict[str, Iterable[str]],
                     owner_col: str = "phenotype", spare_synthetic: bool = False) -> DataFrame:
    """Mask many phenotypes at once; `opt_in` names the events of each.

    The input is read once. Each row carries the list of events of its phenotype, so the windows are
    not multiplied by the number of phenotypes; a phenotype that did not opt in has none and matches nothing.
    """
    opt_in = {name: list(events) for name, events in opt_in.items() if events}
    if not opt_in:
        return long
    chosen = local_table(
        long.sparkSession, {"_owner": list(opt_in), "_events": list(opt_in.values())},
        {"_owner": pa.string(), "_events": pa.list_(pa.string())})
    rows = long.join(chosen, F.col(owner_col) == F.col("_owner"), "left").drop("_owner")
    wanted = sorted({e for events in opt_in.values() for e in events})
    windows = _checked_intervals(intervals).where(F.col("event_type").isin(*wanted))
    windows = merge_intervals(windows, ["sample_ID", "event_type"])
    own = lambda types: F.arrays_overlap("_events", types)
    extra = (lambda types: own(types) & _maskable(long, True)) if spare_synthetic else own
    return _outside(rows, windows, extra).select(*[quoted(c) for c in long.columns])


def event_definitions_from_table(codes: DataFrame, source: str = "ICD10", offset_before: int = -270,
                                 offset_after: int = 90, group_col: str = "TRIMESTER",
                                 code_col: str = "ICD10") -> DataFrame:
    """Events from a code table: one row per (event_type, code) with source and offsets.

    The table is what `event_code_select` and `mask_intervals` take, whatever its size.
    """
    missing = {group_col, code_col} - set(codes.columns)
    if missing:
        raise ValueError(f"code table lacks the columns {sorted(missing)}")
    group, code = strip(F.col(group_col)), strip(F.col(code_col))
    usable = (group != "") & (code != "") & (group != "nan") & (code != "nan")
    return codes.where(usable).select(
        F.replace(F.lower(group), F.lit(" "), F.lit("_")).alias("event_type"), code.alias("code"),
        F.lit(source).alias("source"), F.lit(offset_before).alias("offset_before"),
        F.lit(offset_after).alias("offset_after"),
    ).distinct()
