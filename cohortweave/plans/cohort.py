"""The whole cohort job: raw tables and phenotype specifications in, matrices out."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.globs import has_glob, matches_any_glob
from cohortweave.functions.values import as_date, as_number
from cohortweave.operators.categorical import CategoricalSpec, categorical_matrix
from cohortweave.operators.clean import OutlierRule, outlier_filter_batch, scale_filter
from cohortweave.operators.coded import MAX_PIVOT_COLUMNS, CodedDefinition, advanced_coded_matrix, code_counts, presence
from cohortweave.operators.gather import gather_long, gather_wide, pivot_long
from cohortweave.operators.long import glob_condition, occurrence_date, sample_allow_list
from cohortweave.operators.mask import EventDefinition, apply_mask_batch, event_table, events_without_windows, mask_intervals
from cohortweave.operators.quant import quantitative_table
from cohortweave.operators.risk import RiskRule, risk_tables
from cohortweave.runtime import Scope, quoted, settle
from cohortweave.sources.delimited import LONG_COLUMNS

log = logging.getLogger(__name__)

# What a specification means when it leaves a setting out.
COMMON_DEFAULTS = {
    "sample_id_col": "sample_ID", "date_col": None, "reference_date": "today", "filter": {},
    "event_mask": [], "output_name": None,
}
FAMILY_DEFAULTS = {
    "quantitative": {
        "stats": ["mean", "median", "std"], "qcut_bins": 0, "scale": False, "scale_method": "zscore",
        "outlier_method": "iqr", "outlier_mode": "cap", "outlier_iqr_multiplier": 1.5, "outlier_zscore_sd": 3.0,
        "min_occurrences": 1,
    },
    "categorical": {
        "missing_as_control": False, "one_hot": False, "min_occurrences": 1, "dictionary": None, "categories": None,
    },
    "coded": {"missing_as_control": False, "min_occurrences": 1, "subsample": "all"},
}


OTHER_SETTINGS = {"data_type", "phenotype_name", "table", "value_col", "long_table", "risk_classification"}


def complete_spec(spec: dict) -> dict:
    """A specification with its defaults; raises on a missing or unknown setting."""
    family = spec.get("data_type")
    if family not in FAMILY_DEFAULTS:
        raise ValueError(f"data_type must be one of {sorted(FAMILY_DEFAULTS)}, not {family!r}")
    unknown = sorted(set(spec) - set(COMMON_DEFAULTS) - set(FAMILY_DEFAULTS[family]) - OTHER_SETTINGS)
    if unknown:
        raise ValueError(f"{spec.get('phenotype_name', '?')}: unknown settings {', '.join(unknown)}")
    full = {**COMMON_DEFAULTS, **FAMILY_DEFAULTS[family], **spec}
    full.setdefault("long_table", None)
    for needed in ("phenotype_name", *(() if full["long_table"] else ("table", "value_col"))):
        if full.get(needed) is None:
            raise ValueError(f"{spec.get('phenotype_name', '?')}: {needed!r} is required")
    full["output_name"] = full["output_name"] or full["phenotype_name"]
    return full


@dataclass
class Cohort:
    """Results of one run.

    `wide` and the tables read more than once are stored, the rest is lazy and reads them, until `close` (or the end of a
    `with` block) drops all stored tables.
    """

    quantitative: DataFrame | None = None
    categorical: DataFrame | None = None
    coded: DataFrame | None = None
    intervals: DataFrame | None = None
    parts: list[DataFrame] = field(default_factory=list)
    wide: DataFrame | None = None
    long: DataFrame | None = None
    risk: DataFrame | None = None
    report: DataFrame | None = None
    scope: Scope = field(default_factory=Scope, repr=False)

    def close(self) -> None:
        self.scope.drop()

    def __enter__(self) -> Cohort:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def results_only(self) -> None:
        """Store the results and drop every table that only led to them."""
        kept = {}
        for name in ("intervals", "wide", "long", "risk", "report"):
            if (found := getattr(self, name)) is not None:
                kept[name] = settle(found)
                if not any(kept[name] is t for t in self.scope.tables):
                    self.scope.tables.append(kept[name])
        self.scope.drop_but(*kept.values())
        self.quantitative = self.categorical = self.coded = None
        self.parts = []
        vars(self).update(kept)


def _family_long(specs: list[dict], tables: dict[str, DataFrame], allowed, run_date, family: str) -> DataFrame | None:
    """Long rows of all phenotypes of a family, `owner` naming the specification.

    Specifications on the same columns of a table share one scan: a row is handed to each
    specification whose filter it passes.
    """
    shared: dict[tuple, list[dict]] = {}
    ready: dict[str, list[dict]] = {}
    for spec in specs:
        if spec["long_table"]:
            ready.setdefault(spec["long_table"], []).append(spec)
            continue
        place = tuple(spec[k] for k in ("table", "sample_id_col", "value_col", "date_col", "reference_date"))
        shared.setdefault(place, []).append(spec)

    parts = []
    for (table, sample_col, value_col, date_col, reference), group in shared.items():
        raw = sample_allow_list(tables[table], allowed, sample_col)
        tests = [(s, glob_condition(raw, s["filter"])) for s in group]
        if family == "coded":
            tests = [(s, t & _subsample_test(raw, value_col, s["subsample"])) for s, t in tests]
        raw = raw.where(reduce(lambda a, b: a | b, [t for _, t in tests]))
        if len(group) == 1:
            owner = F.lit(group[0]["phenotype_name"])
        else:
            owners = F.array_compact(F.array(*[F.when(t, F.lit(s["phenotype_name"])) for s, t in tests]))
            owner = F.explode(owners)
        when, made_up = occurrence_date(raw, date_col, reference, run_date)
        value = as_number(raw, value_col) if family == "quantitative" else F.col(quoted(value_col)).cast("string")
        rows = raw.where(F.col(quoted(value_col)).isNotNull()).select(
            F.col(quoted(sample_col)).cast("string").alias("sample_ID"), F.lit(family).alias("data_type"),
            owner.alias("owner"), value.alias("value"), when.alias("occurrence_date"),
            made_up.alias("date_is_synthetic"))
        rows = rows.withColumn("occurrence_date", as_date(rows, "occurrence_date"))
        parts.append(rows.withColumn("phenotype", F.col("value") if family == "coded" else F.col("owner")))
    parts += [_ready_rows(tables[name], group, family) for name, group in ready.items()]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _ready_rows(table: DataFrame, specs: list[dict], family: str) -> DataFrame:
    """Rows of a ready-made long table as they are: no filter, sample list, code selection or cleaning acts on them.

    A specification takes the rows of its phenotype, or of none; a coded one takes all rows, each under its phenotype or else its value.
    """
    for name in LONG_COLUMNS:
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast("string"))
    phenotype = F.col("phenotype").cast("string")
    mine = lambda s: F.lit(True) if family == "coded" else phenotype.isNull() | (phenotype == s["phenotype_name"])
    owners = F.array_compact(F.array(*[F.when(mine(s), F.lit(s["phenotype_name"])) for s in specs]))
    value = as_number(table, "value") if family == "quantitative" else F.col("value").cast("string")
    return table.where("value IS NOT NULL").select(
        F.col("sample_ID").cast("string").alias("sample_ID"), F.lit(family).alias("data_type"), F.explode(owners).alias("owner"), value.alias("value"),
        as_date(table, "occurrence_date").alias("occurrence_date"), F.lit(False).alias("date_is_synthetic"), phenotype.alias("_named"),
    ).withColumn("phenotype", F.coalesce("_named", "value") if family == "coded" else F.col("owner")).drop("_named")


def _subsample_test(raw: DataFrame, value_col: str, subsample):
    if subsample == "all":
        return F.lit(True)
    wanted = [str(s) for s in subsample]
    column = F.col(quoted(value_col)).cast("string")
    if any(has_glob(s) for s in wanted):
        return matches_any_glob(column, wanted)
    return column.isin(*wanted) if wanted else F.lit(False)


def _masked(long: DataFrame | None, specs: list[dict], intervals: DataFrame | None, spare_synthetic: bool):
    if long is None or intervals is None:
        return long
    dated = lambda s: s["date_col"] or s["long_table"]
    undated = [s["phenotype_name"] for s in specs if s["event_mask"] and not dated(s)]
    if undated:
        log.warning("no mask for %s: all their dates come from the reference date", undated)
    opt_in = {s["phenotype_name"]: s["event_mask"] for s in specs if dated(s)}
    return apply_mask_batch(long, intervals, opt_in, "owner", spare_synthetic)


def _coded_table(long: DataFrame, specs: list[dict], codes: dict[str, list[str]] | None,
                 roster: DataFrame | None) -> DataFrame:
    """Presence of every code as a column, under the settings of the specification it came from."""
    if codes is None:
        pairs = long.select("owner", "phenotype").distinct().limit(MAX_PIVOT_COLUMNS + 1).collect()
        if len(pairs) > MAX_PIVOT_COLUMNS:
            raise ValueError(f"more than {MAX_PIVOT_COLUMNS} codes: name the wanted ones or set code_columns=False")
        codes = {}
        for owner, code in sorted(pairs):
            codes.setdefault(owner, []).append(code)
    spec_of: dict[str, dict] = {}
    for spec in specs:
        for code in codes.get(spec["phenotype_name"], []):
            if code in spec_of:
                raise ValueError(f"code {code} comes from {spec_of[code]['phenotype_name']} and {spec['phenotype_name']}")
            spec_of[code] = spec
    counts = code_counts(long.where(F.col("phenotype").isin(*spec_of)), ["sample_ID", "phenotype"])
    table = pivot_long(counts.withColumnRenamed("n", "value"), list(spec_of))
    if roster is not None:
        table = roster.select("sample_ID").join(table, "sample_ID", "left")
    return table.select("sample_ID", *[
        presence(F.col(quoted(code)), int(spec["min_occurrences"]), roster is not None and spec["missing_as_control"])
        .cast("int").alias(code)
        for code, spec in spec_of.items()
    ])


def _check_events(spark, specs: list[dict], events) -> list[str]:
    """The events that specifications name; raises where one is not defined."""
    named = sorted({name for spec in specs for name in spec["event_mask"]})
    if events is None:
        if named:
            log.warning("no events are given: nothing is masked by %s", ", ".join(named))
        return []
    if isinstance(events, DataFrame):
        known = {r[0] for r in events.where(F.col("event_type").isin(*named)).select("event_type").distinct().collect()} if named else set()
    else:
        known = {e.name for e in events}
    if unknown := [name for name in named if name not in known]:
        raise ValueError(f"event_mask names unknown events: {', '.join(unknown)}")
    return named


def run_cohort(specs: Iterable[dict], tables: dict[str, DataFrame], *,
               definitions: Iterable[CodedDefinition] = (), events: Iterable[EventDefinition] | DataFrame | None = None,
               allowed: DataFrame | Iterable[str] | None = None, roster: DataFrame | None = None,
               codes: dict[str, list[str]] | None = None, code_columns: bool = True, mask_definitions: bool = False,
               gather: str = "wide", spare_synthetic: bool = False, run_date: datetime.date | None = None,
               results_only: bool = False) -> Cohort:
    """Clean, mask, derive, gather and classify all phenotypes of a cohort.

    `specs` are dicts with the settings of FAMILY_DEFAULTS; `tables` maps their `table` to raw data, or their `long_table` to a
    ready-made long table that is taken as it is. `events` are definitions or a table of them, which must
    define every event that a specification names; without `events` nothing is masked.
    Named case/control `definitions` read the unmasked coded rows unless `mask_definitions` is set.
    Event windows always come from unmasked rows. With `code_columns=False` single codes stay out
    of the wide matrix, for vocabularies too large for columns; `codes` names the wanted ones per
    specification and saves the job that lists them. `gather` is wide, long or both; risk classes
    need the wide form. With `results_only` the results are stored and all else is dropped.
    """
    if gather not in ("wide", "long", "both"):
        raise ValueError(f"gather must be wide, long or both, not {gather!r}")
    specs, definitions = [complete_spec(s) for s in specs], list(definitions)
    events = events if events is None or isinstance(events, DataFrame) else list(events)
    out = Cohort()
    with out.scope:
        _fill(out, specs, tables, definitions, events, allowed, roster, codes, code_columns, mask_definitions, gather, spare_synthetic, run_date)
        if results_only:
            out.results_only()
    return out


def _clean(quant: DataFrame, specs: list[dict]) -> DataFrame:
    """Outliers and scale of raw specifications; ready-made rows pass."""
    raw = [s for s in specs if not s["long_table"]]
    quant = outlier_filter_batch(quant, {
        s["phenotype_name"]: OutlierRule(s["outlier_method"], s["outlier_mode"],
                                         float(s["outlier_iqr_multiplier"]), float(s["outlier_zscore_sd"]))
        for s in raw})
    for method in ("zscore", "minmax"):
        scaled = [s["phenotype_name"] for s in raw if s["scale"] and s["scale_method"] == method]
        if scaled:
            quant = scale_filter(quant, method, scaled)
    return quant


def _fill(out: Cohort, specs, tables, definitions, events, allowed, roster, codes, code_columns, mask_definitions, gather, spare_synthetic, run_date) -> None:
    spark = next(iter(tables.values())).sparkSession if tables else None
    named_events = _check_events(spark, specs, events)
    with_events = isinstance(events, DataFrame) or bool(events)
    by_family = {f: [s for s in specs if s["data_type"] == f] for f in FAMILY_DEFAULTS}

    raw = {f: _family_long(group, tables, allowed, run_date, f) for f, group in by_family.items()}
    uses = with_events + code_columns + 2 * bool(definitions)
    if raw["coded"] is not None and uses > 1:
        raw["coded"] = settle(raw["coded"])
    quant = raw["quantitative"]
    if quant is not None:
        quant = _clean(quant, by_family["quantitative"])

    if with_events:
        if raw["coded"] is None:
            raise ValueError("events need a coded phenotype as their source")
        out.intervals = settle(mask_intervals(raw["coded"].withColumn("source", F.col("owner")), events))
        if named_events:
            listed = event_table(spark, events).where(F.col("event_type").isin(*named_events))
            silent = sorted(r[0] for r in events_without_windows(out.intervals, listed).collect())  # at most those the specifications name
            if silent:
                log.warning("no code matched the events %s", ", ".join(silent))
        own = event_table(spark, events).select("event_type", "source").distinct() if isinstance(events, DataFrame) else None
        pairs = {tuple(r) for r in own.where(F.col("event_type").isin(*named_events)).collect()} if own is not None else {(e.name, e.source) for e in events}
        for spec in by_family["coded"]:
            selfish = [name for name in spec["event_mask"] if (name, spec["phenotype_name"]) in pairs]
            if selfish:
                log.warning("%s is masked by events it is the source of: %s", spec["phenotype_name"], selfish)

    out.quantitative = _masked(quant, by_family["quantitative"], out.intervals, spare_synthetic)
    out.categorical = _masked(raw["categorical"], by_family["categorical"], out.intervals, spare_synthetic)
    out.coded = _masked(raw["coded"], by_family["coded"], out.intervals, spare_synthetic)

    if out.quantitative is not None:
        out.parts.append(quantitative_table(
            out.quantitative, {s["phenotype_name"]: s for s in by_family["quantitative"]}))
    if out.categorical is not None:
        out.parts.append(categorical_matrix(out.categorical, [
            CategoricalSpec(s["phenotype_name"], s["output_name"], s["dictionary"], s["one_hot"], s["categories"],
                            int(s["min_occurrences"]), bool(s["missing_as_control"]))
            for s in by_family["categorical"]], roster))
    if out.coded is not None and code_columns:
        out.parts.append(_coded_table(out.coded, by_family["coded"], codes, roster))
    if definitions:
        source = out.coded if mask_definitions else raw["coded"]
        if source is None:
            raise ValueError("named definitions need a coded phenotype as their source")
        out.parts.append(advanced_coded_matrix(source.withColumn("source", F.col("owner")), definitions, roster))

    rules = [RiskRule.for_phenotype(s["output_name"], s["risk_classification"])
             for s in by_family["quantitative"] if (s.get("risk_classification") or {}).get("method")]
    if rules and gather == "long":
        raise ValueError("risk classes need the wide matrix")
    if not out.parts:
        return
    if gather == "both":
        out.parts = [settle(part) for part in out.parts]
    if gather != "wide":
        out.long = gather_long(out.parts, sort=False)
    if gather != "long":
        # Cutoffs, classes and report all read the matrix: compute it once.
        out.wide = settle(gather_wide(out.parts, sort=False))
    if rules:
        out.risk, out.report = risk_tables(out.wide, rules)
