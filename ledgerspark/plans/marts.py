"""The mart layer: build the four marts once, write them, let every analysis read them.

This is the reference's CTAS step as a Spark job: the invoice source is
staged and the aggregated marts are computed from it, written as parquet into
the shared folder (which also cuts their lineage, so a lost executor
recomputes from the written files, not from the raw joins) and read back.
Analyses then start from small, already aggregated tables. Without a store
everything stays a lazy DataFrame.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerspark.functions.rules import decimal_sum, money_sum
from ledgerspark.operators import marts as M
from ledgerspark.operators.cube import audit_cube
from ledgerspark.schemas import RAW_TABLES, VIEW_NAMES
from ledgerspark.session import shared_folder
from ledgerspark.sources.files import load_sources, parsed_tables, raw_format
from ledgerspark.sources.fixtures import (budget_view, consumption_of, fixture_sources, invoices_of,
                                          lines_view, measures_view, telemetry_of)
from ledgerspark.sources.model import Sources
from ledgerspark.sources.rejects import LINE, good, rejects
from ledgerspark.sources.sinks import read_mart, remove, size_of, write_mart

MART_NAMES = ("fct_invoice_audit", "fct_service_area_monthly", "fct_budget_variance",
              "fct_vendor_scorecard")


PART_BYTES = 64 << 20   # of the table of lines: more is staged in slices
MOST_PARTS = 8          # slices at most: each reads the table again


def _once(build):
    """A property built on first use and kept; threads that ask at once wait for one build."""
    name = f"_{build.__name__}"

    @wraps(build)
    def get(self):
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self.__dict__:
                self.__dict__[name] = build(self)
            return self.__dict__[name]

    return property(get)


@dataclass
class Feeds:
    """Sources that come from one table of lines, so that it is joined and staged once.

    `of` turns the staged lines into sources (invoices, telemetry and others);
    `invoices` is the row-wise part of it, which a stream can use too.
    `measures`: the lines as cheaper rows without ids, enough for `of` where only
    sums are asked for. With `parts` above 1 the lines are staged in that many
    slices (`slice`), one after the other, so that the shuffles of one slice are on disk at a time;
    the consumption, whose rows are narrow, is summed in half as many (`units`).
    """

    lines: DataFrame
    of: Callable[[DataFrame], dict]
    invoices: Callable[[DataFrame], DataFrame]
    measures: DataFrame | None = None
    parts: int = 1
    slice: Callable[[tuple[int, int]], DataFrame] | None = None
    units: Callable[[DataFrame, tuple[int, int]], DataFrame] | None = None


def _slices(n: int, of: Callable[[tuple[int, int]], DataFrame]) -> list[DataFrame]:
    return [of((k, n)) for k in range(n)]


class MartSet:
    """Staged sources plus the four marts of one data set.

    The invoice lines (numbered, and partitioned by month, so that a month is read or
    rewritten alone) are staged when a row-wise result reads them; then, from the
    staged lines, the audit cube, the consumption feed and the telemetry monthly rollup, each when
    it is first asked for. Where nothing has asked for lines, these sums are taken from the same lines
    staged without ids, which need no numbering. The marts, the bridge, the headline, the checks
    and the triage evaluation read the cube; only row-wise results read lines.
    With `feeds` one staged table serves all sources made of lines. `derive`
    rebuilds the sources that are functions of the invoices (the fixture
    budget) from their spend rollup.
    """

    def __init__(self, spark: SparkSession, sources: Sources, store: str | None = None,
                 derive: Callable[[DataFrame], dict] | None = None, feeds: Feeds | None = None,
                 parsed: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.raw = sources
        self.store = store
        self.derive = derive
        self.feeds = feeds if store else None
        self.parsed = (parsed or {}) if store else {}   # raw CSV tables with the text of their bad lines
        self._guard, self._locks, self._kept = threading.Lock(), {}, {}

    def _mat(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        return self._mat_slices(name, [df], partition_by) if self.store is not None else df

    def _mat_slices(self, name: str, slices: list[DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
        """One table from its slices, each written before the next begins."""
        path = f"{self.store}/{name}"
        for k, df in enumerate(slices):
            write_mart(df, path, partition_by, "append" if k else "overwrite")
        return read_mart(self.spark, path, slices[0].schema)

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A small result that several queries share: built on first use, written beside the marts."""
        return self.once(name, lambda: self._mat(name, build()))

    def once(self, name: str, build: Callable):
        """What several queries share, built on first use."""
        with self._guard:
            lock = self._locks.setdefault(f"once-{name}", threading.RLock())
        with lock:
            if name not in self._kept:
                self._kept[name] = build()
            return self._kept[name]

    def cleanup(self) -> None:
        """Remove everything that was written for this data set."""
        if self.store is not None:
            remove(self.spark, self.store)
        with _CACHE_LOCK:
            for key in [k for k, ms in _CACHE.items() if ms is self]:
                del _CACHE[key]

    @_once
    def staged_lines(self) -> DataFrame:
        if self.feeds and self.feeds.parts > 1:
            return self._mat_slices("stg_lines", _slices(self.feeds.parts, self.feeds.slice), ("period",))
        return self._mat("stg_lines", self.feeds.lines if self.feeds else self.raw.invoices, ("period",))

    @_once
    def staged_incidents(self) -> DataFrame:
        # read by the scorecards, the bridge and the weekly volume: staged once
        return self._mat("stg_incidents", self.parsed.get("servicenow_incidents", self.raw.incidents))

    @_once
    def lines(self) -> tuple[DataFrame, DataFrame]:
        """The staged lines and incidents: independent, so concurrent jobs of the same session."""
        got = _concurrently({"lines": lambda: self.staged_lines, "incidents": lambda: self.staged_incidents})
        return got["lines"], got["incidents"]

    @property
    def invoices(self) -> DataFrame:
        """The invoices of the staged lines: what reads nothing else waits for nothing else."""
        return self.feeds.invoices(self.staged_lines) if self.feeds else self.staged_lines

    @property
    def incidents(self) -> DataFrame:
        staged = self.staged_incidents
        return good(staged) if LINE in staged.columns else staged

    def _of_lines(self, lines: DataFrame) -> Sources:
        return replace(self.raw, **(self.feeds.of(lines) if self.feeds else {"invoices": lines}))

    @_once
    def fed(self) -> Sources:
        lines, _ = self.lines
        return replace(self._of_lines(lines), incidents=self.incidents)

    @_once
    def measured_lines(self) -> DataFrame:
        """The lines to sum up: those staged, or without ids where no lines are staged yet."""
        if self.feeds is None or self.feeds.measures is None or "_staged_lines" in self.__dict__:
            return self.staged_lines
        return self._mat("stg_measures", self.feeds.measures)

    @_once
    def measured(self) -> Sources:
        """Invoices, telemetry and consumption to sum up."""
        return self._of_lines(self.measured_lines)

    @_once
    def rejects(self) -> DataFrame:
        """(source, reason, line): the lines of raw CSV tables that could not be read, stored beside the marts.

        Those of the staged tables are found there; the others' tables are scanned for them when asked.
        """
        lines, incidents = self.lines
        staged = {"telecom_invoices": lines, "servicenow_incidents": incidents}
        out = self.spark.createDataFrame([], "source string, reason string, line string")
        for stem, df in self.parsed.items():
            kept = staged[stem] if stem in staged else self._mat(f"bad_{stem}", df.where(F.col(LINE).isNotNull()))
            out = out.unionByName(rejects(kept, stem, RAW_TABLES[stem]))
        return self._mat("rejects", out)

    @_once
    def rollups(self) -> dict[str, DataFrame]:
        """What the lines are summed up to by month: the cube, the telemetry months."""
        src = self.measured
        return _concurrently({"cube": lambda: self.cube,
                              "telemetry": lambda: self._mat("stg_telemetry_monthly", M.telemetry_monthly(src.telemetry))})

    @_once
    def cube(self) -> DataFrame:
        """The audit cube: what reads no single line reads this. Built from the lines alone."""
        return self._mat("stg_cube", audit_cube(self.measured.invoices))

    @_once
    def consumption(self) -> DataFrame | None:
        """Units by area and business unit: tiny, reused by E1-E6, summed when first asked for."""
        if self.feeds and self.feeds.parts > 1 and self.feeds.units:
            lines = self.measured_lines
            kept = self._mat_slices("stg_consumption", _slices(self.feeds.parts // 2, lambda part: self.feeds.units(lines, part)))
            return kept.groupBy("service_area", "business_unit").agg(money_sum("units").alias("units"))
        units = self.measured.consumption
        return self._mat("stg_consumption", units) if units is not None else None

    @property
    def budget(self) -> DataFrame:
        return self.derive(self.spend)["budget"] if self.derive else self.raw.budget

    @_once
    def src(self) -> Sources:
        fed = self.fed   # first: the rollups read its lines
        over = {"consumption": self.consumption} if self.consumption is not None else {}
        if self.derive:
            over.update(self.derive(self.spend))
        return replace(fed, **over)

    @property
    def invoice_files(self) -> tuple[str, StructType, Callable[[DataFrame], DataFrame]]:
        """Folder and schema of the staged lines, and what makes invoices of them: for streams over them."""
        return f"{self.store}/stg_lines", self.staged_lines.schema, self.feeds.invoices if self.feeds else (lambda df: df)

    @_once
    def audit(self) -> DataFrame:
        # A narrow projection of the staged invoices: served as a view, so
        # the largest mart is not written a second time.
        return M.invoice_audit(self.invoices)

    @_once
    def spend(self) -> DataFrame:
        """The invoice lines summed by area, month and vendor: what most marts read."""
        return self._mat("stg_spend", M.spend_rollup(self.cube))

    @_once
    def sam(self) -> DataFrame:
        got = _concurrently({"incidents": lambda: self.incidents, "rollups": lambda: self.rollups})
        return self._mat("fct_service_area_monthly", M.service_area_monthly(
            self.spend, got["incidents"], telemetry_rollup=got["rollups"]["telemetry"]))

    @_once
    def budget_variance(self) -> DataFrame:
        return self._mat("fct_budget_variance", M.budget_variance(self.spend, self.budget))

    @_once
    def vendor_scorecard(self) -> DataFrame:
        return self._mat("fct_vendor_scorecard", M.vendor_scorecard(self.incidents, self.spend))

    def all(self) -> dict[str, DataFrame]:
        self.lines, self.spend   # staged first: the marts read them
        built = _concurrently({"sam": lambda: self.sam, "bv": lambda: self.budget_variance,
                               "vsc": lambda: self.vendor_scorecard})
        return dict(zip(MART_NAMES, (self.audit, built["sam"], built["bv"], built["vsc"])))


def register_views(ms: MartSet) -> list[str]:
    """Expose the sources and the four marts as temp views, so existing SQL runs unchanged."""
    names = []
    for field, df in ms.src.items():
        name = VIEW_NAMES.get(field, field)
        df.createOrReplaceTempView(name)
        names.append(name)
    for name, df in ms.all().items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def _concurrently(tasks: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent builds as concurrent jobs (Spark schedules them side by side)."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


_CACHE: dict[tuple[str, str], MartSet] = {}
_CACHE_LOCK = threading.RLock()


def marts_for(spark: SparkSession, sf_dir: str, materialize: bool = True) -> MartSet:
    """The (cached) mart set of a folder, written under the shared folder.

    A folder with raw tables (CSV or parquet, named as in ``schemas.RAW_TABLES``) is read as such;
    any other is taken for a fixture folder.
    """
    with _CACHE_LOCK:
        return _marts_for(spark, sf_dir, materialize)


def _marts_for(spark: SparkSession, sf_dir: str, materialize: bool) -> MartSet:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    ms = _CACHE.get(key)
    if ms is None:
        store = None
        if materialize:
            tag = hashlib.sha1(key[1].encode()).hexdigest()[:12]
            store = f"{shared_folder(spark)}/ledgerspark/marts/{tag}"
        fmt = raw_format(spark, sf_dir)
        if fmt:   # a folder of raw tables in the source layout
            parsed = parsed_tables(spark, sf_dir) if fmt == "csv" and store else {}
            feeds = Feeds(parsed["telecom_invoices"], lambda lines: {"invoices": good(lines)}, good) if parsed else None
            ms = _CACHE[key] = MartSet(spark, load_sources(spark, sf_dir, fmt, keep_rejects=bool(parsed)), store,
                                       feeds=feeds, parsed=parsed)
            return ms
        # Staged lines are numbered in ordered buckets (a hot (order, line) pair is split
        # over tasks); without a store the lazy, prunable window is kept.
        feeds = Feeds(lines_view(spark, sf_dir), lambda lines: {
            "invoices": invoices_of(lines), "telemetry": telemetry_of(lines),
            "consumption": consumption_of(spark, sf_dir, lines)}, invoices_of, measures_view(spark, sf_dir),
            min(MOST_PARTS, max(1, -(-size_of(spark, f"{key[1]}/lineitem.parquet") // PART_BYTES))),
            lambda part: lines_view(spark, sf_dir, part),
            lambda lines, part: consumption_of(spark, sf_dir, lines, part, decimal_sum))
        ms = MartSet(spark, fixture_sources(spark, sf_dir), store,
                     derive=lambda spend: {"budget": budget_view(spend)}, feeds=feeds)
        _CACHE[key] = ms
    return ms
