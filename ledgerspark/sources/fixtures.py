"""Domain views over the driver's TPC-H-style tables.

The checks only load ``/root/testdata/sf*/``, so every raw domain table is a
view over those tables (the mapping is documented in ``FIXTURES.md``). The
views are lazy DataFrames: Catalyst prunes the columns a query does not use
and pushes filters into the parquet scans. Joins against dimension tables are
plain equi-joins; AQE turns them into broadcast joins only when the measured
side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a
sort-merge join otherwise, so nothing is broadcast on a guess.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.functions.numbering import mark_hot, row_number
from ledgerspark.functions.rules import decimal_sum, money_sum, round_decimal
from ledgerspark.sources.model import Sources

# Declared schemas of the driver tables the views read (no footer inference job).
DRIVER_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

_TABLES: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per driver table and session, read under its declared schema."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        reader = spark.read
        if name in DRIVER_SCHEMAS:
            reader = reader.schema(DRIVER_SCHEMAS[name])
        _TABLES[key] = reader.parquet(path)
    return _TABLES[key]


def _month(c) -> F.Column:
    return F.trunc(F.col(c).cast("date"), "month")


def cmdb_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("ci_id"),
        F.col("p_type").alias("service_area"),
        F.col("p_brand").alias("ci_type"),
        F.col("p_retailprice").alias("monthly_cost"),
        F.when(F.col("p_size") % 4 == 0, "Decommissioned").otherwise("Active").alias("status"),
    )


def status_history_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ci_id, status, valid_from): active from the start; decommissioned and taken up again by the part's size."""
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size")
    start = F.lit("1995-01-01").cast("date")

    def turn(status, at):
        return F.struct(F.lit(status).alias("status"), at.alias("valid_from"))

    turns = F.array(turn("Active", F.lit("1990-01-01").cast("date")),
                    F.when(size % 4 == 0, turn("Decommissioned", F.add_months(start, size))),
                    F.when(size % 8 == 0, turn("Active", F.add_months(start, size + 24))))
    return p.select(F.col("p_partkey").alias("ci_id"), F.inline(F.filter(turns, lambda t: t.isNotNull())))


PART_BUCKET = 1024   # parts per ordered bucket of a hot (order, line) pair
INVOICE_KEY = ["l_orderkey", "l_linenumber"]
INVOICE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_shipdate"]
LINE_COLUMNS = [*INVOICE_KEY, *INVOICE_ORDER, "l_returnflag", "l_linestatus", "p_type", "p_retailprice"]


def invoices_view(spark: SparkSession, sf_dir: str, ids: str = "window") -> DataFrame:
    """Invoice lines. `ids="window"` numbers lines with a lazy window (pruned when the id
    is not read); `ids="split"` (for staging) numbers them with ordered buckets, so that one
    hot pair does not meet in one task. Both give the same ids."""
    li = read_table(spark, sf_dir, "lineitem")
    if ids == "split":
        li = mark_hot(li, INVOICE_KEY)
    p = read_table(spark, sf_dir, "part")
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    # Snowflake dimension first (supplier x nation), then one join per dimension on the facts.
    sup = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")
    j = li.join(p, li.l_partkey == p.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
    # (l_orderkey, l_linenumber) is not unique in the driver data; a row number
    # within the pair makes the id unique. Catalyst drops this window whenever
    # a query does not read invoice_id, so aggregates never pay its shuffle.
    if ids == "split":
        j = _numbered(j.select(*LINE_COLUMNS, "n_name", "_hot"), INVOICE_KEY)
        rn = F.col("_rn")
    else:
        rn = F.row_number().over(Window.partitionBy(*INVOICE_KEY).orderBy(*INVOICE_ORDER))
    return j.select(*_invoice_columns(rn))


def _numbered(j: DataFrame, keys: list[str]) -> DataFrame:
    """`_rn`: the row number within a key, hot ones in ordered buckets, so that a hot key is no hot task."""
    return row_number(j, keys, INVOICE_ORDER, F.floor(F.col("l_partkey") / PART_BUCKET), "_rn", hot="_hot")


def _invoice_columns(rn) -> list:
    contracted = F.col("p_retailprice") * F.col("l_quantity")
    return [
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string"), F.lit("-"),
                 rn.cast("string")).alias("invoice_id"),
        F.col("l_partkey").alias("ci_id"),
        F.col("n_name").alias("vendor"),
        F.col("p_type").alias("service_area"),
        _month("l_shipdate").alias("period"),
        contracted.alias("contracted_rate"),
        F.col("l_extendedprice").alias("billed_amount"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "Decommissioned")
         .otherwise("Active").alias("ci_status"),
        F.when(F.col("l_returnflag") == "R", "ghost_circuit")
         .when(F.col("l_extendedprice") >= contracted * 2.0, "duplicate")
         .when(F.col("l_extendedprice") > contracted * 1.15, "rate_overcharge")
         .otherwise("none").alias("planted_error"),
    ]


INVOICE_COLUMNS = ("invoice_id", "ci_id", "vendor", "service_area", "period", "contracted_rate", "billed_amount",
                   "ci_status", "planted_error")
LINE_IDS = ("invoice_id", "ci_id")   # what no sum over lines reads


def _joined(spark: SparkSession, sf_dir: str, li: DataFrame) -> DataFrame:
    """Lines with their parts and vendors; `billed` marks those whose supplier is known."""
    p = read_table(spark, sf_dir, "part")
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    sup = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name", F.lit(True).alias("billed"))
    j = li.join(p, li.l_partkey == p.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey, "left")
    return j.withColumn("billed", F.coalesce("billed", F.lit(False)))


def slice_of(df: DataFrame, cols: list[str], part: tuple[int, int]) -> DataFrame:
    """Slice k of n, `part` being (k, n): rows by the hash of `cols`, so that what shares them is in one slice."""
    k, n = part
    return df.where(F.pmod(F.xxhash64(*cols), F.lit(n)) == k) if n > 1 else df


FEED_COLUMNS = ("billed", "l_orderkey", "l_quantity", "l_discount", "l_tax")


def lines_view(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The lines with their parts, joined and numbered once for the invoice, telemetry and consumption feeds.

    `billed` marks the lines whose supplier is known: only these are invoices.
    Hot (order, line) pairs are looked for before the joins, which add no lines. `part`: one slice of
    the lines (`slice_of`); pairs are whole in a slice, so the slices hold the same ids as all at once.
    """
    li = slice_of(read_table(spark, sf_dir, "lineitem"), INVOICE_KEY, part)
    j = _joined(spark, sf_dir, mark_hot(li, INVOICE_KEY))
    j = _numbered(j.select(*LINE_COLUMNS, "n_name", "billed", "_hot"), [*INVOICE_KEY, "billed"])
    return j.select(*_invoice_columns(F.col("_rn")), *FEED_COLUMNS)


def measures_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `lines_view` without their ids, for what only sums them: joined, not numbered, so not moved for a number."""
    j = _joined(spark, sf_dir, read_table(spark, sf_dir, "lineitem"))
    return j.select(*[c for c, name in zip(_invoice_columns(F.lit(0)), INVOICE_COLUMNS) if name not in LINE_IDS], *FEED_COLUMNS)


def invoices_of(lines: DataFrame) -> DataFrame:
    """The invoice feed of `lines_view` (row-wise: a stream will do); without ids of `measures_view`."""
    return lines.where("billed").select(*[c for c in INVOICE_COLUMNS if c in lines.columns])


def telemetry_of(lines: DataFrame) -> DataFrame:
    """The telemetry feed of `lines_view`; without ids of `measures_view`."""
    keys = [c for c in ("ci_id", "service_area", "period") if c in lines.columns]
    return lines.select(*keys, *_telemetry_columns("billed_amount"))


def consumption_of(spark: SparkSession, sf_dir: str, lines: DataFrame, part: tuple[int, int] = (0, 1),
                   total: Callable = money_sum) -> DataFrame:
    """The consumption feed of `lines_view` or `measures_view`: summed by order before orders and customers join.

    `part`: one slice of the orders (`slice_of`); `total=decimal_sum` leaves its sums to be summed again.
    """
    o = slice_of(read_table(spark, sf_dir, "orders"), ["o_orderkey"], part)
    c = read_table(spark, sf_dir, "customer")
    units = slice_of(lines, ["l_orderkey"], part).groupBy("l_orderkey", "service_area").agg(
        decimal_sum("billed_amount").alias("units"))
    bought = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_mktsegment")   # rows of orders move, not of sums
    j = units.join(bought, units.l_orderkey == bought.o_orderkey)
    return (j.groupBy("service_area", F.col("c_mktsegment").alias("business_unit"))
             .agg(total("units").alias("units")))


def _telemetry_columns(price: str) -> list:
    return [(100 - F.col("l_tax") * 10).alias("uptime_pct"),
            F.col("l_quantity").alias("latency_ms"),
            (F.col("l_discount") * 10).alias("packet_loss_pct"),
            (F.col(price) / 60).alias("mtbf_hours")]


def incidents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    p = read_table(spark, sf_dir, "part")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    cust = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    j = o.join(p, o.o_custkey == p.p_partkey).join(cust, o.o_custkey == cust.c_custkey)
    pr = F.col("o_orderpriority")
    return j.select(
        F.col("o_orderkey").alias("incident_id"),
        F.col("o_custkey").alias("ci_id"),
        F.col("p_type").alias("service_area"),
        F.col("n_name").alias("vendor"),
        pr.alias("priority"),
        _month("o_orderdate").alias("opened"),
        F.col("o_orderdate").cast("date").alias("opened_at"),
        F.when(pr == "1-URGENT", 6).when(pr == "2-HIGH", 12).when(pr == "3-MEDIUM", 24)
         .otherwise(48).cast("double").alias("mttr_hours"),
        (F.col("o_totalprice") / 100).alias("cost_to_resolve"),
    )


def telemetry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_partkey").alias("ci_id"),
        F.col("p_type").alias("service_area"),
        _month("l_shipdate").alias("period"),
        *_telemetry_columns("l_extendedprice"),
    )


def budget_view(invoices: DataFrame, uplift: float = 2.19) -> DataFrame:
    return (invoices.groupBy("service_area")
            .agg(round_decimal(money_sum("contracted_rate"), uplift).alias("annual_budget")))


def consumption_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured consumption per (service area, business unit = market segment)."""
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey))
    return (j.groupBy(F.col("p_type").alias("service_area"),
                      F.col("c_mktsegment").alias("business_unit"))
             .agg(money_sum("l_extendedprice").alias("units")))


def fixture_sources(spark: SparkSession, sf_dir: str, ids: str = "window") -> Sources:
    inv = invoices_view(spark, sf_dir, ids)
    return Sources(
        cmdb=cmdb_view(spark, sf_dir),
        invoices=inv,
        incidents=incidents_view(spark, sf_dir),
        telemetry=telemetry_view(spark, sf_dir),
        budget=budget_view(inv),
        consumption=consumption_view(spark, sf_dir),
        status_history=status_history_view(spark, sf_dir),
    )
