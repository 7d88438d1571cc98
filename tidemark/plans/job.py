"""The batch job, in one Spark application.

    landing ─► normalise ─► snapshot table ─► latest table ─► ranked reports ─┐
                               └──────────► newest two runs ─► trend reports ─┼─► quality gate ─► marts

Steps run in a fixed order and a failure stops the job (exceptions propagate);
independent outputs within a step run as concurrent Spark jobs. Every step reads what the previous one wrote, so lineage is cut at
each table and a lost executor only repeats the current step. Only small things
reach the driver: two run stamps, and one row per quality check.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S
from tidemark.operators import marts, quality, reports, trends
from tidemark.operators.normalize import NORMALIZERS
from tidemark.plans.ledger import Ledger
from tidemark.sources import files, landing, reports_io, snapshots

FEEDS = ("markets", "protocols", "stablecoins")
KEYS = {"markets": "id", "protocols": S.ID_TEXT, "stablecoins": "id"}

RANKED = {
    # report name: (feed, builder, order, score column)
    "token_liquidity_risk_top50": ("markets", reports.token_liquidity_risk, reports.TOKEN_RISK_ORDER,
                                   "liquidity_risk_score"),
    "defi_protocol_risk_top50": ("protocols", reports.defi_protocol_risk, reports.PROTOCOL_RISK_ORDER,
                                 "protocol_risk_score"),
    "stablecoin_depeg_risk_top50": ("stablecoins", reports.stablecoin_depeg_risk, reports.STABLECOIN_RISK_ORDER,
                                    "depeg_risk_score"),
}
TRENDS = {
    "token_liquidity_risk_trends": ("markets", trends.token_liquidity_risk_trends, trends.TOKEN_TREND_ORDER),
    "defi_protocol_risk_trends": ("protocols", trends.defi_protocol_risk_trends, trends.PROTOCOL_TREND_ORDER),
}


TREND_CHARTS = {"token_liquidity_risk_trends": "token_trends", "defi_protocol_risk_trends": "protocol_trends"}


@dataclass(frozen=True)
class Layout:
    """Folder layout under one root (a shared file system path or URI)."""

    root: str

    def raw(self, feed: str) -> str:
        return f"{self.root}/raw/{feed}"

    def latest(self, feed: str) -> str:
        return f"{self.root}/processed/{feed}_latest"

    def snapshots(self, feed: str) -> str:
        return f"{self.root}/processed_snapshots/{feed}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def ledger(self) -> str:
        return f"{self.root}/_ledger"

    def staging(self, name: str) -> str:
        return f"{self.root}/_staging/{name}"


def feed_inputs(spark: SparkSession, layout: Layout, feed: str, runs: str = "latest") -> list[tuple[str, int, str]]:
    """The landed runs that a feed's normalisation reads, oldest first; stops where the newest holds no record."""
    if runs not in ("latest", "all"):
        raise ValueError("runs must be 'latest' or 'all'")
    landed = landing.current_runs(spark, layout.raw(feed))
    if not landed:
        raise FileNotFoundError(f"{layout.raw(feed)}: the run manifest is empty; land a run with land_records")
    newest, records, _ = landed[-1]
    if not records:
        raise ValueError(f"{layout.raw(feed)}: the newest run, {newest}, holds no record; land it again")
    return landed[-1:] if runs == "latest" else landed


def normalize_feed(spark: SparkSession, layout: Layout, feed: str, runs: str = "latest") -> None:
    """Normalise landed runs of ``feed`` into the snapshot table, then refresh the
    latest table from the newest landed run. Stops where that run holds no record.

    ``runs="latest"``: only the newest landed run (the regular schedule);
    ``runs="all"``: every landed run (backfill; idempotent per run).
    """
    newest = feed_inputs(spark, layout, feed, runs)[-1][0]
    landed = landing.read_landed(spark, layout.raw(feed), feed, [newest] if runs == "latest" else None)
    snapshots.write_snapshots(NORMALIZERS[feed](landed), layout.snapshots(feed), many_runs=(runs == "all"))
    latest = snapshots.read_runs(spark, layout.snapshots(feed), S.FEEDS[feed]["typed"], [newest]) \
        .drop(*S.SNAPSHOT_PARTITIONS)
    snapshots.write_latest(latest, layout.latest(feed))


def together(actions: list[Callable[[], object]]) -> list:
    """Run independent Spark actions concurrently from threads (one session,
    concurrent jobs). Each action is a small job that would leave most cores
    idle on its own. Results come back in order; the first failure is raised
    after all have finished."""
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]


def read_latest(spark: SparkSession, layout: Layout, feed: str) -> DataFrame:
    return spark.read.schema(S.FEEDS[feed]["typed"]).parquet(layout.latest(feed))


def ranked_reports(spark: SparkSession, layout: Layout, ledger: Ledger | None = None, inputs: dict | None = None) -> None:
    def one(name: str, feed: str, build, order) -> Callable[[], None]:
        def write() -> None:
            reports_io.write_report(build(read_latest(spark, layout, feed)), layout.report(name), order=list(_order_cols(order)), single_file=True)
        return lambda: _step(ledger, name, (inputs or {}).get(feed), write)
    together([one(name, feed, build, order) for name, (feed, build, order, _) in RANKED.items()])


def trend_reports(spark: SparkSession, layout: Layout, skip_if_single: bool = False, ledger: Ledger | None = None,
                  inputs: dict | None = None) -> list[str]:
    """Write both trend reports; returns the names written. With fewer than two
    runs this raises, unless ``skip_if_single``. The two runs are chosen once, in a pinned version: runs that
    land meanwhile change nothing."""
    def one(name: str, feed: str, build, order) -> Callable[[], str | None]:
        def run() -> str | None:
            try:
                version = snapshots.pin_runs(spark, layout.snapshots(feed), 2)
            except ValueError:
                if not skip_if_single:
                    raise
                # Nothing of an earlier run may pass for this one's.
                for path in (layout.report(name), layout.mart(f"chart_{TREND_CHARTS[name]}")):
                    files.remove_folder(spark, path)
                return None
            previous_ts, latest_ts = snapshots.pinned_runs(spark, layout.snapshots(feed), version)

            def write() -> None:
                both = snapshots.read_runs(spark, layout.snapshots(feed), S.FEEDS[feed]["typed"], [previous_ts, latest_ts])
                latest, previous = (snapshots.pick_snapshot(both, run) for run in (latest_ts, previous_ts))
                # Joined once into a staging table: the global sort's range sampling would run the join again.
                reports_io.write_report(build(latest, previous), layout.report(name),
                                        order=list(_order_cols(order)), stage=layout.staging(name))
            _step(ledger, name, [(inputs or {}).get(feed), previous_ts, latest_ts], write)
            return name
        return run

    done = together([one(name, feed, build, order) for name, (feed, build, order) in TRENDS.items()])
    return [name for name in done if name is not None]


def quality_targets(layout: Layout, trend_names: list[str]):
    tables = [quality.TableTarget(feed, layout.latest(feed), KEYS[feed]) for feed in FEEDS]
    score_cols = {name: spec[3] for name, spec in RANKED.items()}
    score_cols.update({name: "risk_score_change" for name in trend_names})
    return tables, [quality.ReportTarget(n, layout.report(n), c) for n, c in score_cols.items()]


def build_marts(spark: SparkSession, layout: Layout, trend_names: list[str]) -> None:
    """D1-D7 from the written reports. The ranked reports (≤ 50 rows each) feed
    both the KPI row and a chart, so they are cached; trend reports are read once."""
    loaded = {name: read_report(spark, layout, name) for name in list(RANKED) + trend_names}
    for name in RANKED:
        loaded[name] = loaded[name].cache()
    kpi = marts.kpi_row(loaded["token_liquidity_risk_top50"], loaded["defi_protocol_risk_top50"],
                        loaded["stablecoin_depeg_risk_top50"])
    actions = [lambda: kpi.write.mode("overwrite").parquet(layout.mart("kpis"))]
    charts = {"token_risk": "token_liquidity_risk_top50", "protocol_risk": "defi_protocol_risk_top50",
              "stablecoin_risk": "stablecoin_depeg_risk_top50", **{chart: name for name, chart in TREND_CHARTS.items()}}
    for chart, report in charts.items():
        if report in loaded:
            table = marts.chart_table(loaded[report], chart).coalesce(1)
            actions.append(lambda t=table, c=chart: t.write.mode("overwrite").parquet(layout.mart(f"chart_{c}")))
    try:
        together(actions)
    finally:
        for name in RANKED:
            loaded[name].unpersist()


def _step(ledger: Ledger | None, step: str, inputs: object, action: Callable[[], object]) -> None:
    if ledger is None:
        action()
    else:
        ledger.run(step, inputs, action)


def run_job(
    spark: SparkSession,
    layout: Layout,
    runs: str = "latest",
    skip_trends_if_single: bool = False,
    with_marts: bool = True,
    resume: bool = False,
) -> DataFrame:
    """Run every step; returns the quality results (one row per output).

    Steps run in order; the independent outputs inside a step (three feeds,
    three ranked reports, two trends, the marts) run as concurrent jobs. ``resume``, after a job that
    failed, leaves out the outputs that it finished from the landed runs that are still the current ones;
    the quality checks always run. Outputs that something else has changed since are not noticed."""
    ledger = Ledger(spark, layout.ledger(), resume)
    inputs = dict(zip(FEEDS, together([lambda f=feed: [runs, feed_inputs(spark, layout, f, runs)] for feed in FEEDS])))
    together([lambda f=feed: ledger.run(f"normalize_{f}", inputs[f], lambda: normalize_feed(spark, layout, f, runs)) for feed in FEEDS])
    ranked_reports(spark, layout, ledger, inputs)
    written = trend_reports(spark, layout, skip_trends_if_single, ledger, inputs)
    tables, report_targets = quality_targets(layout, written)
    results = quality.assert_passed(quality.quality_suite(spark, tables, report_targets))
    if with_marts:
        ledger.run("marts", [inputs, written], lambda: build_marts(spark, layout, written))
    return results


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Expose the job's outputs to SQL as temp views: ``<feed>_latest``,
    ``<feed>_snapshots`` and one view per written report; the bands and scores
    are registered as SQL functions (``protocol_risk_score(tvl, ...)``), so
    ad-hoc SQL runs over the same tables with the same rules."""
    from tidemark.functions.scorecard import register_sql_functions

    register_sql_functions(spark)
    names = []
    for feed in FEEDS:
        for view, reader in ((f"{feed}_latest", lambda f=feed: read_latest(spark, layout, f)),
                             (f"{feed}_snapshots", lambda f=feed: snapshots.read_snapshots(
                                 spark, layout.snapshots(f), S.FEEDS[f]["typed"]))):
            try:
                reader().createOrReplaceTempView(view)
                names.append(view)
            except AnalysisException:
                continue
    for name in REPORT_SCHEMAS:
        try:
            read_report(spark, layout, name).createOrReplaceTempView(name)
            names.append(name)
        except FileNotFoundError:
            continue
    return names


# --- helpers -------------------------------------------------------------------

def _order_cols(order):
    from tidemark.operators.ranking import order_columns

    return order_columns(order)


REPORT_SCHEMAS: dict[str, str] = {
    "token_liquidity_risk_top50": (
        "market_cap_rank bigint, id string, symbol string, name string, current_price double, "
        "market_cap double, total_volume double, volume_to_market_cap_ratio double, "
        "price_change_percentage_24h double, price_change_percentage_7d double, "
        "circulating_supply_ratio double, liquidity_risk_score int"),
    "defi_protocol_risk_top50": (
        "name string, symbol string, chain string, category string, tvl double, change_1d double, "
        "change_7d double, audits double, tvl_to_mcap_ratio double, protocol_risk_score int, url string"),
    "stablecoin_depeg_risk_top50": (
        "name string, symbol string, pegMechanism string, price double, absolute_depeg double, "
        "circulating_usd double, supply_change_1d_pct double, supply_change_7d_pct double, "
        "chain_count int, depeg_risk_score int"),
    "token_liquidity_risk_trends": (
        "symbol_latest string, name_latest string, liquidity_risk_score_previous int, "
        "liquidity_risk_score_latest int, risk_score_change int, market_cap_change_pct double, "
        "volume_change_pct double, volume_to_market_cap_ratio_previous double, "
        "volume_to_market_cap_ratio_latest double, ingested_at_utc_previous string, ingested_at_utc_latest string"),
    "defi_protocol_risk_trends": (
        "name_latest string, symbol_latest string, chain_latest string, category_latest string, "
        "protocol_risk_score_previous int, protocol_risk_score_latest int, risk_score_change int, "
        "tvl_previous double, tvl_latest double, tvl_change_pct double, change_1d_latest double, "
        "change_7d_latest double, audits_latest double, ingested_at_utc_previous string, "
        "ingested_at_utc_latest string"),
}


def read_report(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """D7: a written report with its schema; raises ReportMissing when absent."""
    return reports_io.read_report(spark, layout.report(name), REPORT_SCHEMAS[name])


def land_fixture_feeds(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    """Land raw records derived from the test tables (every run of every feed)."""
    from pyspark.sql import functions as F

    from tidemark.plans import fixtures as fx

    def land(feed: str) -> None:
        source, endpoint = fx.ENDPOINTS[feed]
        raw = fx.RAW_BUILDERS[feed](spark, sf_dir)
        landing.land_records(raw, layout.raw(feed), source, endpoint, F.col(S.STAMP))

    together([lambda f=feed: land(f) for feed in FEEDS])
