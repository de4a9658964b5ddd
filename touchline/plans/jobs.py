"""Layer jobs: land, bronze, silver, gold, catalog, model; and all in order.

One session is passed through (never built or stopped here). Layers hand
over by Parquet tables, which also cut lineage: a lost executor only costs
the tasks of the job in flight, and every write is an idempotent overwrite.

A full overwrite (``partition_overwrite="static"``) writes every layer into a
new version of the lake and publishes all of them at the end, so a run that
breaks leaves the last run's tables as they were. A dynamic run replaces its
partitions in the published tables, by Spark's own staged commit.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, model, silver
from ..params import RunParams, league_dimension
from ..session import scratch_table, write_conf
from ..sources import landing
from ..sources.bronze import bronze_from_landing
from ..sources.layers import folder_exists, layer_path, new_version, prune, publish, read_table, remove_folder, table_path
from ..sources.layers import version_root, write_layer
from .catalog import register_lake

LOG = logging.getLogger(__name__)


def utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


def new_run_id(clock: Callable[[], _dt.datetime] = utc_now) -> str:
    """``yyyyMMdd'T'HHmmss'Z'`` of the clock's time, in UTC (``parsing.run_id_at`` is its column form)."""
    now = clock().astimezone(_dt.timezone.utc)
    return f"{now.year:04d}{now:%m%dT%H%M%SZ}"


@dataclass
class RunReport:
    run_id: str
    successes: int = 0
    total: int = 0
    unlisted_files: int = 0   # landed files outside the manifest, which are not read
    rejected_rows: int = 0    # bronze rows that silver drops for a missing key
    outputs: dict[str, str] = field(default_factory=dict)
    accuracy: float | None = None
    trained_rows: int | None = None


def _dynamic(params: RunParams) -> bool:
    if params.partition_overwrite not in ("static", "dynamic"):
        raise ValueError(f"partition_overwrite must be static or dynamic, not {params.partition_overwrite!r}")
    return params.partition_overwrite == "dynamic"


def land(spark: SparkSession, params: RunParams, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Manifest + landing check for one run -> (results, landed headers).

    The file dimension is written once into the shared folder, because both
    the check and the bronze read use it.
    """
    run_root = landing.run_folder(params.landing, run_id)
    leagues = league_dimension(spark, params.leagues)
    manifest = landing.ingest_manifest(leagues, params.start_year, params.final_year(), run_root)
    headers = scratch_table(landing.landed_headers(spark, run_root), "landed")
    results = landing.landing_results(manifest, headers)
    return results, headers


def _written(spark: SparkSession, params: RunParams, version: str | None, table: str, frame: DataFrame, **how) -> str:
    """Write a table: partitions in place (dynamic), or a whole new version.

    Without a ``version`` the new one is published at once; with one, that is
    left to the caller, who has more tables to write.
    """
    if _dynamic(params):
        return write_layer(frame, table_path(spark, params.lake_root, table), dynamic=True, **how)
    staged = version or new_version("table")
    path = write_layer(frame, layer_path(version_root(params.lake_root, staged), table), **how)
    if version is None:
        publish(spark, params.lake_root, staged, [table])
        prune(spark, params.lake_root)
    return path


def build_bronze(spark: SparkSession, params: RunParams, run_id: str, headers: DataFrame,
                 results: DataFrame | None = None, version: str | None = None) -> str | None:
    """Landed CSV of the run -> bronze table; None if nothing landed.

    With ``results`` (the landing check), only files of successful manifest
    tasks are read, as a download run would have produced exactly those.
    Each landed file belongs to one (league, season), so scan tasks already
    write few partitions each: no shuffle before the write.
    """
    run_root = landing.run_folder(params.landing, run_id)
    if results is not None:
        wanted = landing.successful(results).select("league_name", "season")
        headers = headers.join(wanted, ["league_name", "season"], "left_semi")
    bronze = bronze_from_landing(spark, run_root, run_id, params.leagues, headers)
    if bronze is None:
        LOG.warning("no landed file with content under %s; bronze not written", run_root)
        return None
    return _written(spark, params, version, "bronze.matches", bronze, rebalance=False)


def unlisted_files(headers: DataFrame, results: DataFrame) -> int:
    """Landed files whose (league, season) the manifest does not list."""
    listed = results.select("league_name", "season").distinct()
    return headers.join(listed, ["league_name", "season"], "left_anti").count()


def only_partitions(frame: DataFrame, partitions: list[tuple[str, str]] | None) -> DataFrame:
    """Rows of the given (league_code, season) partitions only, or all rows.

    The test is an expression over the partition columns alone, so a table
    read prunes the other folders at planning time. Every silver row and every
    gold aggregate belongs to one (league, season), so a layer rebuilt from
    these partitions equals the full rebuild on them."""
    if partitions is None:
        return frame
    keys = sorted({f"{code}/{season}" for code, season in partitions})
    return frame.where(F.concat_ws("/", "league_code", "season").isin(keys))


def build_silver(spark: SparkSession, params: RunParams, partitions: list[tuple[str, str]] | None = None,
                 version: str | None = None) -> str:
    """Bronze table -> silver table (partition-aligned, no shuffle).

    With ``partitions`` (dynamic overwrite), only those bronze partitions are
    read and only those silver partitions replaced. With ``version``, bronze is
    read from and silver written to that version of the lake."""
    bronze = only_partitions(read_table(spark, params.lake_root, "bronze.matches", version), partitions)
    return _written(spark, params, version, "silver.matches", silver.silver_matches(bronze), rebalance=False)


def build_gold(spark: SparkSession, params: RunParams, partitions: list[tuple[str, str]] | None = None,
               version: str | None = None) -> tuple[str, str]:
    """Silver table -> team-season table and league-season summary.

    ONE pass over the matches: the per-(team, venue) aggregates
    (``gold.team_venue_aggregates``, two rows per team and season) are
    written into the shared folder, and both tables are derived from
    them: the team table sums a team's two venue rows, the league summary
    rolls up the home rows. Both outputs are small; a rebalance on the
    partition columns gives one file per partition. With ``partitions``
    (dynamic overwrite) only those silver partitions are read.
    """
    matches = only_partitions(read_table(spark, params.lake_root, "silver.matches", version), partitions)
    per_venue = scratch_table(gold.team_venue_aggregates(matches), "team-venue")
    tables = {"gold.team_season_table": gold.team_table_from(per_venue),
              "gold.league_season_summary": gold.league_summary_from(per_venue)}
    staged = version or (None if _dynamic(params) else new_version("gold"))
    paths = [_written(spark, params, staged, name, frame) for name, frame in tables.items()]
    if staged and version is None:  # a job of its own: both tables at once
        publish(spark, params.lake_root, staged, list(tables))
        prune(spark, params.lake_root)
    return tuple(paths)


def model_path(lake_root: str) -> str:
    return f"{lake_root.rstrip('/')}/models/match_outcome"


def train_model(spark: SparkSession, params: RunParams, min_start_year: int = model.MIN_SEASON_START_YEAR,
                num_trees: int = 100) -> model.TrainedModel:
    """Silver table -> features -> forest, saved under ``models/``."""
    matches = read_table(spark, params.lake_root, "silver.matches")
    features = model.match_features(matches, min_start_year, keep=(model.in_test().alias("in_test"),))
    trained, _ = model.train_outcome_model(
        features, num_trees=num_trees, save_to=model_path(params.lake_root))
    LOG.info("model accuracy %.3f on %d test rows", trained.accuracy, trained.test_rows)
    return trained


RUN_SCHEMA = ("run_id string, layer string, rows long, rejected_rows long, unlisted_files long, "
              "accuracy double, finished_at timestamp")


def runs_path(lake_root: str) -> str:
    return f"{lake_root.rstrip('/')}/runs"


def run_table(spark: SparkSession, lake_root: str) -> DataFrame:
    """What every run did: a row per run and layer (``landing`` counts files, the layers rows)."""
    if not folder_exists(spark, runs_path(lake_root)):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(runs_path(lake_root))


def record_run(spark: SparkSession, params: RunParams, report: RunReport, partitions: list[tuple[str, str]] | None,
               clock: Callable[[], _dt.datetime]) -> None:
    """Append the run to the lake's run table. Row counts of the written tables come from Parquet footers."""
    counted = {name: only_partitions(read_table(spark, params.lake_root, name), partitions).count() for name in report.outputs}
    rows = [("landing", report.successes, report.total - report.successes, report.unlisted_files, None)]
    rows += [(name, n, report.rejected_rows if name == "silver.matches" else 0, 0, None) for name, n in counted.items()]
    if report.trained_rows is not None:
        rows.append(("model", report.trained_rows, 0, 0, report.accuracy))
    at = clock().astimezone(_dt.timezone.utc)
    table = spark.createDataFrame([(report.run_id, *row, at) for row in rows], RUN_SCHEMA)
    table.coalesce(1).write.mode("append").parquet(runs_path(params.lake_root))


def run_all(spark: SparkSession, params: RunParams, run_id: str | None = None, *,
            with_model: bool | None = None, min_start_year: int = model.MIN_SEASON_START_YEAR,
            clock: Callable[[], _dt.datetime] = utc_now) -> RunReport:
    """Every layer in order on one session; the run is recorded in the lake's run table.

    ``with_model`` decides over training where it is given, else ``params.train_model``.
    """
    with_model = params.train_model if with_model is None else with_model
    run_id = run_id or new_run_id(clock)
    report = RunReport(run_id)
    results, headers = land(spark, params, run_id)
    summary = landing.ingest_summary(results).first()
    report.successes, report.total = summary["successes"], summary["total"]
    LOG.info("landing: %d of %d files", report.successes, report.total)
    report.unlisted_files = unlisted_files(headers, results)
    if report.unlisted_files:
        LOG.warning("landing: %d files are not in the manifest and are not read", report.unlisted_files)
    # dynamic overwrite: the later layers rebuild only the partitions this run
    # landed (at most leagues x seasons pairs, from the manifest)
    partitions, version = None, None
    if _dynamic(params):
        landed = landing.successful(results).select("league_code", "season").distinct().collect()
        partitions = [(r.league_code, r.season) for r in landed]
    else:
        version = new_version(run_id)
    try:
        _build_layers(spark, params, report, headers, results, partitions, version)
    except Exception:
        if version:
            remove_folder(spark, version_root(params.lake_root, version))
        raise
    if report.outputs:
        if version:
            publish(spark, params.lake_root, version, list(report.outputs))
        register_lake(spark, params.lake_root, params.database_prefix, partitions=partitions)
        if version:
            prune(spark, params.lake_root)
        if with_model:
            try:
                trained = train_model(spark, params, min_start_year)
                report.accuracy, report.trained_rows = trained.accuracy, trained.train_rows
            except model.NoTrainingRows as exc:
                LOG.warning("model not trained: %s", exc)
    record_run(spark, params, report, partitions, clock)
    return report


def _build_layers(spark: SparkSession, params: RunParams, report: RunReport, headers: DataFrame, results: DataFrame,
                  partitions: list[tuple[str, str]] | None, version: str | None) -> None:
    """Bronze, silver and gold of a run; nothing if nothing landed."""
    bronze_path = build_bronze(spark, params, report.run_id, headers, results, version)
    if bronze_path is None:
        return
    bronze = only_partitions(read_table(spark, params.lake_root, "bronze.matches", version), partitions)
    report.rejected_rows = silver.rejected_matches(bronze).count()  # reads four columns of the written table
    if report.rejected_rows:
        LOG.warning("silver drops %d rows without a team, league or season", report.rejected_rows)
    silver_path = build_silver(spark, params, partitions, version)
    team, league = build_gold(spark, params, partitions, version)
    report.outputs.update({"bronze.matches": bronze_path, "silver.matches": silver_path,
                           "gold.team_season_table": team, "gold.league_season_summary": league})


def landing_from_rows(raw: DataFrame, run_root: str, mode: str = "overwrite") -> str:
    """Write raw match rows as landed CSV files (header, one folder per league
    and season, Spark's partitioned layout; blanks around values kept). Used to
    feed the landing and bronze steps from data derived from the driver's tables."""
    data_cols = [c for c in raw.columns if c not in ("ingestion_run_id", "source_file", "league_code")]
    with write_conf(raw.sparkSession):
        (raw.select(*[F.col(f"`{c}`") for c in data_cols])
         .hint("rebalance", "league_name", "season")
         .write.mode(mode).option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).partitionBy("league_name", "season").csv(run_root))
    return run_root
