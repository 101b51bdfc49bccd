"""Jobs: refresh the training table, train, predict and tune per status unit."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.catalogue import DEFAULT, Catalogue
from ticketlens.operators import history, ledger, prepare, snapshots, summaries, units
from ticketlens.operators.model import FeatureParams, ForestParams, SharedFolds, TicketModel, cross_predict, model_versions
from ticketlens.operators.score import class_labels, rank_rows, score
from ticketlens.session import remove_folder, together
from ticketlens.skew import q
from ticketlens.sources import tickets
from ticketlens.sources.tables import read_params, read_table, write_metrics, write_table


@dataclass(frozen=True)
class JobConfig:
    """Settings of the train, predict and tune jobs."""

    model_dir: str = "models"
    results_dir: str = "results"
    metrics_dir: str = "metrics"
    ledger_path: str | None = None
    row_key: Sequence[str] = ("key", "extract_date")
    calibration_folds: int = 5
    features: FeatureParams = FeatureParams()
    forest: ForestParams = ForestParams()
    # Columns, folds, split, default status groups
    target: str = "needed_lead_time"
    status: str = "epic_status"
    id_column: str = "epic_id"
    cv_folds: int = 10
    test_share: float = 0.2
    seed: int = 42
    drop: Sequence[str] = (
        "key", "needed_lead_time", "existing_lead_time", "issuekey", "epic_feature_signoff", "epic_fix_version",
        "epic_owner_email", "epic_initiative_key", "fix_version_date", "dev_roadmap_date", "epic_dev_roadmap",
        "epic_jira_spent_dev_etc_md", "extract_date", "epic_level", "epic_jira_forecast_dev_etc_md",
        "epic_jira_remaining_dev_etc_md", "epic_summary", "epic_sizing_task_records",
        "epic_target_end", "epic_target_start",
    )
    include: Sequence[str] = ()
    exclude: Sequence[str] = (
        "Archived", "Backlog", "Blocked", "Abandoned", "Analyzing", "Done", "Funnel", "Implementing",
    )
    groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "Finished": ["Accepted", "Development Completed", "E2E Validated for Community", "E2E Test Completed"],
        "inflight": ["Development Started", "Planned"],
        "pre-CP": ["High Level Plan Done", "High Level Sizing Done"],
        "Youngster": ["Open", "T-Shirt Sizing Done"],
    })
    ungrouped: str = "skip"


@dataclass(frozen=True)
class SearchSpace:
    """Values tried by the parameter search."""

    # Searched ranges (depth ends where Spark's trees end)
    k_features: Sequence[int] = tuple(range(60, 261, 20))
    n_estimators: Sequence[int] = tuple(range(200, 801, 100))
    max_depth: Sequence[int] = tuple(range(10, 31, 5))
    min_samples_split: Sequence[int] = tuple(range(2, 21))
    min_samples_leaf: Sequence[int] = tuple(range(1, 11))
    max_features: Sequence[str] = ("sqrt", "log2")


@dataclass(frozen=True)
class Unit:
    type: str
    name: str
    slug: str
    statuses: tuple[str, ...]

    @property
    def tag(self) -> str:
        return f"{self.type}_{self.slug}"


ROW_KEY = "row_key"


def panel_from_tickets(
    raw: DataFrame, catalogue: Catalogue = DEFAULT, start: str | None = None, end: str | None = None,
    targets: Sequence[str] = (), people: DataFrame | None = None, require_history: bool = False,
) -> DataFrame:
    """Raw tickets -> one row per ticket and day (or target date), as one lazy plan. Targets replace the period.

    Columns with the same history are replayed once, lists without any change not at all.
    """
    good, _ = tickets.split_tickets(raw)
    twins = catalogue.twins()
    catalogue = replace(catalogue, headers=tuple(h for h in catalogue.headers if h.name not in twins))
    current = tickets.flatten_current(good, catalogue, ["key", "created"]).drop("issuekey")
    fields = [c for c in current.columns if c not in ("key", "created")]
    routed = history.normalise_changes(history.route_changes(tickets.flatten_changes(good, catalogue), catalogue), people, catalogue.seconds_per_day)
    lists = sorted({r.header for rs in catalogue.routes().values() for r in rs if r.is_list}.intersection(fields))
    changing = tickets.changing_columns(good, catalogue)
    lists = [c for c in lists if c in changing]
    log = routed.filter(~F.col("is_list")).drop("is_list", "field", "after")
    pruned = start if not targets else None
    if lists:
        held = current.select("key", F.inline(F.array(*[F.struct(F.lit(c).alias("header"), q(c).alias("value")) for c in lists])))
        asked = history.on_or_after(pruned) if pruned else None  # older lists enter no state
        log = log.unionByName(history.replay_list(held, routed.filter("is_list"), asked=asked))
    states = history.states(
        current, log, fields, times=tickets.history_times(good), min_valid_from=pruned, require_history=require_history,
        sizes=tickets.history_times(good), changing=changing)
    days = snapshots.asof(states, targets) if targets else snapshots.between_days(snapshots.daily_last(states), start, end)
    named = days.drop("valid_from").withColumns({"issuekey": F.col("key"), **{c: q(of) for c, of in twins.items()}})
    return snapshots.lead_columns(named.select(*sorted(named.columns)))


def refresh(
    raw: DataFrame, releases: DataFrame, panel_path: str, training_path: str,
    config: prepare.PrepareConfig = prepare.PrepareConfig(), fmt: str = "parquet", reports: str | None = None, **window,
) -> DataFrame:
    """Writes the snapshot panel, then the training table made from it; returns the latter as read back, with types.

    With `reports`, a folder, also what the panel and the training table leave out (see `refresh_reports`).
    """
    spark = raw.sparkSession
    write_table(panel_from_tickets(raw, **window), panel_path, fmt)
    panel = read_table(spark, panel_path, fmt)
    write_table(prepare.training_table(panel, releases, config=config), training_path, fmt)
    if reports:
        for name, rows in refresh_reports(raw, panel, releases, config, window.get("catalogue", DEFAULT)).items():
            write_table(rows, f"{reports}/{name}", fmt)
    # classes are names, also where all of them look like numbers
    return read_table(spark, training_path, fmt).withColumn("needed_lead_time", F.col("needed_lead_time").cast("string"))


def refresh_reports(
    raw: DataFrame, panel: DataFrame, releases: DataFrame, config: prepare.PrepareConfig = prepare.PrepareConfig(),
    catalogue: Catalogue = DEFAULT, known: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Rejected tickets with the reason (and the text of lines that do not fit, if it was kept on reading), changes that could not be used, release names without a day and, with a list of `known`
    equivalent names (var1, var2), the pairs of owner and product manager that it lacks."""
    good, bad = tickets.split_tickets(raw)
    current = tickets.flatten_current(good, catalogue, ["key", "created"])
    routed = history.normalise_changes(history.route_changes(tickets.flatten_changes(good, catalogue), catalogue), None, catalogue.seconds_per_day)
    lists = sorted({r.header for rs in catalogue.routes().values() for r in rs if r.is_list}.intersection(current.columns))
    effects = None
    if lists:
        held = current.select("key", F.inline(F.array(*[F.struct(F.lit(c).alias("header"), q(c).alias("value")) for c in lists])))
        effects = history.list_effects(held, routed.filter("is_list"))
    columns = {"epic_dev_roadmap": config.roadmap_separators, "epic_fix_version": config.version_separators}
    out = {
        "rejected": bad,
        "unresolved": history.unresolved(tickets.changed_fields(good), effects, sorted(catalogue.routes())),
        "release_errors": prepare.unknown_releases(panel, {c: s for c, s in columns.items() if c in panel.columns}, releases),
    }
    if known is not None:
        out["new_equivalences"] = history.new_equivalences(panel, "epic_owner", "epic_product_manager", known)
    return out


def planned(df: DataFrame, config: JobConfig) -> list[Unit]:
    """Units of the data; there is one row per status group, so they fit on the driver."""
    plan = units.plan_units(df, config.status, config.groups, config.ungrouped, config.include, config.exclude)
    return [Unit(r["type"], r["name"], r["slug"], tuple(r["statuses"])) for r in plan.collect()]


def model_path(unit: Unit, config: JobConfig) -> str:
    return f"{config.model_dir}/model_{unit.tag}"


def stored_params(spark: SparkSession, unit: Unit, config: JobConfig) -> tuple[FeatureParams, ForestParams]:
    """Best parameters of an earlier search, else the configured ones."""
    try:
        row = read_params(spark, f"{config.metrics_dir}/search_{unit.tag}/best_params").first()
    except AnalysisException:
        row = None
    if row is None:
        return config.features, config.forest
    known = ("n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "random_state")
    found = {k: row["rf_params"][k] for k in known if row["rf_params"] and row["rf_params"][k] is not None}
    k = row["k_features"]
    return replace(config.features, k_features=k) if k else config.features, replace(config.forest, **found)


def _unit_rows(df: DataFrame, unit: Unit, config: JobConfig) -> DataFrame:
    """Rows of the unit with a row key, without identifiers and leaks; the target as class names."""
    rows = units.segment(df, list(unit.statuses), config.status).withColumn(config.target, q(config.target).cast("string"))
    parts = [q(c).cast("string") for c in config.row_key if c in df.columns]
    return units.build_xy(rows.withColumn(ROW_KEY, F.concat_ws("|", *parts)), config.target, config.drop, [ROW_KEY])


def _classes(rows: DataFrame, target: str) -> dict[str, int]:
    return {r[target]: r["n"] for r in units.class_counts(rows, target).collect()}


def _fit_options(unit: Unit, ref: DataFrame, features: FeatureParams, forest: ForestParams, config: JobConfig) -> dict:
    return {
        "ref": units.segment(ref, list(unit.statuses), config.status), "features": features, "forest": forest,
        "cv": config.calibration_folds,
    }


def train(spark: SparkSession, training: DataFrame, ref: DataFrame, config: JobConfig) -> DataFrame:
    """Per unit: split, out-of-fold scores, fit, hold-out scores, saved model. Returns the metrics table.

    Units (a handful) are worked on side by side, and so are the out-of-fold scores and the fit of one; every step
    is a distributed job.
    """
    def trained(unit: Unit) -> tuple | None:
        rows = _unit_rows(training, unit, config).filter(q(config.target).isNotNull())
        counts = _classes(rows, config.target)
        if len(counts) < 2:
            return None
        features, forest = stored_params(spark, unit, config)
        options = _fit_options(unit, ref, features, forest, config)
        split = units.stratified_split(rows, config.target, ROW_KEY, config.test_share, config.seed, sum(counts.values())).persist()
        inside, outside = split.filter(~F.col("is_test")).drop("is_test"), split.filter("is_test").drop("is_test")
        kept = _classes(inside, config.target)
        folds = units.fold_count(list(kept.values()), config.cv_folds)

        def guessed() -> units.Metrics:
            return units.metrics(cross_predict(inside, config.target, ROW_KEY, folds, config.seed, **options), config.target, "pred")

        def fitted() -> tuple[TicketModel, units.Metrics]:
            model = TicketModel.fit(inside, config.target, ROW_KEY, **options)
            return model, units.metrics(model.transform(outside, [config.target]), config.target, "predicted_lead_time")

        oof, (model, test) = together(guessed, fitted)
        path = model_path(unit, config)
        model.save(path, spark)
        split.unpersist()
        result = (
            unit.type, unit.name, list(unit.statuses), folds, features.k_features, oof.accuracy, oof.f1_weighted,
            test.accuracy, test.f1_weighted, oof.n, test.n, path)
        write_metrics(spark.createDataFrame([result], METRICS_SCHEMA).coalesce(1), f"{config.metrics_dir}/metrics_{unit.tag}")
        return result

    results = together(*[partial(trained, unit) for unit in planned(training, config)])
    return spark.createDataFrame([r for r in results if r], METRICS_SCHEMA)


METRICS_SCHEMA = (
    "unit_type string, unit_name string, statuses array<string>, cv_folds int, k_features int, acc_oof double, f1w_oof double, "
    "acc_test double, f1w_test double, n_train long, n_test long, model_path string"
)


def load_if_there(spark: SparkSession, path: str) -> TicketModel | None:
    return TicketModel.load(spark, path) if model_versions(spark, path) else None


def predict(
    spark: SparkSession, live: DataFrame, config: JobConfig, quality_columns: Sequence[str] | None = None, at: str | None = None
) -> DataFrame | None:
    """Scored predictions of all units with a saved model, written per unit; upserts the ledger if one is set.

    `quality_columns` are the raw columns whose fill counts as data quality.
    Returns the union over units, or None if no unit has a model.
    """
    out = None
    for unit in planned(live, config):
        model = load_if_there(spark, model_path(unit, config))
        if model is None:
            continue
        rows = units.segment(live, list(unit.statuses), config.status)
        extra = [c for c in (quality_columns or ()) if c in live.columns and c not in (config.id_column, config.status)]
        keep = [config.id_column, config.status, *extra]
        guessed = model.transform(rows, keep).withColumnRenamed(config.id_column, "epic_key")
        scored = score(ledger.stamp(guessed, unit.tag, at), quality_columns).drop(*extra)
        target = f"{config.results_dir}/predictions_{unit.tag}"
        write_table(rank_rows(ledger.report_columns(scored)), target)
        part = spark.read.parquet(target)
        write_reports(part, f"{config.results_dir}/reports_{unit.tag}")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is not None and config.ledger_path:
        write_reports(update_ledger(spark, out, config.ledger_path), f"{config.results_dir}/reports_ledger")
    return out


def report_tables(scored: DataFrame) -> dict[str, DataFrame]:
    """The summaries of scored predictions by name."""
    found = {
        "classes": summaries.class_histogram(scored), "trust": summaries.trust_histogram(scored),
        "statuses": summaries.status_trust(scored), "bands": summaries.band_counts(scored),
    }
    if len(class_labels(scored)) > 1:
        found |= {"margins": summaries.margin_histogram(scored), "entropy": summaries.entropy_histogram(scored)}
    return found


def write_reports(scored: DataFrame, folder: str) -> None:
    for name, rows in report_tables(scored).items():
        write_table(rows.coalesce(1), f"{folder}/{name}")


#: Buckets of a model's rows by key; a batch rewrites those that it touches. Fixed once the ledger has been written.
LEDGER_BUCKETS = 64


def update_ledger(spark: SparkSession, batch: DataFrame, path: str, keep: int = 1, buckets: int = LEDGER_BUCKETS) -> DataFrame:
    """Upserts the batch into the buckets of the models and keys it names; no other bucket is touched. Returns the ledger.

    A bucket holds the rows of one model whose key digest falls into it, in version
    folders. The newest committed version of a bucket is read and a new one written;
    versions count once they are in the list of versions, which one write adds for
    all buckets of the batch, so a failed job leaves the ledger as it was. Of older
    versions the last `keep` stay.
    """
    known = ledger_versions(spark, path)
    buckets = next((r["buckets"] for rows in known.values() for r in rows), buckets)
    keys = ledger.pick_keys(batch.columns)
    model = F.col("model_name") if "model_name" in batch.columns else F.lit(None).cast("string")
    own = [q(k).cast("string") for k in keys if k != "model_name"]
    # rows without a key can repeat any other row, so they share one bucket
    bucket = F.pmod(F.xxhash64(*own), F.lit(buckets)).cast("int") if own else F.lit(0)
    placed = batch.withColumns({"part": part_name(model), "bucket": bucket})
    touched = [(r["part"], r["bucket"]) for r in placed.select("part", "bucket").distinct().collect()]  # models x buckets at most
    old_paths = [_version_path(path, *t, known[t][-1]["version"]) for t in touched if t in known]
    if old_paths:
        old = spark.read.option("mergeSchema", "true").parquet(*old_paths)
        merged = ledger.upsert(old, batch, order=["last_prediction_at"], old_unique=True)
    else:
        merged = ledger.last_per_key(batch, keys, ["last_prediction_at"]) if keys else batch.dropDuplicates()
    version = 1 + max((r["version"] for rows in known.values() for r in rows), default=0)
    model = F.col("model_name") if "model_name" in merged.columns else F.lit(None).cast("string")
    spread = merged.withColumns({"part": part_name(model), "bucket": bucket}).hint("rebalance", "part", "bucket")
    spread.write.partitionBy("part", "bucket").parquet(f"{path}/rows/version={version}")
    spark.createDataFrame([(*t, version, buckets) for t in touched], VERSIONS).coalesce(1).write.mode("append").json(f"{path}/versions")
    for t in touched:
        for gone in known.get(t, [])[: -keep if keep else None][-1:]:
            remove_folder(spark, _version_path(path, *t, gone["version"]))
    return read_ledger(spark, path)


VERSIONS = "part string, bucket int, version int, buckets int"


def part_name(model: Column) -> Column:
    """Folder of a model: a digest of its name, so that any name makes a folder."""
    return F.coalesce(F.md5(model), F.lit("no-model"))


def _version_path(path: str, part: str, bucket: int, version: int) -> str:
    return f"{path}/rows/version={version}/part={part}/bucket={bucket}"


def ledger_versions(spark: SparkSession, path: str) -> dict[tuple[str, int], list]:
    """Committed versions of each bucket, oldest first."""
    try:
        rows = spark.read.schema(VERSIONS).json(f"{path}/versions").collect()  # models x buckets x batches
    except AnalysisException:
        return {}
    out: dict[tuple[str, int], list] = {}
    for r in sorted(rows, key=lambda r: r["version"]):
        out.setdefault((r["part"], r["bucket"]), []).append(r)
    return out


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest rows of all buckets, rescored over all their classes, row by row; None for a ledger never written."""
    paths = [_version_path(path, *t, rows[-1]["version"]) for t, rows in sorted(ledger_versions(spark, path).items())]
    return ledger.rescore(spark.read.option("mergeSchema", "true").parquet(*paths)) if paths else None


def draws(space: SearchSpace, trials: int, seed: int) -> list[tuple[int, ForestParams]]:
    """Seeded random draws from the search space."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        k = rng.choice(list(space.k_features))
        out.append((k, ForestParams(
            n_estimators=rng.choice(list(space.n_estimators)), max_depth=rng.choice(list(space.max_depth)),
            min_samples_split=rng.choice(list(space.min_samples_split)), min_samples_leaf=rng.choice(list(space.min_samples_leaf)),
            max_features=rng.choice(list(space.max_features)), random_state=seed)))
    return out


TRIAL_SCHEMA = (
    "number int, f1w double, acc double, k_features int, n_estimators int, max_depth int, min_samples_split int, min_samples_leaf int, "
    "max_features string, random_state int"
)


def search(
    df: DataFrame, y: str, key: str, space: SearchSpace = SearchSpace(), trials: int = 40, seed: int = 42, folds: int = 10,
    features: FeatureParams = FeatureParams(), **fit,
) -> DataFrame:
    """Trials with their mean weighted F1 and accuracy over the folds, one row each.

    Encoders and feature scores are fitted once per fold and shared; a trial is a
    cut of each fold's ranking and a forest.
    """
    drawn = draws(space, trials, seed)
    ref, cv = fit.get("ref"), fit.get("cv", 5)
    shared = SharedFolds.prepare(df, y, key, folds, seed, max((k for k, _ in drawn), default=0), ref, features)
    rows = []
    for number, (k, forest) in enumerate(drawn):
        scores = shared.trial(k, forest, cv)
        f1 = sum(s.f1_weighted for s in scores) / len(scores)
        acc = sum(s.accuracy for s in scores) / len(scores)
        tried = {name: v for name, v in asdict(forest).items() if name != "bootstrap"}
        rows.append((number, f1, acc, k, *tried.values()))
    shared.release()
    return df.sparkSession.createDataFrame(rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest weighted F1, the earliest on ties."""
    rank = F.struct("f1w", (-F.col("number")).alias("earlier"))
    return trials.agg(F.max_by(F.struct(*trials.columns), rank).alias("best")).select("best.*")


def tune(
    spark: SparkSession, training: DataFrame, ref: DataFrame, config: JobConfig, space: SearchSpace = SearchSpace(), trials: int = 40
) -> DataFrame:
    """Per unit: search, stored trials and best parameters, model refitted on all rows. Returns the best trials."""
    out = None
    for unit in planned(training, config):
        rows = _unit_rows(training, unit, config).filter(q(config.target).isNotNull())
        counts = _classes(rows, config.target)
        if len(counts) < 2:
            continue
        options = _fit_options(unit, ref, config.features, config.forest, config)
        options.pop("forest")
        tried = search(rows, config.target, ROW_KEY, space, trials, config.seed, config.cv_folds, **options)
        folder = f"{config.metrics_dir}/search_{unit.tag}"
        write_table(tried, f"{folder}/trials")
        best = best_trial(tried)
        params = [c for c in best.columns if c not in ("number", "f1w", "acc", "k_features")]
        stored = best.select(
            F.lit(unit.type).alias("unit_type"), F.lit(unit.name).alias("unit_name"), F.lit(units.fold_count(list(counts.values()), config.cv_folds)).alias("cv_folds"),
            F.col("f1w").alias("best_f1w"), F.col("acc").alias("best_acc"), F.lit(trials).alias("n_trials"),
            F.struct("k_features", F.struct(*params).alias("rf_params")).alias("best_params"))
        write_metrics(stored.coalesce(1), f"{folder}/best_params")
        features, forest = stored_params(spark, unit, config)
        model = TicketModel.fit(rows, config.target, ROW_KEY, **{**options, "features": features, "forest": forest})
        model.save(model_path(unit, config), spark)
        part = best.withColumn("unit_name", F.lit(unit.name))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], TRIAL_SCHEMA + ", unit_name string")
