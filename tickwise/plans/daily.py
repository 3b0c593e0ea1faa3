"""K9 daily job: ingest -> quality gate -> features -> train/select -> refit -> register/promote.

One Spark application; tables are the hand-off between steps. Each step's outputs lie in a folder of the attempt
that wrote them, and a step is done when its record stands in the run's manifest (``commits``: atomic, once). The
record names the outputs and holds the step's figures, so a job that was broken off goes on after its last
finished step, whatever the broken step had written, and a step can be run again alone by a new run. A
failed critical quality check stops the run (``DataQualityError``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import folds as fo
from tickwise.operators import indicators as ind
from tickwise.operators import models, prep, quality, refit
from tickwise.operators.registry import ModelRegistry
from tickwise.operators.training import training_frame
from tickwise.session import checkpoint_dir
from tickwise.sources import commits
from tickwise.sources.sinks import append_partitioned, insert_if_absent, read_or_empty

STEPS = ("ingest", "quality", "features", "folds", "select", "refit", "register")
PRICES = "ticker string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, run string, attempt string, year int"


class DailyRun:
    """One run of the job over ``base``; ``run`` names it (a repeated name resumes it)."""

    def __init__(self, spark: SparkSession, base: str, run: str):
        self.spark, self.base, self.run = spark, base, run
        self.attempt = uuid.uuid4().hex

    def _record(self, step: str, run: str | None = None) -> str:
        return f"{self.base}/manifest/{run or self.run}/{STEPS.index(step)}-{step}.json"

    def done(self, step: str) -> dict | None:
        path = self._record(step)
        return commits.read(self.spark, path) if commits.exists(self.spark, path) else None

    def step(self, step: str, work: Callable[[str], dict]) -> dict:
        """The record of ``step``; ``work(folder for outputs)`` runs if there is none yet."""
        found = self.done(step)
        if found is None:
            folder = f"{self.base}/{step}/{self.run}-{self.attempt}"
            commits.put_if_absent(self.spark, self._record(step), {"outputs": folder, "attempt": self.attempt, "run": self.run, **work(folder)})
            found = self.done(step)
        return found

    def prices(self) -> DataFrame:
        """Rows of all finished ingest steps: (run, attempt) stands in their records."""
        rows = read_or_empty(self.spark, f"{self.base}/raw_prices", PRICES)
        runs = commits.names(self.spark, f"{self.base}/manifest")
        finished = [(r["run"], r["attempt"]) for x in runs if commits.exists(self.spark, self._record("ingest", x))
                    for r in [commits.read(self.spark, self._record("ingest", x))]]
        log = self.spark.createDataFrame(finished, "run string, attempt string")
        return rows.join(log, ["run", "attempt"], "left_semi").drop("run", "attempt", "year")


def run_daily(spark: SparkSession, new_bars: DataFrame, base: str | None = None, now=None,
              min_rows: int = 1000, run: str | None = None) -> DataFrame:
    """Returns a one-row-per-figure summary (step, value)."""
    base = base or f"{checkpoint_dir(spark)}/daily/{uuid.uuid4().hex}"
    job = DailyRun(spark, base, run or uuid.uuid4().hex)
    cols = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]

    def ingest(folder: str) -> dict:
        batch = new_bars.select(*cols).withColumn("_arrival", F.lit(0))
        new = insert_if_absent(batch, job.prices(), ["ticker", "timestamp"], ["_arrival"]).drop("_arrival")
        marked = new.withColumns({"run": F.lit(job.run), "attempt": F.lit(job.attempt)})
        append_partitioned(marked, f"{base}/raw_prices")
        mine = read_or_empty(spark, f"{base}/raw_prices", PRICES).filter((F.col("run") == job.run) & (F.col("attempt") == job.attempt))
        return {"inserted": mine.count()}

    inserted = job.step("ingest", ingest)["inserted"]
    prices = job.prices()

    def gate(folder: str) -> dict:
        clock = now or datetime.now(timezone.utc).replace(tzinfo=None)     # the clock, never the data's own last day
        quality.enforce(quality.quality_gate(prices, clock, min_rows=min_rows))
        return {}

    job.step("quality", gate)

    def features(folder: str) -> dict:
        ind.technical_features(prices, keep_warmup=False).write.parquet(folder)
        return {"rows": spark.read.parquet(folder).count()}

    made = job.step("features", features)
    feats = spark.read.parquet(made["outputs"])

    def folds(folder: str) -> dict:
        train = training_frame(prices, feats)
        train.write.parquet(f"{folder}/train")
        prepared, _ = prep.prepare_folds(fo.assign_folds(train), ind.FEATURE_COLUMNS)
        prepared.write.parquet(f"{folder}/prepared")
        return {"train_rows": spark.read.parquet(f"{folder}/train").count(),
                "folds": spark.read.parquet(f"{folder}/prepared").select("ticker", "fold").distinct().count()}

    fold_record = job.step("folds", folds)
    train = spark.read.parquet(f"{fold_record['outputs']}/train")

    def select(folder: str) -> dict:
        preds = models.all_fold_predictions(spark.read.parquet(f"{fold_record['outputs']}/prepared"), ind.FEATURE_COLUMNS)
        models.fold_metrics(preds).write.parquet(f"{folder}/metrics")
        best = models.select_best(spark.read.parquet(f"{folder}/metrics"))
        top = best.filter(F.col("model") == F.col("best_model")).first()      # one row: the best model over all tickers
        return {"model": top and top["model"], **{k: top[k] for k in ("accuracy", "precision", "recall", "f1") if top}}

    chosen = job.step("select", select)
    summary = [("inserted_rows", float(inserted)), ("feature_rows", float(made["rows"])), ("train_rows", float(fold_record["train_rows"])),
               ("folds", float(fold_record["folds"]))]
    if chosen["model"]:
        def fit(folder: str) -> dict:
            refit.refit(train, ind.FEATURE_COLUMNS, chosen["model"], folder)
            return {}

        path = job.step("refit", fit)["outputs"]

        def register(folder: str) -> dict:
            reg = ModelRegistry(spark, f"{base}/model_registry")
            version = f"{job.run}-{chosen['model']}"
            if reg.table().filter(F.col("version") == version).isEmpty():      # a broken-off attempt may have come this far
                reg.register(chosen["model"], chosen, path, version=version)
            reg.auto_promote_if_better(version, float(chosen["f1"]))
            return {"version": version, "promoted": not reg.active().filter(F.col("version") == version).isEmpty()}

        registered = job.step("register", register)
        summary += [("best_f1", float(chosen["f1"])), ("promoted", float(registered["promoted"]))]
    return spark.createDataFrame(summary, "step string, value double")
