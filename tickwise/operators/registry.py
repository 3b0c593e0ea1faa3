"""Model registry (J14) as a small versioned table.

Each change writes a complete new snapshot (data under ``<base>/data/<name>``) and then puts the next record into
the log ``<base>/log``; the record names the snapshot. The newest record is the table. A record can be
put once: of two writers that started from the same snapshot the second one loses, reads the
winner's snapshot and applies its change to that. So no change is lost, a reader
never sees half of one, and promotion leaves one active row whoever else writes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.sources import commits

# Fixed value from the reference: minimum F1 gain for auto-promotion.
AUTO_PROMOTE_THRESHOLD = 0.01
SCHEMA = ("model_name string, version string, ticker string, accuracy double, "
          "precision_score double, recall double, f1 double, trained_at timestamp, "
          "is_active boolean, model_path string")
ATTEMPTS = 50


class ModelRegistry:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _newest(self) -> tuple[int, DataFrame]:
        """Number of the newest snapshot (-1: none) and its rows."""
        log = commits.names(self.spark, f"{self.base}/log")
        if not log:
            return -1, self.spark.createDataFrame([], SCHEMA)
        name = commits.read(self.spark, f"{self.base}/log/{log[-1]}")["data"]
        return int(log[-1].split(".")[0]), self.spark.read.schema(SCHEMA).parquet(f"{self.base}/data/{name}")

    def table(self) -> DataFrame:
        return self._newest()[1]

    def _change(self, change: Callable[[DataFrame], DataFrame | None]) -> bool:
        """Applies ``change`` to the newest snapshot until its record is the next one; None leaves the table as it is."""
        for _ in range(ATTEMPTS):
            number, rows = self._newest()
            out = change(rows)
            if out is None:
                return False
            name = uuid.uuid4().hex
            out.coalesce(1).write.parquet(f"{self.base}/data/{name}")      # a row for each model
            if commits.put_if_absent(self.spark, f"{self.base}/log/{number + 1:09d}.json", {"data": name}):
                return True
        raise RuntimeError(f"another writer came first {ATTEMPTS} times")

    def register(self, model_name: str, metrics: dict, model_path: str, ticker: str = "",
                 version: str | None = None) -> str:
        """Add an inactive row; version = UTC seconds plus ticker (unique)."""
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        version = version or f"{now.strftime('%Y%m%d%H%M%S')}-{ticker or model_name}"
        row = self.spark.createDataFrame(
            [(model_name, version, ticker, float(metrics.get("accuracy", 0.0)),
              float(metrics.get("precision", 0.0)), float(metrics.get("recall", 0.0)),
              float(metrics.get("f1", 0.0)), now, False, model_path)], SCHEMA)
        self._change(lambda rows: rows.unionByName(row))
        return version

    def register_all(self, models: DataFrame) -> None:
        """Adds a table of models (columns of the registry without ``is_active``) as inactive rows, in one change."""
        names = [f.strip().split()[0] for f in SCHEMA.split(",")]
        self._change(lambda rows: rows.unionByName(models.withColumn("is_active", F.lit(False)).select(*names)))

    def active(self) -> DataFrame:
        return self.table().filter(F.col("is_active")).limit(1)

    def _promoted(self, rows: DataFrame, version: str) -> DataFrame | None:
        if rows.filter(F.col("version") == version).isEmpty():
            return None
        return rows.withColumn("is_active", F.col("version") == version)

    def promote(self, version: str) -> bool:
        return self._change(lambda rows: self._promoted(rows, version))

    def auto_promote_if_better(self, version: str, new_f1: float,
                               threshold: float = AUTO_PROMOTE_THRESHOLD) -> bool:
        """Promotes if no model is active or the gain exceeds the threshold; decided on the snapshot that is replaced."""
        def change(rows: DataFrame) -> DataFrame | None:
            current = rows.filter(F.col("is_active")).select("f1").head()
            if current is not None and not new_f1 - float(current["f1"]) > threshold:
                return None
            return self._promoted(rows, version)

        return self._change(change)

    def list_models(self) -> DataFrame:
        return self.table().orderBy(F.col("trained_at").desc())
