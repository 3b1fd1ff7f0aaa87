"""Runs of several stages that go on where they stopped: a graph of stages, a checkpoint for each run and stage, outputs by run.

A stage is finished for a run when its checkpoint says "completed" and no stage that it needs was completed later. Outputs and
checkpoints are partitioned by run and written by dynamic overwrite, so a stage that is repeated replaces what it left behind, and a run
that was killed at any point ends as one that was not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.upsert import set_checkpoints
from leadloom.sources.retention import _exists, _write

CHECKPOINT = "run_id string, stage_key string, status string, started_at timestamp, completed_at timestamp, meta map<string,string>, updated_at timestamp"


def checkpoint(checkpoints: DataFrame, run_id: str, stage_key: str) -> DataFrame:
    """The checkpoint of a run's stage: one row, or none; a missing meta is an empty one."""
    found = checkpoints.where((F.col("run_id") == run_id) & (F.col("stage_key") == stage_key))
    meta = F.coalesce("meta", F.create_map().cast("map<string,string>"))
    return found.select("status", "started_at", "completed_at", meta.alias("meta"), "updated_at")


@dataclass(frozen=True)
class Stage:
    """``build`` makes a stage's rows from those of the stages it needs, by key."""

    key: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()


def stage_states(runs: DataFrame, stages: list[Stage], checkpoints: DataFrame) -> DataFrame:
    """run_id, stage_key, place, status and state of each stage of each run: "done", "ready" to run now, or "waiting" for a stage before.

    ``stages`` stand in an order in which each comes after those it needs. A completed stage counts as done only while all that it
    needs are completed and none of them later than itself.
    """
    entries = [F.struct(F.lit(s.key).alias("stage_key"), F.lit(k).alias("place"), F.array(*map(F.lit, s.needs)).cast("array<string>").alias("needs")) for k, s in enumerate(stages)]
    at = checkpoints.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("stage_key", F.struct("status", "completed_at")))).alias("at"))  # as many as stages
    named = runs.select("run_id").distinct().join(at, "run_id", "left")

    def settle(done: Column, stage: Column) -> Column:
        """``done`` (stage_key to the time since when it holds) with ``stage``, if it is done too."""
        mine = F.try_element_at(F.col("at"), stage["stage_key"])
        fresh = F.forall(stage["needs"], lambda n: F.coalesce(F.try_element_at(done, n) <= mine["completed_at"], F.lit(False)))
        entry = F.map_from_arrays(F.array(stage["stage_key"]), F.array(mine["completed_at"]))
        return F.when((mine["status"] == "completed") & mine["completed_at"].isNotNull() & fresh, F.map_concat(done, entry)).otherwise(done)

    done = F.aggregate(F.array(*entries), F.create_map().cast("map<string,timestamp>"), settle)
    rows = named.select("run_id", "at", done.alias("done"), F.explode(F.array(*entries)).alias("s"))
    has = lambda key: F.map_contains_key("done", key)
    state = F.when(has(F.col("s.stage_key")), "done").when(F.forall("s.needs", has), "ready").otherwise("waiting")
    return rows.select("run_id", "s.stage_key", "s.place", F.try_element_at("at", F.col("s.stage_key"))["status"].alias("status"), state.alias("state"))


@dataclass
class StageGraph:
    """Stages in an order in which each stands after those it needs, their outputs and checkpoints under ``root``."""

    spark: SparkSession
    root: str
    stages: list[Stage]
    ran: list[str] = field(default_factory=list)

    def __post_init__(self):
        known: set[str] = set()
        for s in self.stages:
            if s.key in known or not known.issuperset(s.needs):
                raise ValueError(f"{s.key}: named twice, or before a stage that it needs")
            known.add(s.key)

    def checkpoints(self) -> DataFrame:
        path = f"{self.root}/checkpoints"
        return self.spark.read.schema(CHECKPOINT).parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], CHECKPOINT)

    def left(self, run_id: str) -> list[str]:
        """Stages of a run that are not done, in order."""
        one = self.spark.createDataFrame([(run_id,)], "run_id string")
        states = stage_states(one, self.stages, self.checkpoints()).where("state <> 'done'").orderBy("place")
        return [r.stage_key for r in states.collect()]  # a row for each stage

    def output(self, key: str, run_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/stage={key}/run_id={run_id}")

    def run(self, run_id: str, as_of: Callable[[], Column]) -> DataFrame:
        """All stages that are left; the last one's rows. ``as_of`` gives the time of each checkpoint, later ones later."""
        for stage in [s for s in self.stages if s.key in self.left(run_id)]:
            self._set(run_id, stage.key, "started", as_of(), {})
            try:
                rows = stage.build({k: self.output(k, run_id) for k in stage.needs})
                rows.write.mode("overwrite").parquet(f"{self.root}/stage={stage.key}/run_id={run_id}")
            except Exception as error:
                self._set(run_id, stage.key, "failed", as_of(), {"error": str(error)[:500]})
                raise
            self._set(run_id, stage.key, "completed", as_of(), {"rows": str(self.output(stage.key, run_id).count()), "error": ""})
            self.ran.append(stage.key)
        return self.output(self.stages[-1].key, run_id)

    def _set(self, run_id: str, key: str, status: str, at: Column, meta: dict[str, str]) -> None:
        new = self.spark.createDataFrame([(run_id, key, status, meta)], "run_id string, stage_key string, status string, meta map<string,string>")
        merged = set_checkpoints(self.checkpoints().where(F.col("run_id") == run_id), new, at.cast("timestamp"))
        fresh = self.spark.createDataFrame(merged.collect(), CHECKPOINT)  # a row for each stage; they replace the files they were read from
        _write(fresh.coalesce(1), f"{self.root}/checkpoints", "run_id")
