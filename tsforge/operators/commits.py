"""Datasets that several exports write at the same time: an optimistic log of numbered commits.

A run writes its facts under a folder of its own and a manifest, a row for each
partition and variable, beside them. Nobody reads either before a commit names
the run: a file ``_log/<number>.json`` that only one writer can create. A writer
that finds its number taken looks at what was committed since it began; if those
runs hold none of its partitions it takes the next number, else its policy says
whether that is an error, whether its own partitions are left out, or whether
they replace the others. So runs that are cut short anywhere leave nothing that is
read, and all commits are one serial order.

Readers take a snapshot: a number, and for each partition the last run up to it.
Conflicts and snapshots are joins of manifests; the driver reads one small file for
each commit. Partitions of null keys are partitions of their own.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tsforge.functions import times
from tsforge.operators import catalog
from tsforge.operators.store import FACT_KEYS, OPTIONS, Files

KEYS = ("sensor", "vsn", "instrument_id", "date")
POLICIES = ("error", "skip", "replace")


class Conflict(FileExistsError):
    """A partition was committed by another run."""


@dataclass(frozen=True)
class Commit:
    number: int
    run_id: str
    manifest: str
    identity: dict


class Dataset:
    """Facts under ``root`` with their log."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    # ------------------------------------------------------------ the log

    def _path(self, number: int) -> str:
        return f"{self.root}/_log/{number:020d}.json"

    def latest(self) -> int:
        """The last number of the log; zero if nothing was committed."""
        return max((int(n.split(".")[0]) for n in self.files.names(f"{self.root}/_log") if n.endswith(".json")), default=0)

    def commits(self, after: int = 0, to: int | None = None) -> list[Commit]:
        to = self.latest() if to is None else to
        return [Commit(n, **json.loads(self.files.read_text(self._path(n)))) for n in range(after + 1, to + 1)]

    def _manifests(self, commits: list[Commit]) -> DataFrame | None:
        """What commits hold, with their numbers and runs."""
        if not commits:
            return None
        rows = self.spark.read.parquet(*[f"{self.root}/{c.manifest}" for c in commits])
        named = self.spark.createDataFrame([(c.number, c.run_id) for c in commits], "number long, run_id string")
        return rows.join(F.broadcast(named), "run_id")

    # ------------------------------------------------------------ reading

    def partitions(self, number: int | None = None) -> DataFrame | None:
        """Each partition's variables as of a snapshot, with run and number."""
        rows = self._manifests(self.commits(0, number))
        if rows is None:
            return None
        last = Window.partitionBy(*KEYS)
        return rows.withColumn("_last", F.max("number").over(last)).filter(F.col("number") == F.col("_last")).drop("_last")

    def facts(self, number: int | None = None) -> DataFrame | None:
        """The facts of a snapshot; what was replaced is not listed, or is pruned by its run."""
        live = self.partitions(number)
        if live is None:
            return None
        wanted = live.select("run_id", *KEYS).distinct()
        runs = sorted(r.run_id for r in wanted.select("run_id").distinct().collect())
        rows = self.spark.read.option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/run={r}" for r in runs])
        text = [F.col(c).cast("string").alias(c) for c in rows.columns if c in ("run", "sensor", "vsn", "date")]
        rows = rows.select(*[c for c in rows.columns if c not in ("run", "sensor", "vsn", "date", "instrument")], *text)
        same = (F.col("run") == F.col("_run")) & F.col("instrument_id").eqNullSafe(F.col("_instrument_id"))
        for k in ("sensor", "vsn", "date"):
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        marks = wanted.select(F.col("run_id").alias("_run"), *[F.col(k).cast("string").alias(f"_{k}") for k in KEYS])
        return rows.join(marks, same, "left_semi").drop("run")

    # ------------------------------------------------------------ writing

    def _stage(self, facts: DataFrame, run_id: str) -> str:
        rows = facts.withColumns({"instrument": F.col("instrument_id"), "date": F.date_format(times.date_of(F.col("time_ns")), "yyyy-MM-dd")})
        rows.hint("rebalance", *map(F.col, FACT_KEYS)).write.mode("overwrite").options(**OPTIONS).partitionBy(*FACT_KEYS).parquet(f"{self.root}/data/run={run_id}")
        path = f"_manifests/{run_id}"
        stats = catalog.partition_variables(facts).withColumns({"date": F.date_format("date", "yyyy-MM-dd"), "run_id": F.lit(run_id)})
        stats.write.mode("overwrite").options(**OPTIONS).parquet(f"{self.root}/{path}")
        return path

    def _without(self, path: str, met: DataFrame) -> str:
        """A manifest that leaves out the partitions which another run has."""
        rows = self.spark.read.parquet(f"{self.root}/{path}")
        left = rows.join(met, [rows[k].eqNullSafe(met[f"_{k}"]) for k in KEYS], "left_anti")
        smaller = f"{path}~"
        left.write.mode("overwrite").options(**OPTIONS).parquet(f"{self.root}/{smaller}")
        return smaller

    def _settled(self, path: str, since: list[Commit], identity: dict, policy: str) -> str:
        """The manifest that may follow these commits, or an error."""
        others = self._manifests(since)
        if others is None:
            return path
        ours = self.spark.read.parquet(f"{self.root}/{path}").select(*KEYS).distinct()
        theirs = others.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("run_id").alias("_run_id")).distinct()
        met = theirs.join(ours, [ours[k].eqNullSafe(theirs[f"_{k}"]) for k in KEYS], "left_semi")
        runs = {r["_run_id"] for r in met.select("_run_id").distinct().collect()}
        if not runs or policy == "replace":
            return path
        if policy == "error":
            raise Conflict(f"partitions of {sorted(runs)} are there")
        if other := [c.run_id for c in since if c.run_id in runs and c.identity != identity]:
            raise Conflict(f"{other} were made from other inputs or rules")
        return self._without(path, met)

    def publish(self, facts: DataFrame, run_id: str, identity: dict | None = None, policy: str = "error", attempts: int = 100) -> int:
        """Writes and commits a run's facts; the number of its commit. A run that was committed already is not written again."""
        if policy not in POLICIES:
            raise ValueError(f"the policy is one of {POLICIES}")
        identity = identity or {}
        known = self.commits()
        if done := [c.number for c in known if c.run_id == run_id]:
            return done[0]
        path = self._stage(facts, run_id)
        seen = 0
        for attempt in range(attempts):
            since = self.commits(seen)
            path = self._settled(path, since, identity, policy)
            seen = since[-1].number if since else seen
            try:
                self.files.create_new(self._path(seen + 1), json.dumps({"run_id": run_id, "manifest": path, "identity": identity}, sort_keys=True))
                return seen + 1
            except FileExistsError:
                time.sleep(min(0.01 * 2**attempt, 1))
        raise TimeoutError(f"{run_id}: others were first {attempts} times")

    def abandoned(self) -> list[str]:
        """Runs with data that no commit names: of writers at work, or cut short."""
        known = {c.run_id for c in self.commits()}
        return [n for n in (x.removeprefix("run=") for x in self.files.names(f"{self.root}/data")) if n not in known]

    def vacuum(self, runs: list[str]) -> None:
        """Deletes what abandoned runs left; the caller knows that they are no longer at work."""
        if alive := set(runs) - set(self.abandoned()):
            raise ValueError(f"committed: {sorted(alive)}")
        for run in runs:
            for path in (f"data/run={run}", f"_manifests/{run}", f"_manifests/{run}~"):
                self.files.delete(f"{self.root}/{path}")
