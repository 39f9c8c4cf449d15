"""A catalog of series that is kept: sorted fragments in levels, merged when a level is full.

An export adds a fragment with its own series, a row for each series and part (a
partition of the facts). Of a part, the rows of its last version count, so a
replaced partition takes back what it said before, and ``retract`` takes back parts
that are gone. ``FANOUT`` fragments of a level are merged to one of the next: what
was replaced is dropped there, and each row is written once for each level, so the
work of an export goes with its own series and not with the catalog. The list of
fragments is a numbered file that one writer can create; a merge or an addition
that is cut short leaves a folder that no list names.

Asked for, the catalog is the merge of its few fragments: wider times, united
fields and types, one identity for each id or an error.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.operators import catalog
from tsforge.operators.store import OPTIONS, Files

#: Fragments of a level that become one of the next.
FANOUT = 4
PART = ("sensor", "vsn", "instrument_id", "date")
#: What the rows of one id must agree on.
IDENTITY = ("measurement", "identity_source")
COLUMNS = ("series_id", *PART, *IDENTITY, "fields", "value_types", "minimum_time", "maximum_time")


def rows_of(facts: DataFrame) -> DataFrame:
    """The series of identified points in each of their partitions."""
    from tsforge.functions import times

    sets = [F.sort_array(F.collect_set(c)).alias(n) for c, n in (("field", "fields"), ("value_type", "value_types"))]
    keyed = facts.withColumn("date", F.date_format(times.date_of(F.col("time_ns")), "yyyy-MM-dd"))
    return keyed.groupBy("series_id", *PART, *IDENTITY).agg(*sets, F.min("time_ns").alias("minimum_time"), F.max("time_ns").alias("maximum_time")).select(*COLUMNS)


class KeptSeries:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _state(self) -> tuple[int, dict]:
        numbers = [int(n.split(".")[0]) for n in self.files.names(f"{self.root}/_lists") if n.endswith(".json")]
        n = max(numbers, default=0)
        return n, json.loads(self.files.read_text(f"{self.root}/_lists/{n:020d}.json")) if n else {"fragments": [], "version": 0}

    def _read(self, fragments: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{f['path']}" for f in fragments])

    def _write(self, rows: DataFrame, level: int) -> dict:
        path = f"level-{level}/{uuid.uuid4().hex}"
        rows.sortWithinPartitions("series_id").write.options(**OPTIONS).parquet(f"{self.root}/{path}")
        return {"path": path, "level": level, "rows": self.spark.read.parquet(f"{self.root}/{path}").count()}

    @staticmethod
    def _last(rows: DataFrame) -> DataFrame:
        """Of each part the rows of its last version."""
        tops = rows.groupBy(*PART).agg(F.max("version").alias("_top")).select(*[F.col(c).alias(f"_{c}") for c in PART], "_top")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PART])
        return rows.join(tops, same).filter(F.col("version") == F.col("_top")).drop("_top", *(f"_{c}" for c in PART))

    def _settle(self, state: dict) -> dict:
        """Full levels merged to fragments of the next."""
        fragments, level = state["fragments"], 0
        while any(f["level"] >= level for f in fragments):
            own = [f for f in fragments if f["level"] == level]
            if len(own) >= FANOUT:
                oldest = not any(f["level"] > level for f in fragments)
                rows = self._last(self._read(own))
                # nothing older is left that a row without a series would take back
                merged = self._write(rows.filter("series_id is not null") if oldest else rows, level + 1)
                fragments = [f for f in fragments if f["level"] != level] + [merged]
            level += 1
        return state | {"fragments": fragments}

    def _add(self, rows: DataFrame) -> int:
        for _ in range(100):
            n, state = self._state()
            version = state["version"] + 1
            added = self._write(rows.withColumn("version", F.lit(version).cast("long")), 0)
            state = self._settle({"fragments": [*state["fragments"], added], "version": version})
            try:
                self.files.create_new(f"{self.root}/_lists/{n + 1:020d}.json", json.dumps(state))
                return n + 1
            except FileExistsError:  # another writer was first: its version comes before this one
                continue
        raise TimeoutError("others were first a hundred times")

    def add(self, rows: DataFrame) -> int:
        """Rows of series and parts (``rows_of``), in place of what these parts said before."""
        return self._add(rows.select(*COLUMNS))

    def retract(self, parts: DataFrame) -> int:
        """Takes back all that parts said."""
        kinds = {f.name: f.dataType for f in self._read(self._state()[1]["fragments"]).schema}
        return self._add(parts.select(*[F.col(c) if c in PART else F.lit(None).cast(kinds[c]).alias(c) for c in COLUMNS]).distinct())

    def fragments(self) -> list[dict]:
        return self._state()[1]["fragments"]

    def series(self) -> DataFrame | None:
        """The catalog: one row for each series."""
        known = self.fragments()
        if not known:
            return None
        live = self._last(self._read(known)).filter("series_id is not null")
        return catalog.merge_series(live, "sensor", "vsn", "instrument_id", *IDENTITY)
