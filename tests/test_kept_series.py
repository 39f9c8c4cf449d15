"""A kept catalog of series against the merge of all that is there."""

import random

import pytest
from pyspark.sql import functions as F

from tsforge.operators import kept_series
from tsforge.operators.kept_series import COLUMNS, KeptSeries

SCHEMA = "series_id binary, sensor string, vsn string, instrument_id string, date string, measurement string, identity_source string, fields array<string>, value_types array<string>, minimum_time long, maximum_time long"


def rows_of(rng, part, n=6):
    day, vsn = part
    return [(bytes([i, vsn]), "s", f"W{vsn}", f"i{vsn}", f"2025-01-{day:02d}", f"m{i}", "vsn+sensor", sorted(rng.sample(["a", "b", "c"], rng.choice([1, 2]))), ["float64"], day * 100 + rng.randrange(50), day * 100 + 50 + rng.randrange(50)) for i in rng.sample(range(10), n)]


def whole(held):
    out = {}
    for rows in held.values():
        for r in rows:
            a = out.setdefault(r[0], [set(), 10**9, -(10**9)])
            a[0] |= set(r[7])
            a[1], a[2] = min(a[1], r[9]), max(a[2], r[10])
    return {k: (sorted(f), a, b) for k, (f, a, b) in out.items()}


def found(kept):
    rows = kept.series()
    return {} if rows is None else {bytes(r.series_id): (list(r.fields), r.minimum_time, r.maximum_time) for r in rows.collect()}


def test_additions_replacements_and_retractions_equal_a_full_merge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kept_series, "FANOUT", 3)
    rng, kept, held, wrote, added = random.Random(2), KeptSeries(spark, str(tmp_path)), {}, 0, 0
    real = KeptSeries._write

    def counted(self, rows, level):
        nonlocal wrote
        made = real(self, rows, level)
        wrote += made["rows"]
        return made

    monkeypatch.setattr(KeptSeries, "_write", counted)
    assert kept.series() is None
    for step in range(14):
        parts = [(rng.randrange(1, 20) if step % 3 else step + 1, rng.randrange(2)) for _ in range(2)]
        if step in (6, 11):
            gone = sorted(held)[:2]
            kept.retract(spark.createDataFrame([("s", f"W{v}", f"i{v}", f"2025-01-{d:02d}") for d, v in gone], "sensor string, vsn string, instrument_id string, date string"))
            for part in gone:
                del held[part]
            continue
        new = {p: rows_of(rng, p) for p in parts}
        held |= new
        rows = [r for own in new.values() for r in own]
        added += len(rows)
        kept.add(spark.createDataFrame(rows, SCHEMA))
        if step in (0, 5, 7, 13):
            assert found(kept) == whole(held)
    assert found(kept) == whole(held)
    levels = {f["level"] for f in kept.fragments()}
    assert max(levels) >= 2 and len(kept.fragments()) <= 2 * (max(levels) + 1)
    assert wrote <= (added + 4) * (max(levels) + 1)  # each row once for each level, however many are there


def test_identities_must_agree_and_a_merge_cut_short_is_not_seen(spark, tmp_path, monkeypatch):
    kept, rng = KeptSeries(spark, str(tmp_path)), random.Random(1)
    rows = rows_of(rng, (1, 0))
    kept.add(spark.createDataFrame(rows, SCHEMA))
    before = found(kept)
    with monkeypatch.context() as m:
        m.setattr(kept.files, "create_new", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            kept.add(spark.createDataFrame(rows_of(rng, (2, 0)), SCHEMA))
    assert found(kept) == before
    other = [tuple("other" if COLUMNS[i] == "measurement" else "2025-01-09" if COLUMNS[i] == "date" else x for i, x in enumerate(rows[0]))]
    kept.add(spark.createDataFrame(other, SCHEMA))
    with pytest.raises(Exception, match="disagree"):
        kept.series().collect()


def test_rows_of_points(spark):
    points = spark.createDataFrame([(b"x", "s", "v", "i", "m", "src", f, "float64", t * 86_400 * 10**9) for f, t in (("a", 0), ("b", 0), ("a", 1))], "series_id binary, sensor string, vsn string, instrument_id string, measurement string, identity_source string, field string, value_type string, time_ns long")
    assert sorted((r.date, r.fields) for r in kept_series.rows_of(points).collect()) == [("1970-01-01", ["a", "b"]), ("1970-01-02", ["a"])]
    assert kept_series.rows_of(points.filter(F.lit(False))).count() == 0
