"""Commits of several writers: one serial order, whatever is cut short."""

import threading

import pytest
from pyspark.sql import functions as F

from tsforge.operators import commits, store

DAY = 1_735_689_600_000_000_000
SCHEMA = "time_ns long, sensor string, vsn string, instrument_id string, measurement string, field string, value_type string, value_float64 double"


def facts(spark, days, mark, vsns=("W1", "W/2")):
    rows = [(DAY + d * 86_400 * 10**9 + i, "s", v, f"{v}--s", "m", "f", "float64", mark + i) for d in days for v in vsns for i in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def held(data, number=None):
    rows = data.facts(number)
    return {} if rows is None else {(r.vsn, r.date): (r.n, r.low) for r in rows.groupBy("vsn", "date").agg(F.count("*").alias("n"), F.min("value_float64").alias("low")).collect()}


def test_snapshots_policies_and_reruns(spark, tmp_path):
    data = commits.Dataset(spark, str(tmp_path / "d"))
    assert data.latest() == 0 and data.facts() is None and data.partitions() is None
    assert data.publish(facts(spark, [0, 1], 0.0), "a") == 1
    assert data.publish(facts(spark, [0, 1], 5.0), "a") == 1  # a run is committed once
    with pytest.raises(commits.Conflict):
        data.publish(facts(spark, [1, 2], 10.0), "b")
    assert data.abandoned() == ["b"] and data.latest() == 1
    data.vacuum(["b"])
    assert data.abandoned() == []
    assert data.publish(facts(spark, [1, 2], 20.0), "c", policy="skip") == 2
    assert {k: v[1] for k, v in held(data).items()} == {(v, f"2025-01-0{d}"): m for v in ("W1", "W/2") for d, m in ((1, 0.0), (2, 0.0), (3, 20.0))}
    with pytest.raises(commits.Conflict, match="other inputs"):
        data.publish(facts(spark, [1], 30.0), "e", {"rules": "x"}, policy="skip")
    assert data.publish(facts(spark, [1], 40.0, ["W1"]), "f", policy="replace") == 3
    assert held(data)["W1", "2025-01-02"] == (3, 40.0) and held(data)["W/2", "2025-01-02"] == (3, 0.0)
    assert held(data, 2)["W1", "2025-01-02"] == (3, 0.0) and len(held(data, 1)) == 4
    assert {r.run_id for r in data.partitions().collect()} == {"a", "c", "f"}
    with pytest.raises(ValueError):
        data.vacuum(["a"])
    with pytest.raises(ValueError):
        data.publish(facts(spark, [9], 0.0), "g", policy="overwrite")


def test_two_writers_end_as_one_order(spark, tmp_path):
    data = [commits.Dataset(spark, str(tmp_path / "d")) for _ in range(4)]
    numbers, errors, gate = {}, [], threading.Barrier(4)

    def work(i):
        run = f"r{i}"
        gate.wait()
        try:
            numbers[run] = data[i].publish(facts(spark, range(i, i + 3), 100.0 * i), run, policy="skip")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(300)
    assert not errors and sorted(numbers.values()) == [1, 2, 3, 4]
    want = {}
    for run in sorted(numbers, key=numbers.get):  # the serial order that the log says
        i = int(run[1:])
        for d in range(i, i + 3):
            for v in ("W1", "W/2"):
                want.setdefault((v, f"2025-01-0{d + 1}"), (3, 100.0 * i))
    assert held(data[0]) == want


@pytest.mark.parametrize("step", ["data", "manifest", "settle", "before the commit", "after the commit"])
def test_a_writer_that_dies_leaves_nothing_that_is_read(spark, tmp_path, monkeypatch, step):
    data = commits.Dataset(spark, str(tmp_path / "d"))
    data.publish(facts(spark, [0], 0.0), "a")

    class Killed(RuntimeError):
        pass

    def die(*_):
        raise Killed

    real = store.Files.create_new
    with monkeypatch.context() as m:
        if step == "data":
            m.setattr(commits.catalog, "partition_variables", die)
        elif step == "manifest":
            m.setattr(commits.Dataset, "_settled", die)
        elif step == "settle":
            m.setattr(commits.Dataset, "_without", die)
        elif step == "before the commit":
            m.setattr(store.Files, "create_new", die)
        else:
            m.setattr(store.Files, "create_new", lambda self, *a: (real(self, *a), die()))
        with pytest.raises(Killed):
            data.publish(facts(spark, [0, 1], 10.0), "b", policy="skip")
    assert held(data) == held(data, 1) | ({} if step != "after the commit" else {(v, "2025-01-02"): (3, 10.0) for v in ("W1", "W/2")})
    assert data.publish(facts(spark, [0, 1], 10.0), "b", policy="skip") == 2
    assert {k: v[1] for k, v in held(data).items()} == {(v, f"2025-01-0{d}"): x for v in ("W1", "W/2") for d, x in ((1, 0.0), (2, 10.0))}


def test_one_name_is_one_writers(spark, tmp_path):
    files, won, gate = store.Files(spark), [], threading.Barrier(8)

    def work(i):
        gate.wait()
        try:
            files.create_new(f"{tmp_path}/log/1.json", f"writer {i}")
            won.append(i)
        except FileExistsError:
            pass

    threads = [threading.Thread(target=work, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and files.read_text(f"{tmp_path}/log/1.json") == f"writer {won[0]}" and [n for n in files.names(f"{tmp_path}/log") if "crc" not in n] == ["1.json"]
