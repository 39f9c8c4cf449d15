"""Files of the 64-bit classic format: headers by hand, rows that come back, places that tasks wrote."""

import os
from decimal import Decimal

import numpy as np
import pytest

from tsforge.sources import cdf
from tsforge.sources.cdf import Variable

VARIABLES = [
    Variable("time_ns", "i8", {"units": "nanoseconds since 1970-01-01T00:00:00Z"}), Variable("series_id", "u1", width=16), Variable("variable_code", "u2", {"flag_values": np.arange(3, dtype=np.uint16)}),
    Variable("observed_value", "f8", {"_FillValue": np.float64("nan")}), Variable("observed_value_string", "text"), Variable("vsn", "text"), Variable("qc_bits", "u8", {"flag_masks": np.array([1, 1 << 63], np.uint64)}),
]
SCHEMA = "period string, time_ns long, series_id binary, variable_code int, observed_value double, observed_value_string string, vsn string, qc_bits decimal(20,0)"


def rows_of(periods, each):
    out = []
    for p in periods:
        for i in range(each):
            out.append((p, i * 7 - 3, bytes([i % 5] * 16), i % 3, None if i % 11 == 0 else i / 3, [None, "", "é" * (i % 4), "x"][i % 4], f"W{i % 2}", Decimal(2**63 + i if i % 2 else i)))
    return out


def said(rows):
    return sorted(str((r[0], bytes(r[1]), r[2], None if r[3] is None or r[3] != r[3] else r[3], r[4] or "", r[5], int(r[6]))) for r in rows)


def written(spark, rows, folder, keys, **more):
    paths = {k: f"{folder}/{k}.nc" for k in keys}
    got = cdf.write(spark.createDataFrame(rows, SCHEMA).repartition(3), "period", ["variable_code", "time_ns", "series_id"], VARIABLES, paths, {k: {"title": f"é {k}", "n": np.int64(4)} for k in keys}, **more)
    return paths, got


def test_rows_come_back_from_files_of_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cdf, "PIECE", 37)
    monkeypatch.setattr(cdf, "RANGE", 100)
    rows = rows_of(["a", "b"], 500) + rows_of(["c"], 1)
    paths, got = written(spark, rows, tmp_path, ["a", "b", "c", "none"], partitions=7)
    assert got == {"a": 500, "b": 500, "c": 1, "none": 0} and sorted(os.listdir(tmp_path)) == ["a.nc", "b.nc", "c.nc", "none.nc"]
    for key, path in paths.items():
        found = cdf.read(spark, path)
        assert found.columns == [v.name for v in VARIABLES]
        assert said(found.collect()) == said([r[1:] for r in rows if r[0] == key])
    assert cdf.read(spark, paths["a"]).rdd.getNumPartitions() == 5
    both = cdf.read(spark, [paths["a"], paths["c"], paths["none"]])
    assert {r.file: r.n for r in both.groupBy("file").count().withColumnRenamed("count", "n").collect()} == {paths["a"]: 500, paths["c"]: 1}
    header = cdf.read_header(paths["b"])
    assert header["attributes"] == {"title": "é b", "n": 4} and header["variables"]["qc_bits"]["attributes"]["flag_masks"].tolist() == [1, 1 << 63]
    # the order that was asked for, over all tasks' pieces
    codes = np.fromfile(paths["a"], ">u2", 500, offset=header_of(paths["a"], "variable_code")).tolist()
    times = np.fromfile(paths["a"], ">i8", 500, offset=header_of(paths["a"], "time_ns")).tolist()
    assert list(zip(codes, times)) == sorted(zip(codes, times))


def header_of(path, name):
    return cdf.read_header(path)["variables"][name]["begin"]


def test_a_header_by_hand(tmp_path):
    """Two rows of one short variable, each byte from the format's grammar."""
    made = cdf.layout([Variable("v", "u2", {"a": "hi"})], 2, {}, {})
    want = b"CDF\x05" + bytes(8)
    want += b"\0\0\0\x0a" + (1).to_bytes(8, "big") + (11).to_bytes(8, "big") + b"observation\0" + (2).to_bytes(8, "big")
    want += bytes(4) + bytes(8)
    want += b"\0\0\0\x0b" + (1).to_bytes(8, "big") + (1).to_bytes(8, "big") + b"v\0\0\0" + (1).to_bytes(8, "big") + bytes(8)
    want += b"\0\0\0\x0c" + (1).to_bytes(8, "big") + (1).to_bytes(8, "big") + b"a\0\0\0" + b"\0\0\0\x02" + (2).to_bytes(8, "big") + b"hi\0\0"
    want += b"\0\0\0\x08" + (4).to_bytes(8, "big") + (len(want) + 20).to_bytes(8, "big")
    assert made.header == want and made.begins == {"v": len(want)} and made.size == len(want) + 4


def test_what_a_type_cannot_say_is_an_error(spark, tmp_path):
    row = list(rows_of(["a"], 2)[1])
    for at, bad in ((1, None), (2, b"short"), (3, None), (3, 70_000)):
        with pytest.raises(Exception, match="null|bytes each|70000|bounds|range"):
            written(spark, [tuple(bad if i == at else x for i, x in enumerate(row))], tmp_path, ["a"])
    with pytest.raises(cdf.CdfError, match="no path"):
        written(spark, rows_of(["a", "b"], 2), tmp_path, ["a"])
    assert os.listdir(tmp_path) == []


def test_broken_files_are_errors(spark, tmp_path):
    paths, _ = written(spark, rows_of(["a"], 50), tmp_path, ["a"])
    data = open(paths["a"], "rb").read()
    (tmp_path / "cut.nc").write_bytes(data[:-200])
    (tmp_path / "other.nc").write_bytes(b"HDF" + data)
    (tmp_path / "head.nc").write_bytes(data[:90])
    with pytest.raises(Exception, match="cut short"):
        cdf.read(spark, str(tmp_path / "cut.nc")).collect()
    for name in ("other", "head"):
        with pytest.raises(cdf.CdfError):
            cdf.read_header(str(tmp_path / f"{name}.nc"))
