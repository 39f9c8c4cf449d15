"""Quality rules and processing runs, read from YAML and checked before any job."""

from __future__ import annotations

import hashlib
import json
import math
import re
from dataclasses import asdict, dataclass, field
from datetime import datetime
from pathlib import Path

from tsforge.functions import times

METHODS = ("col_vals_not_null", "col_vals_between")
_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class ConfigError(ValueError):
    """Rules or a run that can't be used."""


def _need(ok: object, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def _known(document: object, allowed: set[str], required: set[str], what: str) -> dict:
    _need(isinstance(document, dict), f"{what} must be a mapping")
    _need(not set(document) - allowed, f"{what}: unknown keys {sorted(set(document) - allowed)}")
    _need(required <= set(document), f"{what}: missing keys {sorted(required - set(document))}")
    return document


def _unique(values, what: str) -> None:
    values = list(values)
    _need(len(values) == len(set(values)), f"{what} must be unique")


def _share(value, what: str) -> float | None:
    if value is None:
        return None
    _need(isinstance(value, (int, float)) and not isinstance(value, bool) and 0 <= value <= 1, f"{what} must be from 0 to 1")
    return float(value)


@dataclass(frozen=True)
class Check:
    id: str
    method: str
    flag: str
    left: float | None = None
    right: float | None = None
    inclusive: tuple[bool, bool] = (True, True)
    warning: float | None = None
    error: float | None = None
    critical: float | None = None

    @classmethod
    def parse(cls, item: object) -> Check:
        d = _known(item, {"id", "method", "flag", "args", "na_pass", "thresholds"}, {"id", "method", "flag"}, "a check")
        args = d.get("args") or {}
        _need(d["method"] in METHODS, f"no such method: {d['method']}")
        _need(d.get("na_pass", True) is True and args.get("na_pass", True) is True, "na_pass can't be turned off")
        levels = _known(d.get("thresholds") or {}, {"warning", "error", "critical"}, set(), "thresholds")
        shares = {k: _share(v, k) for k, v in levels.items()}
        if d["method"] == "col_vals_not_null":
            _need(not args, "col_vals_not_null takes no arguments")
            return cls(str(d["id"]), d["method"], str(d["flag"]), **shares)
        a = _known(args, {"left", "right", "inclusive", "na_pass"}, {"left", "right"}, "arguments of col_vals_between")
        left, right = float(a["left"]), float(a["right"])
        _need(math.isfinite(left) and math.isfinite(right) and left <= right, "left and right must be finite and in order")
        both = a.get("inclusive", [True, True])
        _need(isinstance(both, list) and len(both) == 2 and all(isinstance(x, bool) for x in both), "inclusive must be two booleans")
        return cls(str(d["id"]), d["method"], str(d["flag"]), left, right, (both[0], both[1]), **shares)


@dataclass(frozen=True)
class Variable:
    name: str
    column: str
    where: tuple[tuple[str, str], ...]
    checks: tuple[Check, ...]
    units: str = ""
    missing_values: tuple[float, ...] = ()
    missing_strings: tuple[str, ...] = ()

    @property
    def is_string(self) -> bool:
        return dict(self.where).get("value_type") == "string" or self.column == "value_string"

    @classmethod
    def parse(cls, name: str, item: object) -> Variable:
        d = _known(item, {"column", "where", "units", "checks", "missing_values", "missing_strings", "type", "long_name", "standard_name"}, {"column", "where", "checks"}, f"the variable {name}")
        where = _known(d["where"], set(d["where"]), {"measurement", "field"}, f"where of {name}")
        checks = tuple(Check.parse(c) for c in d["checks"])
        values = tuple(float(v) for v in d.get("missing_values") or ())
        strings = tuple(str(v) for v in d.get("missing_strings") or ())
        _need(all(map(math.isfinite, values)), f"missing_values of {name} must be finite")
        _unique(values, f"missing_values of {name}")
        _unique(strings, f"missing_strings of {name}")
        out = cls(name, str(d["column"]), tuple((k, str(v)) for k, v in where.items()), checks, str(d.get("units", "")), values, strings)
        if out.is_string:
            _need(not values and all(c.method == "col_vals_not_null" for c in checks), f"the string variable {name} takes only missing_strings and col_vals_not_null")
        else:
            _need(not strings, f"the numeric variable {name} takes no missing_strings")
        return out


@dataclass(frozen=True)
class Profile:
    name: str
    variables: tuple[Variable, ...]

    def checks(self):
        return [(v, c) for v in self.variables for c in v.checks]


@dataclass(frozen=True)
class Rules:
    flags: dict[str, int]
    profiles: dict[str, Profile]
    descriptions: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_document(cls, document: object) -> Rules:
        d = _known(document, {"schema_version", "flags", "profiles", "pipelines"}, {"schema_version", "flags", "profiles"}, "quality rules")
        _need(d["schema_version"] == 1, "schema_version must be 1")
        flags, said = {}, {}
        for name, item in d["flags"].items():
            f = _known(item, {"bit", "description"}, {"bit"}, f"the flag {name}")
            _need(isinstance(f["bit"], int) and 0 <= f["bit"] <= 63, f"the bit of {name} must be from 0 to 63")
            flags[str(name)], said[str(name)] = f["bit"], str(f.get("description", ""))
        _unique(flags.values(), "bits")
        profiles = {}
        for name, item in d["profiles"].items():
            p = _known(item, {"variables", "sampling"}, {"variables"}, f"the profile {name}")
            profile = Profile(str(name), tuple(Variable.parse(str(k), v) for k, v in p["variables"].items()))
            _unique([c.id for _, c in profile.checks()], f"check ids of {name}")
            _unique([(w["measurement"], w["field"]) for w in (dict(v.where) for v in profile.variables)], f"measurements and fields of {name}")
            for _, c in profile.checks():
                _need(c.flag in flags, f"no such flag: {c.flag}")
            profiles[str(name)] = profile
        for name, item in (d.get("pipelines") or {}).items():
            stages = _known(item, {"stages"}, {"stages"}, f"the pipeline {name}")["stages"]
            _need(len(stages) == 1, f"the pipeline {name} must have one stage")
        return cls(flags, profiles, said)

    @classmethod
    def read(cls, path: str) -> Rules:
        return cls.from_document(_yaml(path))


@dataclass(frozen=True)
class WorkUnit:
    id: str
    profile: str
    filters: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Run:
    source: str
    time_column: str
    keys: tuple[str, ...]
    rules: str
    start: datetime
    end: datetime
    period: str
    work_units: tuple[WorkUnit, ...]
    output: str
    hive: bool = True
    union_by_name: bool = True
    netcdf: tuple[str, str] | None = None

    @classmethod
    def from_document(cls, document: object, base: str = ".") -> Run:
        d = _known(document, {"schema_version", "source", "quality", "selection", "processing", "work_units", "output"}, {"schema_version", "source", "quality", "selection", "processing", "work_units", "output"}, "a run")
        place = lambda p: str(p) if re.match(r"[a-z0-9]+:/", str(p)) else str((Path(base) / p).resolve()) if not Path(str(p)).is_absolute() else str(p)
        s = _known(d["source"], {"type", "path", "options", "time", "observation_keys"}, {"path", "time", "observation_keys"}, "source")
        options = _known(s.get("options") or {}, {"hive_partitioning", "union_by_name"}, set(), "source options")
        time_column, keys = str(s["time"]["column"]), tuple(map(str, s["observation_keys"]))
        _need(time_column in keys, "the time column must be an observation key")
        _unique(keys, "observation keys")
        selection = {k: _moment(d["selection"][k]) for k in ("start", "end")}
        _need(selection["start"] < selection["end"], "the selection ends before it starts")
        period = str(d["processing"]["period"])
        _need(period in times.PERIODS, f"no such period: {period}")
        units = []
        for item in d["work_units"]:
            u = _known(item, {"id", "profile", "filters"}, {"id", "profile"}, "a work unit")
            _need(_SAFE.fullmatch(str(u["id"])), f"not a safe id: {u['id']}")
            units.append(WorkUnit(str(u["id"]), str(u["profile"]), tuple((str(k), str(v)) for k, v in (u.get("filters") or {}).items())))
        _unique([u.id for u in units], "work unit ids")
        out = _known(d["output"], {"root", "netcdf"}, {"root"}, "output")
        source, root = place(s["path"]), place(out["root"])
        fixed = re.split(r"/[^/]*[*?\[]", source)[0]
        _need(not (f"{root}/".startswith(f"{fixed}/") or f"{fixed}/".startswith(f"{root}/")), "the output must not overlap the source")
        netcdf = None
        if out.get("netcdf"):
            n = _known(out["netcdf"], {"site", "instrument"}, {"site", "instrument"}, "netcdf")
            _need(period == "1d" and all(x.timetz().replace(tzinfo=None) == datetime.min.time() for x in selection.values()), "netcdf needs whole UTC days")
            _need(all({"sensor", "vsn", "instrument_id"} <= {k for k, _ in u.filters} for u in units), "netcdf needs filters on sensor, vsn and instrument_id")
            netcdf = (str(n["site"]), str(n["instrument"]))
        return cls(source, time_column, keys, place(d["quality"]["rules"]), selection["start"], selection["end"], period, tuple(units), root, options.get("hive_partitioning", True), options.get("union_by_name", True), netcdf)

    @classmethod
    def read(cls, path: str) -> Run:
        return cls.from_document(_yaml(path), str(Path(path).parent))


def config_hash(rules: Rules, run: Run, unit: WorkUnit) -> str:
    """Changes with anything that changes results, and with nothing else."""
    profile = rules.profiles[unit.profile]
    said = {"flags": rules.flags, "profile": asdict(profile), "source": [run.source, run.time_column, run.keys, run.hive, run.union_by_name], "selection": [x.isoformat() for x in (run.start, run.end)], "period": run.period, "unit": asdict(unit), "netcdf": run.netcdf}
    return hashlib.sha256(json.dumps(said, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _moment(value: object) -> datetime:
    found = value if isinstance(value, datetime) else datetime.fromisoformat(str(value).replace("Z", "+00:00"))
    _need(found.tzinfo is not None, f"a time without a time zone: {value}")
    return times.as_utc(found)


def _yaml(path: str) -> dict:
    import yaml

    try:
        document = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, yaml.YAMLError) as e:
        raise ConfigError(f"can't read {path}: {e}") from e
    _need(isinstance(document, dict), f"{path} must hold a mapping")
    return document
