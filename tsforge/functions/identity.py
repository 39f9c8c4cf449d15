"""Identities of series and instruments.

A series' id is the first half of the SHA-256 of compact JSON of its measurement
and retained tags. An instrument's id is made of readable parts and a digest of
JSON with spaced separators. Both must stay as they are to the bit.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The tag that moves between hosts and is no part of an identity.
DROPPED_TAG = "node"
#: Tags that name an instrument's kind, in order.
KIND_TAGS = ("sensor", "task", "deviceName", "device")


def retained(tags: Column) -> Column:
    return F.map_filter(tags, lambda k, _: k != DROPPED_TAG)


def _sorted(tags: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(tags)))


def series_json(measurement: Column, tags: Column) -> Column:
    kept = _sorted(retained(tags))
    return F.concat(F.lit('{"measurement":'), quoted(measurement), F.lit(',"tags":'), F.to_json(kept), F.lit("}"))


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def series_id(measurement: Column, tags: Column) -> Column:
    """32 hexadecimal digits; exact for printable ASCII. ``with_series_id`` takes any text."""
    return F.substring(F.sha2(series_json(measurement, tags), 256), 1, 32)


def python_series_id(measurement: str, tags: dict[str, str]) -> str:
    kept = {k: v for k, v in tags.items() if k != DROPPED_TAG}
    text = json.dumps({"measurement": measurement, "tags": kept}, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def with_series_id(df: DataFrame, name: str = "series_id") -> DataFrame:
    """Adds the id as binary: in the JVM for printable ASCII, in Python for the distinct rest."""
    plain = ~series_json(F.col("measurement"), F.col("tags")).rlike(r"[^\x20-\x7e]")
    done = df.filter(plain).withColumn(name, F.unhex(series_id(F.col("measurement"), F.col("tags"))))
    fields = df.schema.names

    def run(batches):
        for batch in batches:
            ids = [bytes.fromhex(python_series_id(m, dict(t))) for m, t in zip(batch.column("measurement").to_pylist(), batch.column("tags").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*fields, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{name}` binary"
    return done.unionByName(df.filter(~plain).mapInArrow(run, schema))


def slug(text: Column, lower: bool = True, default: str = "unknown") -> Column:
    found = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "-"), F.lit("-."))
    found = F.lower(found) if lower else found
    return F.when(found == "", F.lit(default)).otherwise(found)


def _tag(tags: Column, key: str) -> Column:
    """A tag's value; empty ones count as missing."""
    found = F.try_element_at(tags, F.lit(key))
    return F.when(found != "", found)


@dataclass(frozen=True)
class Rule:
    instrument_id: str
    match: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Registry:
    """Rules that name instruments; the first whose tags all agree wins."""

    rules: tuple[Rule, ...] = ()
    required: bool = False

    @classmethod
    def from_document(cls, document: dict, required: bool = False) -> Registry:
        if set(document) - {"rules"} or not isinstance(document.get("rules"), list):
            raise ValueError("a registry holds a list of rules")
        rules, ids = [], set()
        for item in document["rules"]:
            if isinstance(item, dict) and set(item) - {"instrument_id", "match"}:
                raise ValueError(f"a rule with unknown keys: {sorted(set(item) - {'instrument_id', 'match'})}")
            match = item.get("match") if isinstance(item, dict) else None
            if not isinstance(match, dict) or not match or not item.get("instrument_id"):
                raise ValueError("a rule needs instrument_id and match")
            if item["instrument_id"] in ids:
                raise ValueError("two rules give one instrument_id")
            if DROPPED_TAG in match:
                raise ValueError(f"the tag {DROPPED_TAG!r} is no part of an identity")
            ids.add(item["instrument_id"])
            rules.append(Rule(str(item["instrument_id"]), tuple(sorted((str(k), str(v)) for k, v in match.items()))))
        return cls(tuple(rules), required)

    @property
    def fingerprint(self) -> str:
        """The digest of the rules, in their order, as compact JSON with sorted keys."""
        said = [{"instrument_id": r.instrument_id, "match": dict(r.match)} for r in self.rules]
        return hashlib.sha256(json.dumps(said, separators=(",", ":"), sort_keys=True).encode()).hexdigest()

    @functools.cached_property
    def _by_shape(self) -> dict[tuple[str, ...], dict[tuple[str, ...], int]]:
        """For each set of tag names, the first rule of each of their values."""
        shapes: dict[tuple[str, ...], dict[tuple[str, ...], int]] = {}
        for number, rule in enumerate(self.rules):
            shapes.setdefault(tuple(k for k, _ in rule.match), {}).setdefault(tuple(v for _, v in rule.match), number)
        return shapes

    def find(self, tags: dict[str, str]) -> str | None:
        """As ``lookup``, of one series; its work grows with the sets of tag names, not with the rules."""
        found = [n for shape, rules in self._by_shape.items() if (n := rules.get(tuple(tags.get(k) for k in shape))) is not None]
        return self.rules[min(found)].instrument_id if found else None

    def lookup(self, tags: Column) -> Column:
        """The id that the rules give, or null."""
        found = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            agrees = F.lit(True)
            for k, v in rule.match:
                agrees = agrees & F.coalesce(F.try_element_at(tags, F.lit(k)) == F.lit(v), F.lit(False))
            found = F.when(agrees, F.lit(rule.instrument_id)).otherwise(found)
        return found


def instrument(measurement: Column, tags: Column, registry: Registry | None = None, listed: Column | None = None) -> Column:
    """A struct: instrument_id, source, confidence, review_required, vsn, kind, zone, device.

    ``listed`` is what the registry gives, where that was looked up already (``operators.registry``).
    """
    registry = registry or Registry()
    vsn = _tag(tags, "vsn")
    named = F.coalesce(*(_tag(tags, k) for k in KIND_TAGS))
    system = measurement.startswith("sys.")
    kind = F.coalesce(named, F.when(system, F.lit("system")).otherwise(F.substring_index(measurement, ".", 1)))
    by_sensor, by_tag = _tag(tags, "sensor").isNotNull(), named.isNotNull()
    kind_source = F.coalesce(*(F.when(_tag(tags, k).isNotNull(), F.lit(k)) for k in KIND_TAGS), F.when(system, F.lit("system")).otherwise(F.lit("measurement")))
    device = F.coalesce(_tag(tags, "deviceName"), _tag(tags, "device"))
    zone = F.coalesce(_tag(tags, "zone"), F.lit("unknown-zone"))
    known_vsn = F.coalesce(vsn, F.lit("unknown-vsn"))
    known_device = F.coalesce(device, F.lit("unknown-device"))
    pair = lambda k, v: F.concat(F.lit(f'"{k}": '), quoted(v))
    text = F.concat(F.lit("{"), F.concat_ws(", ", pair("device", known_device), pair("kind", kind), pair("vsn", known_vsn), pair("zone", zone)), F.lit("}"))
    parts = F.concat_ws("--", slug(known_vsn, lower=False, default="unknown-vsn"), slug(kind), slug(zone), F.when(device.isNotNull(), slug(device)))
    fallback = F.concat(F.substring(parts, 1, 120), F.lit("--"), F.substring(F.sha2(text, 256), 1, 12))
    listed = registry.lookup(tags) if listed is None else listed
    if registry.required:
        listed = F.coalesce(listed, F.raise_error(F.lit("an instrument is not in the registry")).cast("string"))
    confidence = (
        F.when(listed.isNotNull() | (by_sensor & vsn.isNotNull()), "high")
        .when(~by_tag | vsn.isNull(), "low").otherwise("medium")
    )
    return F.struct(
        F.coalesce(listed, fallback).alias("instrument_id"), F.when(listed.isNotNull(), F.lit("registry")).otherwise(F.concat(F.lit("vsn+"), kind_source)).alias("source"),
        confidence.alias("confidence"), (confidence != "high").alias("review_required"), known_vsn.alias("vsn"), kind.alias("kind"), zone.alias("zone"), known_device.alias("device"),
    )


def _python_slug(text: str, lower: bool = True, default: str = "unknown") -> str:
    found = re.sub(r"[^A-Za-z0-9._-]+", "-", text).strip("-.")
    return (found.lower() if lower else found) or default


def python_identity(measurement: str, tags: dict[str, str], registry: Registry | None = None) -> tuple[bytes, str | None, str | None, str, str]:
    """series_id, vsn, sensor, instrument_id and source of one series, as the columns say; for any text."""
    registry = registry or Registry()
    vsn, sensor, device = (tags.get(k) or None for k in ("vsn", "sensor", "deviceName"))
    device = device or tags.get("device") or None
    by_tag = next((k for k in KIND_TAGS if tags.get(k)), None)
    system = measurement.startswith("sys.")
    kind = tags[by_tag] if by_tag else "system" if system else measurement.split(".", 1)[0]
    zone = tags.get("zone") or "unknown-zone"
    listed = registry.find({k: v for k, v in tags.items() if k != DROPPED_TAG})
    if listed is None and registry.required:
        raise ValueError("an instrument is not in the registry")
    said = {"device": device or "unknown-device", "kind": kind, "vsn": vsn or "unknown-vsn", "zone": zone}
    parts = [_python_slug(said["vsn"], False, "unknown-vsn"), _python_slug(kind), _python_slug(zone), *([_python_slug(device)] if device else [])]
    own = f"{'--'.join(parts)[:120]}--{hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()[:12]}"
    source = "registry" if listed else f"vsn+{by_tag or ('system' if system else 'measurement')}"
    return bytes.fromhex(python_series_id(measurement, tags)), vsn, sensor, listed or own, source
