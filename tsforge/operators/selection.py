"""Selections: which points are wanted, as predicates that scans can use.

``KEYS`` says what a selector may hold: the first version that knows a key,
what its value must be, its canonical form, and the predicate that it means. A
document is checked against this table, brought to its canonical form, and
nothing but that form is kept: predicates and the fingerprint are made from it.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.functions.globs import is_glob, is_match, matches, matches_any
from tsforge.functions.identity import DROPPED_TAG

# The versions of the format, and the two keys of which a selector has one.
VERSIONS = (1, 2)
NAMES = ("measurement", "measurement_glob")


@dataclass(frozen=True)
class Key:
    since: int
    holds: str
    valid: Callable[[Any], bool]
    canonical: Callable[[Any], Any]
    #: From measurement, field, a function that gives a tag's column, and the canonical value.
    means: Callable[[Column, Column, Callable[[str], Column], Any], Column]


def _text(value: object) -> bool:
    return isinstance(value, str) and value != ""


def _texts(value: object) -> bool:
    return isinstance(value, list) and bool(value) and all(map(_text, value))


def _set(values: list[str]) -> list[str]:
    return sorted(set(values))


def _tags_agree(measurement, field, tag, wanted: dict[str, list[str]]) -> Column:
    return reduce(and_, [F.coalesce(matches_any(tag(k), tuple(v)), F.lit(False)) for k, v in wanted.items()])


KEYS = {
    "measurement": Key(1, "an exact name", lambda v: _text(v) and not is_glob(v), str, lambda m, f, tag, v: m == F.lit(v)),
    "measurement_glob": Key(2, "a pattern", _text, str, lambda m, f, tag, v: matches(m, v)),
    "fields": Key(1, "a list of texts that is not empty", _texts, _set, lambda m, f, tag, v: matches_any(f, tuple(v))),
    "tags": Key(
        1, f"lists of texts by tag, without {DROPPED_TAG!r}", lambda v: isinstance(v, dict) and DROPPED_TAG not in v and all(map(_texts, v.values())),
        lambda v: {k: _set(x) for k, x in v.items()}, _tags_agree,
    ),
}


def _wrong(document: object) -> Iterator[str]:
    """All that keeps a document from being a selection."""
    if not isinstance(document, dict) or set(document) != {"selection_version", "selectors"}:
        yield "a selection holds selection_version and selectors"
        return
    version, selectors = document["selection_version"], document["selectors"]
    if version not in VERSIONS:
        yield f"selection_version must be one of {VERSIONS}"
    if not isinstance(selectors, list) or not selectors:
        yield "selectors must be a list that is not empty"
        return
    for number, selector in enumerate(selectors):
        if not isinstance(selector, dict):
            yield f"selector {number} is no mapping"
            continue
        known = {k: key for k, key in KEYS.items() if key.since in VERSIONS[: VERSIONS.index(version) + 1]} if version in VERSIONS else KEYS
        yield from (f"selector {number}: version {version} has no key {k!r}" for k in selector if k not in known)
        yield from (f"selector {number}: {k} must be {known[k].holds}" for k, v in selector.items() if k in known and not known[k].valid(v))
        if sum(k in selector for k in NAMES) != 1:
            yield f"selector {number} needs one of {' and '.join(NAMES)}"


def _dumped(document: object) -> str:
    return json.dumps(document, separators=(",", ":"), sort_keys=True)


def canonical(document: dict) -> str:
    """The one text of all documents that mean the same; empty tags say nothing, as none at all."""
    forms = {_dumped({k: KEYS[k].canonical(v) for k, v in selector.items() if v != {}}) for selector in document["selectors"]}
    return _dumped({"selection_version": document["selection_version"], "selectors": [json.loads(s) for s in sorted(forms)]})


@dataclass(frozen=True)
class Selection:
    """Selectors, any of which may take a point; all keys of a selector must agree, and of a key's values one."""

    canonical: str

    @classmethod
    def from_document(cls, document: object) -> Selection:
        if wrong := list(_wrong(document)):
            raise ValueError("; ".join(wrong))
        return cls(canonical(document))

    @classmethod
    def of_measurements(cls, names) -> Selection:
        return cls.from_document({"selection_version": 1, "selectors": [{"measurement": n} for n in names]})

    @functools.cached_property
    def selectors(self) -> list[dict]:
        return json.loads(self.canonical)["selectors"]

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.canonical.encode()).hexdigest()

    def _any(self, keys, measurement: Column, field: Column, tag=None) -> Column:
        said = [[KEYS[k].means(measurement, field, tag, v) for k, v in s.items() if k in keys] for s in self.selectors]
        return reduce(or_, [reduce(and_, conditions) for conditions in said])

    def matches(self, measurement: Column, field: Column, tags: Column | dict[str, Column]) -> Column:
        """Whether any selector takes a point; ``tags`` is a map column or a column for each tag."""
        of_columns = lambda k: tags.get(k, F.lit(None).cast("string"))
        of_map = lambda k: F.try_element_at(tags, F.lit(k))
        return self._any(KEYS, measurement, field, of_columns if isinstance(tags, dict) else of_map)

    def candidates(self, measurement: Column, field: Column) -> Column:
        """As ``matches`` without the tags: rows that lack an identity may still be meant."""
        return self._any(KEYS.keys() - {"tags"}, measurement, field)

    def takes(self, measurement: str, field: str, tags: dict[str, str]) -> bool:
        """As ``matches``, of one point's texts."""
        if self._index is not None:
            return self._index.takes(measurement, field, tags)
        agree = {
            "measurement": lambda v: measurement == v, "measurement_glob": lambda v: is_match(measurement, v),
            "fields": lambda v: any(is_match(field, x) for x in v), "tags": lambda v: all(k in tags and any(is_match(tags[k], x) for x in wanted) for k, wanted in v.items()),
        }
        return any(all(agree[k](v) for k, v in s.items()) for s in self.selectors)

    @functools.cached_property
    def _index(self):
        """For many selectors, what answers without asking each."""
        from tsforge.operators import many_selectors

        return many_selectors.Index(self) if len(self.selectors) > many_selectors.INLINE else None

    def __getstate__(self):
        return {"canonical": self.canonical}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def measurements(self, index: DataFrame) -> DataFrame:
        """Measurements to export: those of an index (measurement, field, tags) that match, and all exact ones."""
        exact = [(s["measurement"],) for s in self.selectors if "measurement" in s]
        if self._index is not None:
            from tsforge.operators import many_selectors

            found = many_selectors.answered(index.select("measurement", "field", "tags"), self).filter("_takes").select("measurement")
        else:
            found = index.filter(self.matches(F.col("measurement"), F.col("field"), F.col("tags"))).select("measurement")
        return found.unionByName(index.sparkSession.createDataFrame(exact, "measurement string")).distinct()
