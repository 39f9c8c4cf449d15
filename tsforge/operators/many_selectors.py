"""Selections of many selectors, answered for distinct series.

An expression with a predicate for each selector grows with the selection, and so
does the work of each row. Here all patterns of a column are one automaton: a trie
of their parts, walked through as sets of states that are worked out once for each
set and character (and forgotten when there are very many). Exact texts are looked
up. Each value gives the patterns that it agrees with, these give selectors, and
selectors that all their keys agree with take the series. The answer joins the
points as two booleans, so the plan does not depend on the selection.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions import globs
from tsforge.functions.globs import is_glob
from tsforge.operators.selection import Selection
from tsforge.operators.store import kept, sent_if_small

#: Selectors up to which they are one expression.
INLINE = 64
#: Sets of states and characters that an automaton remembers, and series whose answers are.
KEPT = 200_000


class Automaton:
    """All globs of a column: which of them a text agrees with as a whole."""

    def __init__(self, patterns: Iterable[str]):
        # states: literal successors, tests of one character with theirs, whether a star stays here, patterns that end here
        self.exact: list[dict[str, int]] = [{}]
        self.tests: list[list[tuple[re.Pattern | None, int]]] = [[]]
        self.stays: list[bool] = [False]
        self.star: list[int] = [-1]
        self.ends: list[list[str]] = [[]]
        seen: dict[tuple[int, str], int] = {}
        for pattern in patterns:
            at = 0
            for part in globs.parts(pattern):
                nxt = seen.get((at, part))
                if nxt is None:
                    nxt = seen[at, part] = self._state()
                    if part == "*":
                        self.stays[nxt] = True
                        self.star[at] = nxt
                    elif len(part) == 1 and part != "?":
                        self.exact[at][part] = nxt
                    else:
                        self.tests[at].append((None if part == "?" else re.compile(globs.to_regex(part).replace(r"\z", r"\Z")), nxt))
                at = nxt
            self.ends[at].append(pattern)
        self._steps: dict[tuple[tuple[int, ...], str], tuple[int, ...]] = {}
        self._first = self._closed({0})

    def _state(self) -> int:
        for table, empty in ((self.exact, {}), (self.tests, []), (self.stays, False), (self.star, -1), (self.ends, [])):
            table.append(empty)
        return len(self.exact) - 1

    def _closed(self, states: set[int]) -> tuple[int, ...]:
        """With what stars reach without a character."""
        todo = list(states)
        while todo:
            nxt = self.star[todo.pop()]
            if nxt >= 0 and nxt not in states:
                states.add(nxt)
                todo.append(nxt)
        return tuple(sorted(states))

    def _step(self, states: tuple[int, ...], character: str) -> tuple[int, ...]:
        found = self._steps.get((states, character))
        if found is None:
            reached = set()
            for s in states:
                if self.stays[s]:
                    reached.add(s)
                nxt = self.exact[s].get(character)
                if nxt is not None:
                    reached.add(nxt)
                reached.update(nxt for test, nxt in self.tests[s] if test is None or test.match(character))
            if len(self._steps) >= KEPT:
                self._steps.clear()
            found = self._steps[states, character] = self._closed(reached)
        return found

    def matches(self, text: str) -> list[str]:
        states = self._first
        for character in text:
            states = self._step(states, character)
            if not states:
                return []
        return [p for s in states for p in self.ends[s]]


class _Column:
    """The selectors that a value of one column speaks for."""

    def __init__(self):
        self.of: dict[str, list[int]] = {}

    def add(self, pattern: str, selector: int):
        own = self.of.setdefault(pattern, [])
        if not own or own[-1] != selector:
            own.append(selector)

    def finish(self):
        self.automaton = Automaton(p for p in self.of if is_glob(p))
        self.known: dict[str, frozenset[int]] = {}

    def selectors(self, value: str | None) -> frozenset[int]:
        if value is None:
            return frozenset()
        found = self.known.get(value)
        if found is None:
            if len(self.known) >= KEPT:
                self.known.clear()
            exact = self.of.get(value, []) if not is_glob(value) else []
            found = self.known[value] = frozenset(exact).union(*(self.of[p] for p in self.automaton.matches(value)))
        return found


class Index:
    """All selectors of a selection by the columns that they ask for."""

    def __init__(self, selection: Selection):
        self.columns: dict[tuple[str, ...], _Column] = {}
        self.asked: list[int] = []  # columns that a selector asks for, and those but for tags
        self.plain: list[int] = []
        for number, selector in enumerate(selection.selectors):
            said = [(("measurement",), [selector.get("measurement", selector.get("measurement_glob"))])]
            said += [(("field",), selector["fields"])] if "fields" in selector else []
            self.plain.append(len(said))
            said += [(("tag", k), v) for k, v in selector.get("tags", {}).items()]
            self.asked.append(len(said))
            for column, patterns in said:
                for p in patterns:
                    self.columns.setdefault(column, _Column()).add(p, number)
        for column in self.columns.values():
            column.finish()

    def _agreeing(self, measurement: str, field: str) -> Counter:
        found = Counter(self.columns[("measurement",)].selectors(measurement))
        if ("field",) in self.columns:
            found.update(n for n in self.columns[("field",)].selectors(field) if n in found)
        return found

    def takes(self, measurement: str, field: str, tags: dict[str, str]) -> bool:
        return self.answer(measurement, field, tags)[0]

    def answer(self, measurement: str, field: str, tags: dict[str, str]) -> tuple[bool, bool]:
        """Whether any selector takes a point, and whether any would whatever its tags."""
        found = self._agreeing(measurement, field)
        found = Counter({n: c for n, c in found.items() if c == self.plain[n]})
        candidate = bool(found)
        for key, value in tags.items():
            if ("tag", key) in self.columns and found:
                found.update(n for n in self.columns["tag", key].selectors(value) if n in found)
        return any(c == self.asked[n] for n, c in found.items()), candidate


def answered(points: DataFrame, selection: Selection) -> DataFrame:
    """Points with ``_takes`` and ``_candidate``; each distinct series and field is asked once.

    Points without series_id (and their measurement, field, tags) are asked by those.
    """
    by_id = "series_id" in points.columns
    keyed = points if by_id else points.withColumn("_key", F.to_json(F.array_sort(F.map_entries("tags"))))
    keys = ["series_id" if by_id else "_key", "measurement", "field"]
    series = keyed.groupBy(*keys).agg(F.first("tags").alias("tags"))
    schema = f"_0 {'binary' if by_id else 'string'}, _1 string, _2 string, _takes boolean, _candidate boolean"

    def run(batches):
        index = Index(selection)
        for batch in batches:
            rows = [index.answer(m or "", f or "", dict(t or ())) for m, f, t in zip(*(batch.column(c).to_pylist() for c in ("measurement", "field", "tags")))]
            answers = [pa.array([r[i] for r in rows], pa.bool_()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *answers], names=["_0", "_1", "_2", "_takes", "_candidate"])

    answers = sent_if_small(kept(series.mapInArrow(run, schema), "answers"))
    joined = keyed.join(answers, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)], "left")
    return joined.drop("_0", "_1", "_2", *([] if by_id else ["_key"]))
