"""Case-sensitive shell patterns (``* ? [seq] [!seq]``) as column predicates."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PART = re.compile(r"\*+|\?|\[(?:(!)|(?!!))(\][^\]]*|[^\]]+)\]|.", re.S)


def is_glob(pattern: str) -> bool:
    return any(c in pattern for c in "*?[")


def _inside(text: str) -> str:
    """The characters and ranges of a set, for an expression; a range that runs backwards holds nothing."""
    out, at = [], 0
    plain = lambda c: re.sub(r"([\\\[\]&^~|-])", r"\\\1", c)
    while at < len(text):
        if text[at + 1 : at + 2] == "-" and at + 2 < len(text):
            out.append(f"{plain(text[at])}-{plain(text[at + 2])}" if text[at] <= text[at + 2] else "")
            at += 3
        else:
            out.append(plain(text[at]))
            at += 1
    return "".join(out)


def to_regex(pattern: str) -> str:
    """An anchored expression that Java and Python read alike."""
    out = []
    for m in _PART.finditer(pattern):
        text = m[0]
        if text[0] == "*":
            out.append(".*")
        elif text == "?":
            out.append(".")
        elif m[2] is not None:
            inside = _inside(m[2])
            out.append(f"[{'^' if m[1] else ''}{inside}]" if inside else "." if m[1] else "(?!)")
        else:
            out.append(re.sub(r"([^A-Za-z0-9_])", r"\\\1", text))
    return rf"(?s)\A(?:{''.join(out)})\z"


def parts(pattern: str) -> list[str]:
    """A pattern's parts: ``*`` (once for each run of them), ``?``, a set with its brackets, or one character."""
    return ["*" if m[0][0] == "*" else m[0] for m in _PART.finditer(pattern)]


@functools.lru_cache(1 << 14)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(to_regex(pattern).replace(r"\z", r"\Z"))


def is_match(value: str, pattern: str) -> bool:
    """As ``matches``, of a text."""
    return bool(_compiled(pattern).match(value)) if is_glob(pattern) else value == pattern


def matches(value: Column, pattern: str) -> Column:
    """Equality for plain texts, so that a scan can use it; a regular expression for globs."""
    return value.rlike(to_regex(pattern)) if is_glob(pattern) else value == F.lit(pattern)


def matches_any(value: Column, patterns: tuple[str, ...]) -> Column:
    plain = [p for p in patterns if not is_glob(p)]
    found = value.isin(plain) if plain else F.lit(False)
    for p in patterns:
        if is_glob(p):
            found = found | matches(value, p)
    return found
