"""How filters interact: what each of 120 orders of five filters keeps and removes.

1. Each document gets four flags from its own text, in the JVM, and the digest
   of the text; this narrow table is written once.
2. The fifth flag, a copy of an earlier text, needs other rows. Equal texts
   share the other four flags, so rows are combined to cells (digest, part,
   labels) before anything is compared: a group of copies that holds a third of
   all rows is one row of each task. Of a group, the least doc_id is no copy.
3. ``CUBE`` over the five flags and the part runs over the cells of all digests
   together, at most 128 for each part. A grouping set that selects some flags
   has one row where all of these are false: the survivors of that subset of
   filters, in whatever order they are applied.
4. A step of an order takes one subset of filters to a larger one, so its row
   is a join of two subsets of its part.

Failure conditions: A under 50 words; B fewer than 65 distinct words in 100;
C more than 5 characters A-Z in 100; D any of ``#$%&*|``; E identical to the
text of a smaller doc_id, wherever it is and whether or not it was removed.

Defined results: a null text counts as empty (it fails A, and E after the first
empty one); a null source is the part '', with rows whose source is empty. A
null doc_id is not smaller than any and has none smaller, so such rows never
fail E and have no labels. Repeated rows of one doc_id and text don't make each
other copies. A document is good or toxic if any row of the labels says so.
Texts are the same if their SHA-256 digests are. An empty table has no parts,
so no rows. Other columns of either table are not looked at.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import text_of, written

FILTERS = "ABCDE"
_MEASURES = ("n", "good", "toxic")


def text_flags(text: Column) -> dict[str, Column]:
    """The conditions that a text alone decides, without nulls."""
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), lambda w: w != "")
    n = F.size(words).cast("long")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < n * 65,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 5,
        "D": F.translate(text, "#$%&*|", "") != text,
    }


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents counted by part and flags: part, A to E, n, good, toxic."""
    text = F.col("text")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"), text_of().alias("text"))
    flags = known.select("doc_id", "part", F.unhex(F.sha2(text, 256)).alias("digest"), *[flag.alias(name) for name, flag in text_flags(text).items()])
    flags = written(flags, "flags")
    own = [*FILTERS[:4]]

    marks = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # rows repeated under one id are one row here, so no id brings many rows to the join
    rows = flags.filter("doc_id is not null").groupBy("doc_id", "digest", "part", *own).agg(F.count("*").alias("n"))
    rows = rows.join(marks, "doc_id", "left").withColumns({m: F.coalesce(F.col(m), F.lit(False)) for m in ("good", "toxic")})

    groups = rows.groupBy("digest", "part", *own, "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least"))
    least = groups.groupBy("digest").agg(F.min("least.doc_id").alias("first_id"))
    groups = groups.join(least, "digest")
    firsts = F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0).cast("long")
    split = F.array(F.struct(F.lit(False).alias("E"), firsts.alias("n")), F.struct(F.lit(True).alias("E"), (F.col("n") - firsts).alias("n")))
    dated = groups.select("part", *own, "good", "toxic", F.explode(split).alias("x")).select("part", *own, "x.E", "x.n", "good", "toxic").filter("n > 0")
    undated = flags.filter("doc_id is null").groupBy("part", *own).agg(F.count("*").alias("n"))
    undated = undated.select("part", *own, F.lit(False).alias("E"), "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))

    every = dated.unionByName(undated)
    sums = [F.sum("n").alias("n"), *[F.sum(F.when(F.col(m), F.col("n")).otherwise(0)).alias(m) for m in ("good", "toxic")]]
    return every.groupBy("part", *FILTERS).agg(*sums)


def survivors(found: DataFrame) -> DataFrame:
    """Documents that no filter of a subset removes: part, subset (bits, A is 1), n, good, toxic; none where there are none."""
    cube = found.cube(*FILTERS, "part").agg(*[F.sum(m).alias(m) for m in _MEASURES], *[F.grouping(c).alias(f"_{c}") for c in (*FILTERS, "part")])
    passed = F.lit(True)
    for name in FILTERS:  # a flag is selected and false, or not selected
        passed = passed & ((F.col(f"_{name}") == 1) | ~F.col(name))
    subset = sum(F.when(F.col(f"_{name}") == 0, 1 << i).otherwise(0) for i, name in enumerate(FILTERS))
    return cube.filter("_part = 0").filter(passed).select("part", subset.alias("subset"), *_MEASURES)


def _steps() -> list[dict]:
    """The 600 steps: order, number, filter, and the subsets before it, after it, of it alone, and of the others."""
    everything = (1 << len(FILTERS)) - 1
    out = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(name) for name in order]
        for i, bit in enumerate(bits):
            step = {"filter_order": "".join(order), "step": i + 1, "letter": order[i]}
            out.append(step | {"before": sum(bits[:i]), "after": sum(bits[: i + 1]), "alone": bit, "others": everything - bit})
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step."""
    found = written(survivors(cells(docs, labels)), "survivors")
    parts = found.filter("subset = 0").select("part", F.col("n").alias("all_n"))
    names = ["before", "after", "alone", "others"]
    steps = F.from_json(F.lit(json.dumps(_steps())), f"array<struct<filter_order string, step int, letter string, {', '.join(f'{n} int' for n in names)}>>")
    rows = parts.select("part", "all_n", F.explode(steps).alias("s")).select("part", "all_n", "s.*", F.lit((1 << len(FILTERS)) - 1).alias("everything"))
    for name in (*names, "everything"):
        side = found.select("part", F.col("subset").alias(name), *[F.col(m).alias(f"{name}_{m}") for m in _MEASURES])
        rows = rows.join(side, ["part", name], "left").fillna(0, [f"{name}_{m}" for m in _MEASURES])
    at = F.col
    removed = at("before_n") - at("after_n")
    steps_of = rows.select(
        "part", "filter_order", "step", "letter", at("after_n").alias("kept"), removed.alias("removed"),
        (at("all_n") - at("alone_n") - removed).alias("redundant"), (at("others_n") - at("everything_n")).alias("unique_fails"),
        (at("before_good") - at("after_good")).alias("good_lost"), (at("before_toxic") - at("after_toxic")).alias("toxic_lost"),
    )
    total = steps_of.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return steps_of.join(total, ["part", "letter"]).drop("letter")
