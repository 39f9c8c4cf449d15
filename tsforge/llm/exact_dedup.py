"""Exact dedup by a Golomb-coded exchange of fingerprints.

1. Each input partition hashes its texts in the JVM, cuts its rows in runs,
   sorts a run by hash and cuts it by the owner of each hash (its top bits).
   What an owner gets is the run's sorted hashes as Golomb-Rice codes: about
   as many bits for each document as its hash has beyond log2 of the run.
2. An owner merges the lists that it gets and answers each with a bitmap: the
   hashes that occur more than once, in whatever run.
3. The bitmaps meet the runs again; documents whose bit is unset are unique and
   their texts never move.
   An owner also says which hashes occur in ``HOT`` rows or more; their rows are
   salted where they meet their group's verdict.
4. The texts of the suspects alone are shuffled, grouped by their very bytes.
   That group-by combines before it shuffles, so a group of copies sends one
   row from each task at most, however many rows it has.

Defined results: a null text counts as empty; empty texts are copies of each
other; a null doc_id is smaller than any other; repeated rows (same doc_id and
text) are copies, of which one stays. An empty table gives an empty result.
Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm import golomb
from tsforge.llm.common import partitions, sent_if_small, text_of, written

#: Hashes in a run, and a batch more at most: what a task holds at a time. Rows are numbered by 21 bits in a run.
RUN_ROWS = 1 << 20
#: Owners to a partition: what one of them merges is held in memory.
OWNERS = 8
#: Rows of one hash from which they are salted, and the salts.
HOT, SALTS = 256, 64

#: Names that no column of the input has.
_KEY = ("__tsforge_id", "__tsforge_digest")

_RUNS = "run long, first int, owner int, n int, rice int, codes binary, doc_ids array<long>, digests array<binary>"
_ANSWERS = "run long, owner int, bitmap binary, hot binary"
_MARKED = "row long, doc_id long, digest binary, suspect boolean, hot boolean"


def _pack(batches, owner_bits: int, run_rows: int):
    """Rows of (doc_id, hash, digest) to one row for each run and owner."""
    base, number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 16, 0
    held: list[pa.RecordBatch] = []

    def flush():
        nonlocal number
        rows = pa.Table.from_batches(held)
        hashes = rows.column("hash").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(hashes, kind="stable")
        hashes, rows = hashes[order], rows.take(pa.array(order)).combine_chunks()
        width = 64 - owner_bits
        owner = (hashes >> np.uint64(width)).astype(np.int64) if owner_bits else np.zeros(len(hashes), np.int64)
        cuts = np.flatnonzero(np.diff(owner)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(owner)]
        codes, rices = [], []
        for a, b in zip(starts, ends):
            inside = hashes[a:b] & np.uint64((1 << width) - 1)
            rices.append(golomb.rice_parameter(b - a, width))
            codes.append(golomb.encode(inside, rices[-1]))
        offsets = pa.array(np.r_[starts, len(owner)], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, rows.column(name).chunk(0)) for name in ("doc_id", "digest")]
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(starts), base + number)), pa.array(starts, pa.int32()), pa.array(owner[starts], pa.int32()), pa.array(ends - starts, pa.int32()), pa.array(rices, pa.int32()), pa.array(codes, pa.binary()), *lists],
            names=["run", "first", "owner", "n", "rice", "codes", "doc_ids", "digests"],
        )
        number += 1
        held.clear()
        return out

    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= run_rows:
            yield flush()
            size = 0
    if held:
        yield flush()


def _answer(lists: pa.Table) -> pa.Table:
    """An owner's work: which hashes of each list occur more than once in all lists."""
    counts = lists.column("n").to_numpy()
    parts = [golomb.decode(c, int(n), int(r)) for c, n, r in zip(lists.column("codes").to_pylist(), counts, lists.column("rice").to_pylist())]
    hashes = np.concatenate(parts)
    order = np.argsort(hashes, kind="stable")
    _, copies = np.unique(hashes[order], return_counts=True)
    rows = np.zeros(len(hashes), np.int64)
    rows[order] = np.repeat(copies, copies)
    ends = np.cumsum(counts)
    bitmaps = [[np.packbits(rows[e - n : e] >= least).tobytes() for e, n in zip(ends, counts)] for least in (2, HOT)]
    return pa.table({"run": lists.column("run"), "owner": lists.column("owner"), "bitmap": pa.array(bitmaps[0], pa.binary()), "hot": pa.array(bitmaps[1], pa.binary())})


def _mark(batches):
    """Lists with their bitmaps to one row for each document; ``row`` is unique."""
    for batch in batches:
        ids, digests = batch.column("doc_ids"), batch.column("digests")
        for i, x in enumerate(batch.select(["run", "first", "n", "bitmap", "hot"]).to_pylist()):
            bits, hot = (np.unpackbits(np.frombuffer(x[k], np.uint8))[: x["n"]].astype(bool) for k in ("bitmap", "hot"))
            numbers = (x["run"] << 21) + x["first"] + np.arange(x["n"])
            yield pa.RecordBatch.from_arrays([pa.array(numbers), ids[i].values, digests[i].values, pa.array(bits), pa.array(hot)], names=["row", "doc_id", "digest", "suspect", "hot"])


def mark_suspects(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row for each document: row, doc_id, SHA-256 digest, and whether its hash occurs again."""
    owner_bits = (partitions(docs.sparkSession) * OWNERS - 1).bit_length()
    text = text_of()
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.unhex(F.sha2(text, 256)).alias("digest"))
    runs = written(hashed.mapInArrow(lambda batches: _pack(batches, owner_bits, run_rows), _RUNS), "runs")
    answers = runs.select("run", "owner", "n", "rice", "codes").groupBy("owner").applyInArrow(_answer, _ANSWERS)
    return written(runs.drop("codes", "rice").join(answers, ["run", "owner"]).mapInArrow(_mark, _MARKED), "marked")


def classes(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, digest (binary SHA-256)."""
    marked = mark_suspects(docs, run_rows)
    suspects = marked.filter("suspect")
    ids = sent_if_small(written(suspects.select(F.col("doc_id").alias("suspect_id")).distinct(), "suspects"))
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("suspect_id")), "left_semi").select(text_of().alias("text"))
    by_bytes = texts.groupBy("text").agg(F.count("*").alias("size")).select(F.unhex(F.sha2("text", 256)).alias("digest"), "size")
    verified = by_bytes.groupBy("digest").agg(F.sum("size").alias("group_size"), F.count("*").alias("texts"))
    verified = verified.withColumn("digest", F.when(F.col("texts") == 1, F.col("digest")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest"))))
    stays = suspects.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("top"), F.max("hot").alias("hot"))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    groups = stays.join(verified, "digest").select("digest", F.explode(salts).alias("salt"), "group_size", F.col("top.doc_id").alias("keep_id"), F.col("top.row").alias("keep_row"))
    salted = suspects.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("row"), F.lit(SALTS))).otherwise(0).cast("int"))
    copies = salted.join(groups, ["digest", "salt"]).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")
    alone = marked.filter("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return alone.unionByName(copies)


def dedup(docs: DataFrame) -> DataFrame:
    """The documents without their copies: of equal texts the row with the largest doc_id."""
    verdict = written(classes(docs), "classes")
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(_KEY[0]), F.col("digest").alias(_KEY[1])]
    kept, dropped = (verdict.filter(F.col("kept") == flag).select(*key) for flag in (True, False))
    gone = dropped.distinct()
    # rows repeated under one doc_id: one of them stays, so the key alone can't decide
    twice = gone.join(kept, [*_KEY], "left_semi")
    left = docs.withColumns({_KEY[0]: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), _KEY[1]: F.unhex(F.sha2(text_of(), 256))})
    some_twice = bool(twice.take(1))
    gone = sent_if_small(written(gone.join(twice, [*_KEY], "left_anti") if some_twice else gone, "dropped"))
    stay = left.join(gone, [*_KEY], "left_anti")
    if some_twice:
        again = stay.join(twice, [*_KEY], "left_semi").dropDuplicates([*_KEY])
        stay = stay.join(twice, [*_KEY], "left_anti").unionByName(again)
    return stay.select(*docs.columns)
