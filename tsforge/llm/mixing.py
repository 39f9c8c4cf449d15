"""Mixing sources to target weights by a splitting tree.

A source's target is a number of words. It is met by whole passes over the
source and one partial pass; in each pass a seeded hash permutes the source's
documents, which are the blocks that are drawn. Blocks are whole: the partial
pass ends where its words come nearest to what is left of the target, so a
source's words are off by half of one document at most.

A permutation is ranked without sorting a source in one task: the top bits of
the hash deal it in buckets of some thousand documents, a bucket's offset
comes from the counts of those before it, and only buckets are sorted.

Output shards get their quotas from a tree. Its root holds how many blocks each
pass of each source draws; a node splits its counts between its halves by a
multivariate hypergeometric draw, so each shard holds what it would hold if all
blocks had been shuffled and dealt. A shard's blocks of a pass are then a range
of ranks of that pass's permutation, disjoint from every other shard's, and are
shuffled within the shard by another hash. What no shard's range holds is not
taken: both the mixed documents and the words taken of each are read from the
shards. Seeds are fixed: reruns agree.

The driver holds one row for each source and the shards' quotas for each pass,
``QUOTAS`` numbers at most; with very many sources there are fewer shards.

Defined results: a null text has no words; a null source is a source, the last;
documents without words are never drawn; repeated rows are blocks of their own,
also those that differ in other columns alone; a null doc_id stays null. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import WORD, deal_exactly, partitions, text_of, written

#: Weights of the sources in order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: Passes over a source at most.
PASSES = 3
SEED = 20_240_101
#: Documents in a bucket of a permutation, about, and buckets in a run of them.
BUCKET, RUN = 1_000, 4_096
#: Sources up to which their rows are sent to every task (some 100 bytes each).
SOURCES = 50_000
#: Numbers in the shards' quotas at most.
QUOTAS = 1_000_000


def targets(sizes: list[int], weights=WEIGHTS, most: float = PASSES) -> list[float]:
    """Shares of all words by weight; what is above a source's ``most`` passes is shared again."""
    total, n = float(sum(sizes)), len(sizes)
    weight = [weights[i % len(weights)] for i in range(n)]
    found, open_ = [0.0] * n, set(range(n))
    while open_:
        share = total / sum(weight[i] for i in open_)
        above = [i for i in open_ if weight[i] * share > most * sizes[i]]
        for i in above or open_:
            found[i] = float(most * sizes[i] if above else weight[i] * share)
        if not above:
            break
        total -= sum(found[i] for i in above)
        open_ -= set(above)
    return found


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many good ones are among ``n`` drawn of ``good + bad``, by inversion; exact at any count.

    Probabilities are taken relative to that of the mode, by the ratios of
    neighbours, out to 12 standard deviations, past which less than 1e-30 lies.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    spread = (n * (good / total) * (bad / total) * ((total - n) / (total - 1))) ** 0.5
    reach = int(12 * spread) + 60
    up, down = np.arange(mode, min(high, mode + reach), dtype=np.float64), np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    # p(k + 1) / p(k) upwards, p(k - 1) / p(k) downwards
    above = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    below = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    weights = np.concatenate([below[::-1], [1.0], above])
    sums = np.cumsum(weights)
    return mode - len(below) + int(np.searchsorted(sums, rng.random() * sums[-1], "right"))


def _draw(rng: np.random.Generator, counts: np.ndarray, k: int) -> np.ndarray:
    """A multivariate hypergeometric draw of ``k`` from ``counts``, one colour after the other."""
    out, left = np.zeros(len(counts), np.int64), int(counts.sum())
    for i, n in enumerate(counts.tolist()):
        left -= n
        out[i] = hypergeometric(rng, n, left, k)
        k -= int(out[i])
    return out


def split(counts: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Quotas (shards by passes) whose columns sum to the counts."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(counts)), np.int64)
    todo = [(0, shards, np.asarray(counts, np.int64))]
    while todo:
        first, n, here = todo.pop()
        if n == 1:
            out[first] = here
            continue
        half = n // 2
        left = _draw(rng, here, int(here.sum()) * half // n)
        todo += [(first + half, n - half, here - left), (first, half, left)]
    return out


def mark_of(docs: DataFrame) -> Column:
    """What tells a row from others of its doc_id and source: a hash of the text and all other columns."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]), {"ignoreNullFields": "false"}) if others else F.lit("")
    return F.xxhash64(text_of(), rest)


def sized(docs: DataFrame) -> DataFrame:
    """A written table of the documents' keys and words: row, doc_id, source, mark, size."""
    text = text_of()
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source",
            mark_of(docs).alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )


def _offsets(counts: DataFrame, key: list[str]) -> DataFrame:
    """What stands before each bucket of a pass: n0 blocks and w0 words.

    Two levels: buckets within a run of buckets, and runs, so that no task sums
    a hot source's buckets one by one.
    """
    runs = counts.withColumn("run", F.expr(f"bucket div {RUN}"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within, across = before(Window.partitionBy(*key, "run").orderBy("bucket")), before(Window.partitionBy(*key).orderBy("run"))
    upper = runs.groupBy(*key, "run").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    tops = upper.select(*key, "run", *(F.coalesce(F.sum(c).over(across), F.lit(0)).alias(f"{c}_top") for c in ("n", "words")))
    inner = runs.select(*key, "run", "bucket", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(c) for c in ("n", "words")))
    return inner.join(tops, [*key, "run"]).select(*key, "bucket", (F.col("n") + F.col("n_top")).alias("n0"), (F.col("words") + F.col("words_top")).alias("w0"))


class Mix:
    """The draws of a mix: what each shard takes of each document in each pass."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, most: int = PASSES, shards: int | None = None, seed: int = SEED, bucket: int = BUCKET):
        spark = docs.sparkSession
        self.docs, self.sizes, self.seed = docs, sized(docs), seed
        found = self.sizes.groupBy("source").agg(F.sum("size").alias("words"), F.sum((F.col("size") > 0).cast("long")).alias("blocks")).collect()
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        goal = targets([r.words for r in found], weights, most)
        rows = []
        for r, t in zip(found, goal):
            words = round(t)
            full = words // r.words if r.words else 0
            rows.append((r.source, r.words, t, full, words - full * r.words, max(1, (r.blocks // bucket).bit_length())))
        self.n_sources = len(rows)
        self.sources = spark.createDataFrame(rows, "source string, source_size long, target double, full int, rest long, bits int")
        self.shards = max(1, min(shards or partitions(spark), QUOTAS // max(1, len(rows) * (most + 1))))
        self.draws = written(self._draws(), "draws")

    def _sources(self) -> DataFrame:
        """The sources' rows, sent to each task while there are at most ``SOURCES`` of them."""
        here = self.sources.withColumnRenamed("source", "of")
        return F.broadcast(here) if self.n_sources <= SOURCES else here

    def _draws(self) -> DataFrame:
        """The permuted blocks of each pass: (row, doc_id, mark, source, size, pass, rank, wanted).

        The blocks of a pass that are ``wanted`` are its first by rank; their
        number is what the root of the tree holds for the pass.
        """
        here = self._sources()
        passes = F.expr("sequence(0, full - if(rest > 0, 0, 1))")
        rows = (
            self.sizes.filter("size > 0").join(here, F.col("source").eqNullSafe(F.col("of")))
            .filter("full > 0 or rest > 0").withColumn("pass", F.explode(passes))
            .withColumn("h", F.xxhash64(F.lit(self.seed), "pass", "source", "doc_id", "mark"))
            .withColumn("bucket", F.expr("shiftrightunsigned(h, 64 - bits)"))
            .select("row", "doc_id", "mark", "source", "size", "full", "rest", "pass", "h", "bucket", F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"))
        )
        key = ["none", "name", "pass"]
        counts = rows.groupBy(*key, "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
        offsets = _offsets(counts, key)
        inside = Window.partitionBy(*key, "bucket").orderBy("h", "doc_id", "mark", "row")
        ranked = rows.withColumns({"rank": F.row_number().over(inside) - 1, "ahead": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")})
        placed = ranked.join(offsets, [*key, "bucket"])
        # nearer to the rest with the block than without it; what stands before it only grows with the rank
        nearer = 2 * (F.col("w0") + F.col("ahead")) + F.col("size") <= 2 * F.col("rest")
        wanted = (F.col("pass") < F.col("full")) | nearer
        return placed.select("row", "doc_id", "mark", "source", "size", "pass", (F.col("rank") + F.col("n0")).alias("rank"), wanted.alias("wanted"))

    def taken(self) -> DataFrame:
        """For each document: doc_id, source, size, source_size, target, taken (the sum of what the shards draw of it)."""
        sums = self.dealt().groupBy("row").agg(F.sum("size").alias("taken"))
        here = self._sources().select("of", "source_size", "target")
        found = self.sizes.join(sums, "row", "left").join(here, F.col("source").eqNullSafe(F.col("of")))
        return found.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def dealt(self) -> DataFrame:
        """The blocks that shards draw, with their shard and their place in it (``order``)."""
        counts = self.draws.groupBy("source", "pass").agg(F.sum(F.col("wanted").cast("long")).alias("count")).collect()
        counts.sort(key=lambda r: (r.source is None, r.source or "", r["pass"]))
        quotas = split(np.array([r["count"] for r in counts], np.int64), self.shards, self.seed)
        ends = {(r.source, r["pass"]): np.cumsum(quotas[:, i]) for i, r in enumerate(counts)}

        def run(batches):
            for batch in batches:
                source, number = (batch.column(k).to_pylist() for k in ("source", "pass"))
                rank, shard = batch.column("rank").to_numpy(), np.zeros(batch.num_rows, np.int32)
                keys = list(zip(source, number))
                for key in set(keys):
                    mine = np.fromiter((k == key for k in keys), bool, len(keys))
                    shard[mine] = np.searchsorted(ends[key], rank[mine], "right")
                held = pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=[*batch.schema.names, "shard"])
                yield held.filter(pa.array(shard < shards))  # ranks past the last quota are nobody's

        shards, blocks = self.shards, self.draws.drop("wanted")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields)
        placed = blocks.mapInArrow(run, f"{schema}, shard int")
        return placed.withColumn("order", F.xxhash64(F.lit(self.seed + 1), "pass", "source", "doc_id", "mark"))

    def documents(self) -> DataFrame:
        """The mixed documents, shard by shard and shuffled in each: a row for each time that a document is taken."""
        docs, columns = self.docs, self.docs.columns
        key = ["__tsforge_id", "__tsforge_mark", "__tsforge_source"]
        name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        source = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
        draws = self.dealt().select(name.alias("__tsforge_id"), F.col("mark").alias("__tsforge_mark"), source.alias("__tsforge_source"), F.col("shard").alias("__tsforge_shard"), F.col("order").alias("__tsforge_order"))
        keyed = docs.withColumns({"__tsforge_id": name, "__tsforge_mark": mark_of(docs), "__tsforge_source": source})
        if self.sizes.groupBy("doc_id", "mark", "source").count().filter("count > 1").take(1):
            keyed = keyed.dropDuplicates(key)  # the draws have a row for each repeated row
        mixed = keyed.join(draws, key)
        return deal_exactly(mixed, F.col("__tsforge_shard"), self.shards).sortWithinPartitions("__tsforge_shard", "__tsforge_order").select(*columns)
