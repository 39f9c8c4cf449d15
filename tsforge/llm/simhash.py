"""SimHash near-dedup with pigeonhole blocks.

A fingerprint's 64 bits are cut in six blocks. Two fingerprints that differ in
three bits at most agree on at least three of the six blocks, so a pair shares
one of the 20 keys (three blocks chosen, about 32 bits). Distinct fingerprints
are dealt by key, those that share a key are compared by exclusive-or and bit
count, and what links them is kept as a spanning forest: a group of copies
gives as many links as it has members, never all its pairs. A key that very
many fingerprints share is cut in chunks, and each pair of chunks is a task of
its own, so no task holds more than two chunks.

Components come from the alternation of large-star and small-star steps, each
written to the shared folder.

Defined results: a null text counts as empty; a text without words has the
fingerprint zero, which links like any other; fewer than three words are one
shingle; a null doc_id never is a component's id unless all of it are null;
repeated rows each get a row. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import partitions, sent_if_small, small_batches, written

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Widths of the blocks that a fingerprint is cut in.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Fingerprints of one key in a chunk.
CHUNK = 4096

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) for each document."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def _masks() -> list[int]:
    """A mask for each choice of as many blocks as stay equal at the allowed distance."""
    edges = np.cumsum((0, *BLOCKS)).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, len(BLOCKS) - DISTANCE)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(values: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect what pairs within the distance connect, one fewer than members."""
    n = len(values)
    root = np.arange(n)
    links = []
    for i in range(n - 1):
        rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        if not len(rest):
            continue
        near = rest[np.bitwise_count(values[rest] ^ values[i]) <= distance]
        for j in near.tolist():
            if root[j] != root[i]:
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def _compare(batches):
    """Rows sorted by (table, key, a, b) to the links within each of those groups."""
    def close(fps):
        values = np.unique(np.concatenate(fps))
        return [(values[i], values[j]) for i, j in forest(values.view(np.uint64))]

    current, fps, links = None, [], []
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("t", "key", "a", "b")])
        values = batch.column("fp").to_numpy()
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(values)].tolist()):
            if a == b:
                continue
            key = tuple(keys[:, a])
            if key != current:
                if fps:
                    links += close(fps)
                current, fps = key, []
            fps.append(values[a:b])
        if len(links) > 50_000:
            yield _link_batch(links)
            links = []
    if fps:
        links += close(fps)
    yield _link_batch(links)


def _link_batch(links):
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def links(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that span what is within the distance."""
    spark = distinct.sparkSession
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(_masks())])
    keyed = distinct.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("m")).filter("m > 1")
    part = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    dealt = (
        keyed.join(shared, ["t", "key"])
        .withColumn("chunks", F.ceil(F.col("m") / chunk))
        .withColumn("part", part)
        .select("t", "key", "fp", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
        .select("t", "key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "fp")
    )
    dealt = dealt.repartition(partitions(spark), "t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")
    return dealt.mapInArrow(_compare, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for each node of the links (u, v).

    What a node's links share is written before it meets them: it is broadcast while it is small, and beyond that
    adaptive execution can split the links of a node that has very many.
    """
    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = written(edges, "links")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        least = sent_if_small(written(least, "least-of-links"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("w").alias("v")).filter("u != v").distinct()
        large = written(large, "large-star")
        # every link now points from the larger node to the smaller
        least = written(large.groupBy("u").agg(F.min("v").alias("w")), "least-of-links")
        moved = large.join(sent_if_small(least), "u").filter("v != w").select(F.col("v").alias("u"), F.col("w").alias("v"))
        edges = written(moved.unionByName(least.select("u", F.col("w").alias("v"))).distinct(), "small-star")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id for each document."""
    fps = written(fingerprints(docs), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = written(named.join(smallest, "root").select("fp", "component_id"), "labels")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")
