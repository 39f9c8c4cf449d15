"""Near copies by 5-word shingles: wide SimHash, pigeonhole blocks, true similarity verified.

The near-dedup stage of the pipeline. Its rule is wider than the digest contract
of op7: two texts link if the sets of their 5-word shingles have a Jaccard
similarity of 0.8 or more. The method is op7's, with a fingerprint wide enough for
that: at 0.8 about 15 % of a SimHash's bits differ, so of 64 bits no block worth
dealing stays equal. ``WORDS`` words of 64 bits are cut in keys; by pigeonhole, texts
whose fingerprints differ in fewer bits than there are keys share one. A key has
16 bits at least, and as many as it takes that no more than ``CHANCE`` texts have it by
chance: two bits more for four times as many texts. Longer keys stay equal less
often, so there are more of them (``Plan``: 160 of 16 bits, 19 % more for each bit), cut
from the fingerprint in seeded orders of its bits. So a text meets at most
``CHANCE`` others by chance at each of its keys, and what it costs grows with the
fourth root of the corpus, not with the corpus. A pair at 0.8 shares no key once in
160,000 times if the sets are large, once in 20,000 at the worst of small ones (12
and 15 shingles). The one size where more pairs would be lost, four shingles of a
text with five, is looked up exactly.

Of the texts that share a key, those within ``DISTANCE`` in the first three words
meet (by chance, one comparison in a thousand million), and so does what such links
connect. A task of keys returns what meets at any of them as stars, and a group is
what the stars of all tasks connect: each text is in one group, however many keys
it shares. A group so large that its cells, below, would be more rows for a text than
it has keys is compared key by key, where the same pairs meet that keys promise.

A group of more than a chunk is compared with ``HUBS`` of its texts first, by true
similarity; what agrees is one class. Pairs that remain are those of different
classes: the largest class is cut in chunks, and so are the others, and every two
chunks are a cell, but for two of the largest class. In a cell, texts of different
classes whose fingerprints differ in ``APART`` bits at most are compared. So a class,
however large, costs a comparison with the hubs for each member and one row for
each chunk of other classes. No pair of a group is left out but one that differs in
more bits than ``APART``, by calculation eight deviations above the mean at 0.8.

Defined results: words are as in ``simhash``, ASCII letters in lower case; a
null text counts as empty; texts without words are alike; fewer than five words
are one shingle. Texts are named by 64 bits of a hash; if two that differ ever had
the same, that would be an error, never a silent drop. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import deal_exactly, partitions, sent_if_small, small_batches, text_of, written
from tsforge.llm.simhash import _LOWER, _link_batch, components

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
SEED = 42
#: Words of 64 bits of a fingerprint, and the first ones that are compared where texts share a key.
WORDS, COMPARED = 40, 3
#: Bits of a key at least, the share of them that stays equal at 0.8 (at the worst size), and texts that may share a key by chance.
BITS, SAME, CHANCE = 16, 0.84, 32
#: Bits of the compared words that near copies may differ in: at 0.8 that is 31 bits at most on average, and by calculation one pair in 400,000 at the worst size has more.
DISTANCE = 54
#: Bits of a whole fingerprint that similar texts may differ in: at 0.8 that is 410 bits at most on average, with a deviation of 19 (but for four shingles of five, which are looked up).
APART = 560
#: Rows of keys for one task, and texts of a key up to which all pairs are taken at once.
DEALT, SMALL = 1 << 20, 64
#: Texts of one group in a chunk, hubs of a group that has more.
CHUNK, HUBS = 512, 8

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, WORDS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
#: Shingles that are added up before bits are unpacked, and rows of them in a step.
_ADDED, _STEP = 15, 85
#: A text at one of its keys: the key's hash (among those of a task), the text, the words that are compared.
_AT = np.dtype([("key", "<u4"), ("mark", "<i8"), ("words", "<u8", (COMPARED,))])
#: Rows that are compared at once.
_SOME = 1 << 15
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Plan:
    """The keys of so many texts: bits of each, and how many."""

    bits: int
    keys: int

    @classmethod
    def of(cls, texts: int) -> Plan:
        bits = max(BITS, (max(texts, 1) // CHANCE).bit_length())
        return cls(bits, round(64 * WORDS // 16 * SAME ** (16 - bits)))

    @functools.cached_property
    def places(self) -> np.ndarray:
        """The bits of each key: the fingerprint cut as it is, then again and again in other orders."""
        width, rng, cuts = 64 * WORDS, np.random.default_rng(SEED), []
        each = width // self.bits
        while sum(map(len, cuts)) < self.keys:
            order = rng.permutation(width) if cuts else np.arange(width)
            cuts.append(order[: each * self.bits].reshape(each, self.bits))
        return np.concatenate(cuts)[: self.keys]

    def of_words(self, words: np.ndarray) -> np.ndarray:
        """The keys of fingerprints (a row each), mixed with their numbers."""
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        found = np.zeros((len(words), self.keys), np.uint64)
        for column in self.places.T:
            found <<= np.uint64(1)
            found |= bits[:, column]
        found ^= np.arange(self.keys, dtype=np.uint64) << np.uint64(48)
        found = (found ^ found >> np.uint64(31)) * _MIX
        return found ^ found >> np.uint64(29)


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's distinct word shingles; one of them at least."""
    words = text.translate(_LOWER).split()
    size = max(1, min(size, len(words)))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if not words:
        starts, ends = np.zeros(1, np.int64), np.zeros(1, np.int64)
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), np.uint64, n))


def _added(rows: np.ndarray) -> list[np.ndarray]:
    """The binary digits, lowest first, of the sums of each bit over the first axis, by full adders."""
    digits, level = [], list(rows)
    while level:
        above = []
        while len(level) > 2:
            a, b, c = level.pop(), level.pop(), level.pop()
            either = a ^ b
            above.append(a & b | either & c)
            level.append(either ^ c)
        if len(level) == 2:
            a, b = level
            above.append(a & b)
            level = [a ^ b]
        digits.append(level[0])
        level = above
    return digits


def fingerprint(found: np.ndarray) -> np.ndarray:
    """The words of the SimHash of a set of shingles: a bit is 1 if set in over half of their hashes of that width."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(found), _ADDED * _STEP):
        part = found[at : at + _ADDED * _STEP]
        hashes = np.zeros((-(-len(part) // _ADDED) * _ADDED, WORDS), np.uint64)
        np.multiply(part[:, None], _FACTORS[None], out=hashes[: len(part)])
        hashes ^= hashes >> np.uint64(32)
        for i, digit in enumerate(_added(hashes.reshape(_ADDED, -1, WORDS))):
            ones += np.unpackbits(digit.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8).astype(np.int64) << i
    return np.packbits(2 * ones > len(found), bitorder="little").view("<u8")


def _sums(found: np.ndarray) -> np.ndarray:
    """Of four shingles their sum, of five that of any four, else nothing."""
    total = found.sum(dtype=np.uint64)
    return total[None] if len(found) == 4 else total - found if len(found) == 5 else found[:0]


def _keys(batches):
    """The words of each text's fingerprint, and the sums of four or five shingles after them."""
    for batch in batches:
        sets = [shingles(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
        found = [np.concatenate([fingerprint(s), _sums(s)]).view(np.int64) for s in sets]
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        own = [batch.column(c) for c in ("doc_id", "mark", "digest")]
        yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "mark", "digest", "keys"])


def _blocks(batches, n: int, plan: Plan):
    """The rows of texts' keys for each of ``n`` tasks, as bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            some = batch.slice(at, 128)
            words = np.zeros((some.num_rows, WORDS), np.uint64)
            for i, w in enumerate(some.column("keys").to_pylist()):
                words[i, : len(w[:WORDS])] = np.array(w[:WORDS], np.int64).view(np.uint64)
            keys = plan.of_words(words)
            rows = np.zeros(keys.shape, _AT)
            rows["key"] = keys & np.uint64(0xFFFFFFFF)
            rows["mark"] = some.column("mark").to_numpy()[:, None]
            rows["words"] = words[:, None, :COMPARED]
            task = ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int64).ravel()
            order = np.argsort(task, kind="stable")
            task, rows = task[order], rows.ravel()[order]
            cuts = np.r_[0, np.flatnonzero(task[1:] != task[:-1]) + 1, len(task)].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(task[cuts[:-1]].astype(np.int32)), pa.array([rows[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["task", "rows"])


def _apart(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Bits of the compared words that differ."""
    return np.bitwise_count(rows["words"] ^ others["words"]).sum(axis=-1, dtype=np.int64)


def _small_groups(rows: np.ndarray, at: np.ndarray) -> list[list[int]]:
    """What is connected by links within a distance among rows of one key, for all keys at once; ``at`` are those of small keys."""
    group, step = {}, 1
    while len(at):
        at = at[at + step < len(rows)]
        at = at[rows["key"][at + step] == rows["key"][at]]
        # some at a time: what is compared is copied
        met = [some[_apart(rows[some], rows[some + step]) <= DISTANCE] for some in np.split(at, range(_SOME, len(at), _SOME))]
        for i in np.concatenate(met).tolist():
            a, b = group.setdefault(i, [i]), group.setdefault(i + step, [i + step])
            if a is not b:
                a, b = (a, b) if len(a) >= len(b) else (b, a)
                a += b
                group.update(dict.fromkeys(b, a))
        step += 1
    return list({id(g): g for g in group.values()}.values())


def _large_groups(rows: np.ndarray):
    """The same for one key, by what each text met reaches of the rest."""
    rest = rows
    while len(rest) > 1:
        met, rest = [rest[:1]], rest[1:]
        while len(met[-1]) and len(rest):
            near, step = np.zeros(len(rest), bool), max(1, (1 << 18) // len(rest))
            for at in range(0, len(met[-1]), step):
                near |= (_apart(met[-1][at : at + step, None], rest[None]) <= DISTANCE).any(axis=0)
            met.append(rest[near])
            rest = rest[~near]
        if len(met[1:]) and len(met[1]):
            yield np.concatenate(met)


def _groups(batches):
    """Groups of what meets in one task: a key for its texts, the least of them, how many there are, and each."""
    parts = [np.frombuffer(b"".join(batch.column("rows").to_pylist()), _AT) for batch in batches]
    if not any(map(len, parts)):
        return
    rows = np.concatenate(parts)
    del parts
    rows = rows[np.argsort(rows["key"], kind="stable")]
    cuts = np.r_[0, np.flatnonzero(rows["key"][1:] != rows["key"][:-1]) + 1, len(rows)]
    sizes = np.diff(cuts)
    found = [rows[g] for g in _small_groups(rows, np.flatnonzero(np.repeat(sizes <= SMALL, sizes)))]
    found += [g for i in np.flatnonzero(sizes > SMALL).tolist() for g in _large_groups(rows[cuts[i] : cuts[i + 1]])]
    marks = {xxhash.xxh64_intdigest(m.tobytes(), SEED): m for m in (np.sort(g["mark"]) for g in found)}
    for i in range(0, len(marks), 512):
        some = dict(list(marks.items())[i : i + 512])
        sizes = [len(m) for m in some.values()]
        keys, hubs = np.array(list(some), np.uint64).view(np.int64), np.array([m[0] for m in some.values()])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(x, sizes)) for x in (keys, hubs, np.array(sizes, np.int64))] + [pa.array(np.concatenate(list(some.values())))], names=["key", "hub", "m", "mark"])


def _stars(batches):
    """What the groups of one task connect: links of the least text with each other one."""
    root: dict[int, int] = {}

    def find(x):
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in _groups(batches):
        for hub, mark in zip(batch.column("hub").to_pylist(), batch.column("mark").to_pylist()):
            a, b = find(hub), find(mark)
            root[max(a, b)] = min(a, b)
    yield _link_batch([(least, x) for x in root if (least := find(x)) != x])


def _sets(batches):
    """The shingles of each text, and the words of its fingerprint."""
    for batch in batches:
        found = [shingles(t.as_py() or b"").tobytes() for t in batch.column("text").cast(pa.binary())]
        words = [np.array(w[:WORDS], np.int64).tobytes().ljust(8 * WORDS, b"\0") for w in batch.column("keys").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(found, pa.binary()), pa.array(words, pa.binary())], names=["mark", "found", "words"])


def _similar(own: np.ndarray, others: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Which of the other sets are similar to one."""
    top, bottom, n = SIMILARITY.numerator, SIMILARITY.denominator, len(own)
    found = bottom * np.minimum(sizes, n) >= top * np.maximum(sizes, n)
    at = np.flatnonzero(found)
    if len(at):
        theirs, counts = np.concatenate([others[j] for j in at.tolist()]), sizes[at]
        hit = own[np.minimum(np.searchsorted(own, theirs), n - 1)] == theirs
        both = np.add.reduceat(hit.astype(np.int64), np.cumsum(counts) - counts)
        found[at] = bottom * both >= top * (counts + n - both)
    return found


def forest(sets: list[np.ndarray], classes: np.ndarray, words: np.ndarray, first: int = 0) -> list[tuple[int, int]]:
    """Links that connect what pairs of similar sets connect, of which the classes are connected already.

    Pairs are those of all sets, or those of the ``first`` ones with the rest.
    """
    root = np.unique(classes, return_inverse=True)[1]
    sizes, links = np.array([len(s) for s in sets], np.int64), []
    for i in range(first or len(sets) - 1):
        start = first or i + 1
        rest = np.flatnonzero(root[start:] != root[i]) + start
        rest = rest[np.bitwise_count(words[rest] ^ words[i]).sum(axis=1, dtype=np.int64) <= APART]
        if len(rest):
            for j in rest[_similar(sets[i], [sets[j] for j in rest.tolist()], sizes[rest])].tolist():
                if root[j] != root[i]:
                    links.append((i, j))
                    root[root == root[j]] = root[i]
    return links


def _by_group(batches, names: tuple[str, ...], close):
    """Rows sorted by their group, which is (group, part): the links that ``close`` finds in each."""
    current, rows, links = None, [], []
    for batch in batches:
        for group, part, *row in zip(*(batch.column(k).to_pylist() for k in ("group", "part", *names))):
            if (group, part) != current:
                if rows:
                    links += close(rows)
                current, rows = (group, part), []
            rows.append(row)
        if len(links) > 50_000:
            yield _link_batch(links)
            links = []
    if rows:
        links += close(rows)
    yield _link_batch(links)


def _with_hub(rows):
    """The first row is the group's hub: links from it to what is similar."""
    hub, *marks = (mark for mark, _ in rows)
    own, *sets = (np.frombuffer(found, np.uint64) for _, found in rows)
    near = _similar(own, sets, np.array([len(s) for s in sets], np.int64)) if sets else []
    return [(hub, m) for m, yes in zip(marks, near) if yes]


def _across(rows):
    """Links between rows of different classes in a cell: of two chunks, or of one with itself."""
    marks, classes, sides, found, words = zip(*rows)
    if sides[0] or len(set(classes)) == 1:
        return []
    first = sides.index(1) if sides[-1] else 0
    sets, words = [np.frombuffer(f, np.uint64) for f in found], np.frombuffer(b"".join(words), np.uint64).reshape(-1, WORDS)
    return [(marks[i], marks[j]) for i, j in forest(sets, np.array(classes), words, first)]


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("mark"), F.unhex(F.sha2(text_of(), 256)).alias("digest"), text_of().alias("text"))


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "group", "part").sortWithinPartitions("group", "part", *order)


def _patience(plan: Plan, chunk: int) -> int:
    """Texts of a group from which its cells would be more rows for a text than it has keys."""
    return chunk * plan.keys


def _members(distinct: DataFrame, chunk: int) -> DataFrame:
    """Groups: a key for its texts, how many there are, and each."""
    texts = distinct.count()
    plan = Plan.of(texts)
    # as few tasks as their memory allows: a task's stars have a text once for all its keys
    n, most = max(1, -(-texts * plan.keys // DEALT)), _patience(plan, chunk)

    def met(texts, function, schema):
        return deal_exactly(texts.mapInArrow(lambda it: _blocks(it, n, plan), "task int, rows binary"), F.col("task"), n).mapInArrow(function, schema)

    connected = written(components(met(distinct, _stars, "u long, v long")), "connected")
    sizes = written(connected.groupBy("root").agg(F.count("*").alias("m")), "sizes")
    members = connected.join(sent_if_small(sizes), "root").select(F.col("root").alias("key"), "m", F.col("node").alias("mark"))
    if not sizes.filter(F.col("m") > most).head(1):
        return written(members, "members")
    chained = written(members.filter(F.col("m") > most).select("mark"), "chained")
    by_key = met(distinct.join(sent_if_small(chained), "mark"), _groups, "key long, hub long, m long, mark long")
    return written(members.filter(F.col("m") <= most).unionByName(by_key.select("key", "m", "mark").distinct()), "members")


def links(docs: DataFrame, distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) between marks of texts that span what is similar; ``distinct`` has each mark with its fingerprint."""
    spark = docs.sparkSession
    distinct = written(distinct, "fingerprints")
    members = _members(distinct, chunk)
    sums = distinct.select("mark", F.size("keys").alias("n"), F.explode(F.expr(f"slice(keys, {WORDS + 1}, 5)")).alias("sum"))
    fours = sums.filter(f"n = {WORDS + 1}").groupBy("sum").agg(F.min("mark").alias("group"))
    fives = written(sums.filter(f"n = {WORDS + 5}").join(fours, "sum").select("group", "mark").distinct(), "of-four-shingles")
    needed = written(members.select("mark").unionByName(fives.select("mark")).unionByName(fives.select(F.col("group").alias("mark"))).distinct(), "needed")
    small_batches(spark)
    texts = _marked(docs).select("mark", "text").join(sent_if_small(needed), "mark").dropDuplicates(["mark"])
    prints = distinct.select("mark", F.expr(f"slice(keys, 1, {WORDS})").alias("keys"))
    sets = written(texts.join(prints, "mark").select("mark", "text", "keys").mapInArrow(_sets, "mark long, found binary, words binary"), "shingles")

    # each text of a large group with the group's hubs
    large = members.filter(F.col("m") > chunk)
    hubs = written(large.groupBy("key", F.pmod("mark", F.lit(HUBS))).agg(F.min("mark").alias("group")).select("key", "group"), "hubs-of-groups")
    spokes = large.join(sent_if_small(hubs), "key").filter("mark <> group").select("group", "mark").unionByName(fives).distinct()
    sizes = written(spokes.groupBy("group").agg(F.ceil(F.count("*") / chunk).alias("parts")), "hubs")
    spokes = spokes.join(sent_if_small(sizes), "group").withColumn("part", F.pmod(F.xxhash64("mark"), F.col("parts")))
    hubs = sizes.select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("group").alias("mark"))
    rows = spokes.select("group", "part", "mark", F.lit(1).alias("last")).unionByName(hubs.withColumn("last", F.lit(0))).join(sets.select("mark", "found"), "mark")
    first = written(_dealt(rows, "last").mapInArrow(lambda it: _by_group(it, ("mark", "found"), _with_hub), "u long, v long"), "first-links")

    # pairs of a group's texts that are of different classes by now: cells of two chunks
    roots = written(components(first), "classes")
    classed = members.join(sent_if_small(roots.withColumnRenamed("node", "mark")), "mark", "left").withColumn("root", F.coalesce("root", "mark"))
    counted = classed.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("classes"), F.max("n").alias("most"), F.sum("n").alias("all"))
    one = F.col("all") <= chunk
    others, own = F.when(one, 1).otherwise(F.ceil((F.col("all") - F.col("most")) / chunk)), F.when(one, 0).otherwise(F.ceil(F.col("most") / chunk))
    mixed = written(counted.filter("classes > 1").select("key", "largest", others.cast("long").alias("others"), own.cast("long").alias("own")), "mixed-groups")
    inside, spread = (F.col("own") > 0) & (F.col("root") == F.col("largest")), F.xxhash64("mark")
    rows = classed.join(sent_if_small(mixed), "key").withColumn("chunk", F.when(inside, F.col("others") + F.pmod(spread, "own")).otherwise(F.pmod(spread, "others")))
    chunks = F.col("others") + F.col("own")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("others")).otherwise(chunks) - 1)))
    cell = F.least("chunk", "other") * chunks + F.greatest("chunk", "other")
    rows = rows.select(F.col("key").alias("group"), cell.alias("part"), "mark", "root", (F.col("chunk") > F.col("other")).cast("int").alias("side")).join(sets, "mark")
    second = _dealt(rows, "side").mapInArrow(lambda it: _by_group(it, ("mark", "root", "side", "found", "words"), _across), "u long, v long")
    return first.unionByName(second.distinct())


def representatives(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The documents of which one of each group of near copies stays: that with the smallest doc_id.

    Rows without a doc_id can't be told apart and stay.
    """
    small_batches(docs.sparkSession)
    found = written(_marked(docs).mapInArrow(_keys, "doc_id long, mark long, digest binary, keys array<long>"), "keys")
    same = F.when(F.min("digest") == F.max("digest"), F.first("keys")).otherwise(F.raise_error(F.lit("two texts share a hash of 64 bits")))
    distinct = found.groupBy("mark").agg(same.alias("keys"))
    roots = written(components(links(docs, distinct, chunk)), "components")
    named = found.select("doc_id", "mark").join(sent_if_small(roots.withColumnRenamed("node", "mark")), "mark", "left").withColumn("root", F.coalesce("root", "mark"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    gone = written(named.join(least, "root").filter("doc_id != least").select(F.col("doc_id").alias("__tsforge_id"), F.col("mark").alias("__tsforge_mark")).distinct(), "near-copies")
    marked = docs.withColumns({"__tsforge_id": F.col("doc_id").cast("long"), "__tsforge_mark": F.xxhash64(text_of())})
    return marked.join(sent_if_small(gone), ["__tsforge_id", "__tsforge_mark"], "left_anti").select(*docs.columns)
