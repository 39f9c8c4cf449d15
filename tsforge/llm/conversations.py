"""Conversation structure repair: the cheapest edits that make roles alternate.

Roles are read by their first letters; a repaired conversation's letters are
none, or ``ua`` one or more times after at most one ``s``. Edits of a row: Keep
(0), Rerole to user or assistant (2), Delete (3; all that a blank or repeated
row may have); an empty user or assistant row may be Inserted anywhere (2). A
truncated row that stays costs 1 more.

1. Rows are dealt by ranges of (conversation, turn, role) and sorted, so a
   conversation of any length is spread over tasks, and read as a stream.
2. Edits are arcs of a graph whose nodes are (rows read, state); states are:
   nothing yet, after ``s``, after ``u``, after ``a``. Least costs from the start
   and least costs to the end tell which arcs are tight, that is, on some
   cheapest path. From the start, the set of nodes that the least letters so
   far lead to takes the least letter of its tight arcs, again and again. A
   letter and a state leave no choice of role, so letters tell the result.
3. A conversation that lies within one task's range is done there. Others (at
   the ends of a range, or longer than ``BLOCK_ROWS`` or ``BLOCK_BYTES``) are
   blocks: repeated rows are found by one exchange of digests, a task gets one
   byte for each row of a conversation, as its answer has one letter for each,
   and texts go through the digest in order, block by block.

Defined results: a null role or text counts as one space, as do null ids and
turns where damage is drawn. A null conv_id is a conversation of its own; null
turns come first and leave no gaps. Rows of one turn are ordered by role, then
text (by their bytes). An empty role has no letter, so it may stay anywhere; a
role of other letters than s, u, a can't stay. Repeated rows are rows. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import small_batches, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows and bytes of text of a block: what a task holds of one conversation.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20

_SEPARATORS = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

#: Kinds of a row by its role's letter; a code is a kind, and whether the row must go and is truncated.
_KINDS = {"s": 0, "u": 1, "a": 2, "": 3}
_OTHER, _MUST_GO, _CUT = 4, 8, 16

#: States, and where a letter leads from each (none: -1).
_START, _S, _U, _A = range(4)
_NEXT = ((_S, -1, -1, -1), (_U, _U, -1, _U), (-1, -1, _A, -1), (_START, _S, _U, _A), (-1, -1, -1, -1))
#: What an inserted row, or one of a new role, is in each state.
_TURN, _ROLE = (_U, _U, _A, _U), ("user", "user", "assistant", "user")
_FAR = 1 << 60


def _arcs(code: int) -> list[tuple[str, int, tuple]]:
    """A row's edits in the order of their letters: letter, cost, next states."""
    late = TRUNCATED if code & _CUT else 0
    delete = [("D", DELETE, (_START, _S, _U, _A))]
    return delete if code & _MUST_GO else [*delete, ("K", KEEP + late, _NEXT[code & 7]), ("R", REROLE + late, _TURN)]


_ARCS = {kind | more: _arcs(kind | more) for kind in range(5) for more in (0, _MUST_GO, _CUT)}


def _plan(codes: bytes) -> tuple[int, str]:
    n = len(codes)
    forward, reached = [], [0, _FAR, _FAR, _FAR]
    for i in range(n + 1):
        for _ in range(3):  # inserts lead on within a layer, three times at most
            for x in range(4):
                reached[_TURN[x]] = min(reached[_TURN[x]], reached[x] + INSERT)
        forward.append(reached)
        if i < n:
            row, reached = reached, [_FAR] * 4
            for _, cost, to in _ARCS[codes[i]]:
                for x, y in enumerate(to):
                    if y >= 0:
                        reached[y] = min(reached[y], row[x] + cost)
    backward, left = [], [0, _FAR, _FAR, 0]
    for i in range(n, -1, -1):
        for _ in range(3):
            for x in range(4):
                left[x] = min(left[x], left[_TURN[x]] + INSERT)
        backward.append(left)
        if i:
            row, left = left, [_FAR] * 4
            for _, cost, to in _ARCS[codes[i - 1]]:
                for x, y in enumerate(to):
                    if y >= 0:
                        left[x] = min(left[x], row[y] + cost)
    backward.reverse()
    best = backward[0][_START]

    letters, i, frontier = [], 0, {_START}
    while not (i == n and any(x in (_START, _A) and forward[n][x] == best for x in frontier)):
        here, after = forward[i], backward[i]
        steps = [("I", i, _TURN, INSERT)] + ([(letter, i + 1, to, cost) for letter, cost, to in _ARCS[codes[i]]] if i < n else [])
        for letter, j, to, cost in sorted(steps):
            rest = after if j == i else backward[j]
            reach = {to[x] for x in frontier if to[x] >= 0 and here[x] + cost + rest[to[x]] == best}
            if reach:
                letters.append(letter)
                i, frontier = j, reach
                break
    return best, "".join(letters)


_short_plan = functools.lru_cache(1 << 14)(_plan)


def plan(codes: bytes) -> tuple[int, str]:
    """The least cost of a conversation's rows and the least of its cheapest edits, as letters."""
    return _short_plan(codes) if len(codes) <= 32 else _plan(codes)


def fault(role: str, text: str, again: bool) -> str:
    """A row's first fault: blank, duplicate, truncated or none."""
    said = text.rstrip(_SEPARATORS)
    return "blank" if not said else "duplicate" if again else "" if said[-1] in ".!?" else "truncated"


def _code(role: str, wrong: str) -> int:
    kind = _KINDS.get(role[:1], _OTHER)
    return kind | (_MUST_GO if wrong in ("blank", "duplicate") else _CUT if wrong == "truncated" else 0)


def summary(turns: list, roles: list[str], texts: list[str], again: list[bool]) -> dict:
    """A block of rows in order: codes, counts of faults, and what joins it to the next block."""
    wrong = [fault(*row) for row in zip(roles, texts, again)]
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    return {
        "codes": bytes(map(_code, roles, wrong)),
        **{name: wrong.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "low": known[0] if known else None, "high": known[-1] if known else None, "distinct": len(set(known)),
        "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
    }


def verdict(blocks: list[dict]) -> dict:
    """The result of a conversation from the summaries of its blocks in order."""
    blocks = [b for b in blocks if b["codes"]]
    timed = [b for b in blocks if b["distinct"]]
    distinct = sum(b["distinct"] for b in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
    cost, audit = plan(b"".join(b["codes"] for b in blocks))
    return {
        "gaps": timed[-1]["high"] - timed[0]["low"] + 1 - distinct if timed else 0,
        **{name: sum(b[name] for b in blocks) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(b["illegal"] for b in blocks) + sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(blocks, blocks[1:])),
        "cost": cost, "audit": audit,
    }


def apply(letters: str, roles: list[str], texts: list[str], state: int = _START) -> tuple[list[dict], int]:
    """The repaired rows of edits, and the state after them."""
    out, i = [], 0
    for letter in letters:
        if letter == "I":
            out.append({"role": _ROLE[state], "text": ""})
            state = _TURN[state]
            continue
        if letter == "K":
            out.append({"role": roles[i], "text": texts[i]})
            state = _NEXT[_KINDS[roles[i][:1]]][state]
        elif letter == "R":
            out.append({"role": _ROLE[state], "text": texts[i]})
            state = _TURN[state]
        i += 1
    return out, state


def _lines(rows: list[dict]) -> bytes:
    return "\n".join(f"{r['role']}:{r['text']}" for r in rows).encode("utf-8")


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = f"conv_id long, {', '.join(f'{n} long' for n in _LONGS)}, audit string, repaired_sha256 string"
_ROWS = "array<struct<role:string,text:string>>"
_DONE = f"{RESULT}, rows {_ROWS}, done boolean, part int, block int, turns array<long>, digests array<binary>"
_SUMMARY = "conv_id long, part int, block int, codes binary, blank long, duplicate long, truncated long, illegal long, low long, high long, distinct long, first string, last string"
_EDITS = f"conv_id long, part int, block int, letters string, state int, {', '.join(f'{n} long' for n in _LONGS)}, audit string"
_REPAIRED = f"conv_id long, part int, block int, rows {_ROWS}, {', '.join(f'{n} long' for n in _LONGS)}, audit string"


def _type(schema: str) -> pa.Schema:
    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    rows = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    kinds = plain | {_ROWS: rows, "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.strip().split(" ", 1) for part in schema.replace(_ROWS, "ROWS").split(",")) for kind in [_ROWS if kind == "ROWS" else kind]])


def _flush(out: list[dict], schema: str):
    batch = pa.RecordBatch.from_pylist(out, schema=_type(schema))
    out.clear()
    return batch


def _digest(role: str, text: str) -> bytes:
    name = role.encode("utf-8")
    return hashlib.sha256(b"%d:%s%s" % (len(name), name, text.encode("utf-8"))).digest()


class _Block:
    """Rows of one conversation that a task holds."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.roles, self.texts, self.size = conv_id, [], [], [], 0

    def add(self, turn, role: str, text: str, copies: int):
        for _ in range(copies):
            self.turns.append(turn)
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(role) + len(text)

    def full(self) -> bool:
        return len(self.turns) >= BLOCK_ROWS or self.size >= BLOCK_BYTES

    def finished(self) -> dict:
        seen, again = set(), []
        for row in zip(self.roles, self.texts):
            again.append(row in seen)
            seen.add(row)
        found = verdict([summary(self.turns, self.roles, self.texts, again)])
        rows, _ = apply(found["audit"], self.roles, self.texts)
        return {"conv_id": self.conv_id, **found, "repaired_sha256": hashlib.sha256(_lines(rows)).hexdigest(), "rows": rows, "done": True}

    def unfinished(self, part: int, block: int) -> dict:
        rows = [{"role": r, "text": t} for r, t in zip(self.roles, self.texts)]
        digests = [_digest(r, t) for r, t in zip(self.roles, self.texts)]
        return {"conv_id": self.conv_id, "rows": rows, "done": False, "part": part, "block": block, "turns": self.turns, "digests": digests}


def _repair_sorted(batches):
    """Sorted rows to repaired conversations; those that the task may not have whole, to blocks."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    out, held, current, number, split, size = [], 0, None, 0, True, 0

    def close(last: bool):
        nonlocal number, held
        if split or last:  # the first of the range, the last of it, or cut already
            out.append(current.unfinished(part, number))
            number += 1
        else:
            out.append(current.finished())
        held += current.size + 64 * len(current.turns)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "copies")]
        for conv_id, turn, role, text, copies in zip(*columns):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    close(False)
                    split = False
                current = _Block(conv_id)
            elif current.full():
                split = True
                close(False)
                current = _Block(conv_id)
            current.add(turn, role, text, copies)
            if len(out) >= 1024 or held >= BLOCK_BYTES:
                yield _flush(out, _DONE)
                held = 0
    if current is not None:
        close(True)
    if out:
        yield _flush(out, _DONE)


def _summaries(batches):
    for batch in batches:
        out = []
        for b in batch.to_pylist():
            firsts = set(b["firsts"] or ())
            roles, texts = ([r[k] for r in b["rows"]] for k in ("role", "text"))
            again = [i not in firsts for i in range(len(roles))]
            out.append({"conv_id": b["conv_id"], "part": b["part"], "block": b["block"], **summary(b["turns"], roles, texts, again)})
        yield _flush(out, _SUMMARY)


def _edits(blocks: pa.Table) -> pa.Table:
    """A conversation's summaries (a byte a row) to the letters of each block; the first has the verdict."""
    blocks = sorted(blocks.to_pylist(), key=lambda b: (b["part"], b["block"]))
    found, out, at, state = verdict(blocks), [], 0, _START
    audit = found["audit"]
    for i, b in enumerate(blocks):
        start, left, entry = at, len(b["codes"]), state
        kinds = iter(b["codes"])
        while at < len(audit) and (left or i == len(blocks) - 1):
            letter = audit[at]
            code = None if letter == "I" else next(kinds)
            left -= letter != "I"
            state = _TURN[state] if letter in "IR" else _NEXT[code & 7][state] if letter == "K" else state
            at += 1
        row = {"conv_id": b["conv_id"], "part": b["part"], "block": b["block"], "letters": audit[start:at], "state": entry}
        out.append(row | (found if i == 0 else {}))
    return pa.Table.from_pylist(out, schema=_type(_EDITS))


def _apply_blocks(batches):
    for batch in batches:
        out = []
        for b in batch.to_pylist():
            rows, _ = apply(b["letters"], [r["role"] for r in b["rows"]], [r["text"] for r in b["rows"]], b["state"])
            out.append({**{k: b[k] for k in ("conv_id", "part", "block", "audit", *_LONGS)}, "rows": rows})
        yield _flush(out, _REPAIRED)


def _digests(batches):
    """Repaired blocks in order to one row for each conversation; texts are digested as they pass."""
    out, found, hashed, said = [], None, None, False
    for batch in batches:
        for b in batch.to_pylist():
            if b["cost"] is not None:  # the first block of a conversation has its verdict
                if found is not None:
                    out.append(found | {"repaired_sha256": hashed.hexdigest()})
                found, hashed, said = {k: b[k] for k in ("conv_id", "audit", *_LONGS)}, hashlib.sha256(), False
            if b["rows"]:
                hashed.update(b"\n" * said + _lines(b["rows"]))
                said = True
        if len(out) >= 1024:
            yield _flush(out, RESULT)
    if found is not None:
        out.append(found | {"repaired_sha256": hashed.hexdigest()})
    if out:
        yield _flush(out, RESULT)


def plain(rows: DataFrame) -> DataFrame:
    """Rows as they are: conv_id, turn, role, text without nulls, and one copy of each."""
    space = F.lit(" ")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the damage that their ids draw: gone (no copy), emptied, without ends of sentences, twice, or the user's."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat_ws(":", *spaced)) % 20
    known = plain(rows).withColumn("draw", draw)
    text = F.when(F.col("draw").isin(0, 1), "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 0, "").when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1)
    return known.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


class Repair:
    """The repair of conversations given as ``plain`` or ``damaged`` rows."""

    def __init__(self, rows: DataFrame):
        small_batches(rows.sparkSession)
        dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
        self.known = written(dealt.mapInArrow(_repair_sorted, _DONE), "conversations")
        blocks = self.known.filter("not done")
        each = blocks.select("conv_id", "part", "block", F.posexplode("digests").alias("i", "digest"))
        firsts = each.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "block", "i")).alias("at")).select("at.*")
        firsts = firsts.groupBy("part", "block").agg(F.collect_list("i").alias("firsts"))
        short = blocks.join(firsts, ["part", "block"], "left").select("conv_id", "part", "block", "turns", "rows", "firsts").mapInArrow(_summaries, _SUMMARY)
        edits = short.groupBy("conv_id").applyInArrow(_edits, _EDITS).drop("conv_id")
        self.blocks = written(blocks.select("conv_id", "part", "block", "rows").join(edits, ["part", "block"]).mapInArrow(_apply_blocks, _REPAIRED), "blocks")

    def results(self) -> DataFrame:
        """One row for each conversation: counts of faults, cost, the edits' letters, the digest of what is left."""
        late = self.blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(_digests, RESULT)
        return self.known.filter("done").select(*late.columns).unionByName(late)

    def rows(self) -> DataFrame:
        """The repaired rows: conv_id, position (orders the rows of a conversation, with gaps), role, text."""
        done = self.known.filter("done").select("conv_id", F.lit(0).cast("long").alias("at"), "rows")
        late = self.blocks.select("conv_id", (F.shiftleft(F.col("part").cast("long"), 40) + F.shiftleft(F.col("block").cast("long"), 16)).alias("at"), "rows")
        each = done.unionByName(late).select("conv_id", "at", F.posexplode("rows").alias("i", "row"))
        return each.select("conv_id", (F.col("at") + F.col("i")).alias("position"), "row.role", "row.text")
