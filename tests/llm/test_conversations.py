"""Conversation repair against an enumeration of edits, and its blocks against conversations that are done at once."""

import hashlib
import random
import re
import zlib

import pytest

from tsforge.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
_BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        own += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def cheapest(rows):
    """All edits, one after the other; rows are (role, text, must go, truncated)."""
    best = [(10**9, "", [])]

    def go(i, cost, letters, made):
        initials = "".join(r[:1] for r, _ in made)
        if cost > best[0][0] or not re.fullmatch(r"(s?(ua)*u?)?", initials):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            if (cost, letters) < best[0][:2]:
                best[0] = (cost, letters, made)
        for role in ("user", "assistant"):
            go(i, cost + 2, letters + "I", [*made, (role, "")])
        if i == len(rows):
            return
        role, text, must, late = rows[i]
        go(i + 1, cost + 3, letters + "D", made)
        if not must:
            go(i + 1, cost + late, letters + "K", [*made, (role, text)])
            for new in ("user", "assistant"):
                go(i + 1, cost + late + 2, letters + "R", [*made, (new, text)])

    best[0] = (3 * len(rows) + 1, "~", [])
    go(0, 0, "", [])
    return best[0]


def brute(rows):
    out = []
    for conv, own in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in own:
            said = text.rstrip(_BLANK)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        cost, audit, made = cheapest([(r, t, f in ("blank", "duplicate"), f == "truncated") for (_, r, t), f in zip(own, faults)])
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(repair):
    return sorted((tuple(r) for r in repair.results().collect()), key=str)


def repaired(repair):
    out = {}
    for r in sorted(repair.rows().collect(), key=lambda r: r.position):
        out.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    return out


def case(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(140), None, -5]:
        roles = rng.choice(["suaua", "uaua", "aua", "uu", "sua", "ssua", "ua", "u", "auau"])
        for turn, letter in enumerate(roles):
            role = {"s": "system", "u": "user", "a": "assistant"}[letter]
            if rng.random() < 0.08:
                role = rng.choice(["tool", "", None, "user", "assistant", "üser"])
            text = rng.choice(["One.", "Two? ", "cut off", "", None, " \n", "Same!", "Same!", "ok.\t\x0b", "é…"])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None, 0]), role, text))
    return rows + [rows[3], rows[3], rows[40]]


@pytest.mark.parametrize(("limit", "seed"), [(4096, 1), (2, 1), (1, 2)])
def test_repairs_equal_an_enumeration(spark, monkeypatch, limit, seed):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", limit)
    rows = case(seed)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as part", "1 as block", "2 as draw", "3 as copies").repartition(3)
    repair = conversations.Repair(conversations.damaged(table))
    want = brute(rows)
    assert found(repair) == want
    assert {w[1] for w in want} != {0} and len({w[6] for w in want}) > 5
    texts = repaired(repair)
    assert all(hashlib.sha256("\n".join(texts.get(w[0], [])).encode()).hexdigest() == w[8] for w in want)


def test_one_long_conversation_is_cut_and_sewn(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, turn, rng.choice(["user", "assistant", "system"]), rng.choice([f"Say {turn}.", f"cut {turn}", "again."])) for turn in range(700)]
    rows += [(i, 0, "user", "Hi.") for i in range(2, 60)]
    table = spark.createDataFrame(rows, SCHEMA)
    whole = found(conversations.Repair(conversations.damaged(table)))
    monkeypatch.setattr(conversations, "BLOCK_ROWS", 16)
    repair = conversations.Repair(conversations.damaged(table.repartition(5)))
    assert found(repair) == whole
    audit = next(w[7] for w in whole if w[0] == 1)
    assert len(repaired(repair)[1]) == sum(c in "KRI" for c in audit)


def test_plans_of_many_rows_equal_short_ones_put_together():
    rng = random.Random(9)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 9, 17, 18, 1, 2]) for _ in range(rng.randrange(6)))
        rows = [("suatx"[c & 7] if c & 7 != 3 else "", "x", bool(c & 8), bool(c & 16)) for c in codes]
        assert conversations._plan(codes) == cheapest(rows)[:2]


def test_rows_without_damage_and_no_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "No.")]
    plain = {r.conv_id: (r.cost, r.audit) for r in conversations.Repair(conversations.plain(spark.createDataFrame(rows, SCHEMA))).results().collect()}
    assert plain == {1: (0, "KK"), 2: (2, "IK")}
    assert found(conversations.Repair(conversations.damaged(spark.createDataFrame([], SCHEMA)))) == []


def test_a_conversation_whose_rows_all_go(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (-1, None, "user", "Hi.")]
    assert found(conversations.Repair(conversations.damaged(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)
