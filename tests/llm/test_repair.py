"""Conversation repair against every way to edit a small conversation, and odd tables."""

import hashlib
import random
import re
import zlib

import pytest

from adtally.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Cost, audit and text of the best of all edits of (role, text, must go, truncated)."""
    found = []

    def extend(i, cost, audit, initials, out):
        for more in ("", "u", "a", "ua", "au"):
            added = [{"u": "user:", "a": "assistant:"}[x] for x in more]
            now = cost + 3 * len(more), audit + "I" * len(more), initials + more, out + added
            if i == len(rows):
                if LEGAL.fullmatch(now[2]):
                    found.append((now[0], now[1], "\n".join(now[3])))
                continue
            role, text, must_go, truncated = rows[i]
            extend(i + 1, now[0] + 4, now[1] + "D", now[2], now[3])
            if not must_go:
                late = 3 * truncated
                extend(i + 1, now[0] + late, now[1] + "K", now[2] + (role[:1] or "?"), now[3] + [f"{role}:{text}"])
                for name in ("user", "assistant"):
                    extend(i + 1, now[0] + 3 + late, now[1] + "R", now[2] + name[0], now[3] + [f"{name}:{text}"])

    extend(0, 0, "", "", [])
    best = min(found)[:2]
    (text,) = {f[2] for f in found if f[:2] == best}
    return *best, hashlib.sha256(text.encode()).hexdigest()


def test_repair_is_the_cheapest_of_all_edits():
    rng = random.Random(5)
    for _ in range(150):
        rows = [
            (rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", " "]), f"t{i}",
             rng.random() < 0.2, rng.random() < 0.3)
            for i in range(rng.randrange(5))
        ]
        state = repair.Repair()
        for role, text, must_go, truncated in rows:
            state.feed(role.encode(), text.encode(), must_go, truncated)
        assert state.done() == cheapest(rows), rows


def described(rows):
    """All columns of one conversation's rows (turn, role, text) after damage, in order."""
    seen, faults, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    edits = cheapest([(r, x, f in ("blank", "duplicate"), f == "truncated") for (_, r, x), f in zip(rows, faults, strict=True)])
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, *edits


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text, fault = role if role is not None else " ", text if text is not None else " ", zlib.crc32(name.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv_id, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def test_odd_conversations(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice([None, *range(30)]), rng.choice([None, 0, 1, 2, 5, 9]), rng.choice(["user", "assistant", "system", None, "", "aide"]),
         rng.choice(["Hi.", "so", None, "", " \t", "\u00a0", "ok?", "Ça va!"]))
        for _ in range(90)
    ]
    rows += [(77, 1, "user", "Again."), (77, 1, "user", "Again."), (78, 0, "user", "x" * 300_000 + ".")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", audit string")
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damage(df)).collect()}
    left = damaged(rows)
    assert set(got) == {r[0] for r in rows}
    for conv_id in got:
        own = sorted(
            (r[1:] for r in left if r[0] == conv_id),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()),
        )
        if len(own) < 7:
            assert got[conv_id] == described(own), (conv_id, own)


def test_no_conversations(spark):
    assert repair.repair(repair.damage(spark.createDataFrame([], SCHEMA))).collect() == []


def test_lost_conversation_has_zeros(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(3, turn, "user", "Gone.")], SCHEMA)
    assert tuple(repair.repair(repair.damage(df)).first()) == (3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("n", [5000])
def test_long_conversation_keeps_letters_packed(n):
    state = repair.Repair()
    for i in range(n):
        state.feed((b"user", b"assistant")[i % 2], b"t%d." % i, False, False)
    cost, audit, digest = state.done()
    text = "\n".join(f"{('user', 'assistant')[i % 2]}:t{i}." for i in range(n))
    assert (cost, audit, digest) == (0, "K" * n, hashlib.sha256(text.encode()).hexdigest())
