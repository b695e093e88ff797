"""Conversation structure repair: a generalised LR parser over roles whose actions have costs.

The grammar of a whole conversation is C -> nothing | L, L -> s P | P, P -> P u a | u a, over the initials of roles.
Beside the parser's shifts and reduces, a row may be deleted or given another role, and a turn without text may be
inserted. All ways to read a conversation are followed at once on a graph-structured stack: stacks share what lies
below their tops, and tops in the same state are merged, of which the one with the least (cost, audit) stays. That
is enough, because what may follow depends on the top's state only. So a row costs the same wherever it stands.

Nothing of a conversation is kept but a letter for each edit and a digest for each different row: every top carries
the running hash of its repaired rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from adtally.llm.rows import in_slices

RELABEL_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Roles that a row may be given, or that may be inserted, by their initial.
GIVEN = {"u": b"user", "a": b"assistant"}
#: The parser's shifts: state and initial to the next state.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 6, (5, "u"): 6, (6, "a"): 7}
#: Its reduces, all to P: how many states go from the stack.
REDUCE = {3: 2, 7: 3}
#: Where P leads from the state that is then on top.
GOTO = {0: 5, 1: 4}
ACCEPTING = (0, 4, 5)
LEGAL = {"su", "ua", "au"}
#: Rows after which the letters of each top are packed.
PACK = 1024


class Top:
    """The top of a stack: its state, what lies below, the least cost that leads here, and the edits of that cost.

    ``rank`` and ``tail`` order the audits of all tops of a step: those of one rank are the same but for their tails.
    """

    __slots__ = ("below", "cost", "digest", "edits", "pending", "rank", "started", "state", "tail")

    def __init__(self, state, below, cost, rank, tail, edits, digest, pending, started):
        self.state, self.below, self.cost, self.rank, self.tail = state, below, cost, rank, tail
        self.edits, self.digest, self.pending, self.started = edits, digest, pending, started

    def order(self) -> tuple[int, int, str]:
        return self.cost, self.rank, self.tail

    def audit(self) -> str:
        parts, at = [], self.edits
        while at:
            at, letters = at
            parts.append(letters)
        return "".join(reversed(parts))


def _push(top: Top, initial: str) -> tuple[int, Any] | None:
    """State and what lies below after shifting ``initial`` on ``top`` and reducing; None where the grammar has no shift."""
    state = SHIFT.get((top.state, initial))
    if state is None:
        return None
    below = (top.state, top.below)
    while state in REDUCE:
        for _ in range(REDUCE[state] - 1):
            below = below[1]
        state, below = GOTO[below[0]], below
    return state, below


def _edited(top: Top, place: tuple[int, Any], cost: int, letter: str, row: bytes | None) -> Top:
    pending, started = top.pending, top.started
    if row is not None:
        pending, started = (*pending, b"\n" + row if started else row), True
    return Top(*place, top.cost + cost, top.rank, top.tail + letter, (top.edits, letter), top.digest, pending, started)


def _merge(tops: dict[int, Top], new: Top) -> bool:
    """Keep the lesser of two tops in one state; whether ``new`` is it."""
    old = tops.get(new.state)
    if old is not None and old.order() <= new.order():
        return False
    tops[new.state] = new
    return True


def _with_inserts(tops: dict[int, Top]) -> dict[int, Top]:
    waiting = list(tops.values())
    while waiting:
        top = waiting.pop()
        if tops.get(top.state) is not top:
            continue
        for initial, role in GIVEN.items():
            place = _push(top, initial)
            if place is not None:
                new = _edited(top, place, INSERT_COST, "I", role + b":")
                if _merge(tops, new):
                    waiting.append(new)
    return tops


def _settle(tops: dict[int, Top]) -> dict[int, Top]:
    """Bring the hashes of what stays up to date, and rank the audits anew so that tails stay short."""
    base, rank = None, -1
    for top in sorted(tops.values(), key=lambda t: (t.rank, t.tail)):
        was = top.rank, top.tail
        if base is None or was[0] != base[0] or not was[1].startswith(base[1]):
            base, rank = was, rank + 1
        top.rank, top.tail = rank, was[1][len(base[1]):]
        if top.pending:
            top.digest = top.digest.copy()
            for part in top.pending:
                top.digest.update(part)
            top.pending = ()
    return tops


def _pack(tops: dict[int, Top]) -> None:
    """Letters since the last packing become one string for each top."""
    for top in tops.values():
        letters, at = [], top.edits
        while at and len(at[1]) == 1:
            at, letter = at
            letters.append(letter)
        top.edits = (at, "".join(reversed(letters))) if letters else at


class Repair:
    """The cheapest repair of one conversation, fed row by row."""

    def __init__(self) -> None:
        self.tops = _settle(_with_inserts({0: Top(0, None, 0, 0, "", None, hashlib.sha256(), (), False)}))
        self.rows = 0

    def feed(self, role: bytes, text: bytes, must_go: bool, truncated: bool) -> None:
        initial = role[:1].decode("latin-1")
        more = TRUNCATED_COST if truncated else 0
        kept = role + b":" + text
        step: dict[int, Top] = {}
        for top in self.tops.values():
            _merge(step, _edited(top, (top.state, top.below), DELETE_COST, "D", None))
            if must_go:
                continue
            place = _push(top, initial)
            if place is not None:
                _merge(step, _edited(top, place, more, "K", kept))
            for other, name in GIVEN.items():
                place = _push(top, other)
                if place is not None:
                    _merge(step, _edited(top, place, RELABEL_COST + more, "R", name + b":" + text))
        self.tops = _settle(_with_inserts(step))
        self.rows += 1
        if self.rows % PACK == 0:
            _pack(self.tops)

    def done(self) -> tuple[int, str, str]:
        """Cost, audit, hash of the repaired rows. There's always one: everything may be deleted."""
        best = min((t for s, t in self.tops.items() if s in ACCEPTING), key=Top.order)
        return best.cost, best.audit(), best.digest.hexdigest()


class Diagnosis:
    """Faults of one conversation's rows, in order, and their repair."""

    def __init__(self) -> None:
        self.repair, self.seen = Repair(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def feed(self, turn: int | None, role: bytes, text: bytes) -> None:
        said = text.strip()  # just the blanks 0x20 and 0x09-0x0D, as these are bytes
        row = hashlib.blake2b(b"%d:%b%b" % (len(role), role, text), digest_size=16).digest()
        blank, duplicate = not said, row in self.seen
        truncated = not blank and not duplicate and said[-1:] not in (b".", b"!", b"?")
        self.seen.add(row)
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated
        initial = role[:1].decode("latin-1")
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        self.repair.feed(role, text, blank or duplicate, truncated)

    def done(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.done()


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NONE = object()


def _diagnose(names: list[str], types: list[pa.DataType]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = _NONE, None, []

        def out() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for part in in_slices(batch, 3):
                for conv_id, turn, role, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if conv_id != now:
                        if state is not None:
                            done.append((now, *state.done()))
                        now, state = conv_id, Diagnosis()
                    if role is not None:  # else the row is lost; its conversation isn't
                        state.feed(turn, role, text)
            if len(done) >= 1000:
                yield out()
                done = []
        if state is not None:
            done.append((now, *state.done()))
        if done:
            yield out()

    return run


def repair(rows: DataFrame) -> DataFrame:
    """For every conv_id of ``rows``: counts of its faults, the cheapest repair's cost and audit, and its hash.

    ``rows`` has conv_id, turn, role, text; other columns are ignored. A row is blank if its text has no character but
    blanks, else a duplicate if its role and text were seen earlier, else truncated if it ends without ``.``, ``!`` or
    ``?``. Blank rows and duplicates have to go. Rows are taken by turn, nulls first, and where turns are equal by role
    and text. A null role marks a row that is lost: it only says that its conversation is there. A null text is empty;
    a null conv_id is a conversation like others; an empty table gives no rows.
    Audits have a letter for each edit: K(eep), R(elabel), D(elete), I(nsert).

    A conversation's hash needs its rows in order, so one task streams it; the rest of a partition doesn't wait in
    memory for it.
    """
    ordered = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("binary").alias("role"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    schema = T.StructType([ordered.schema["conv_id"], *T.StructType.fromDDL(FOUND).fields])
    arrow = to_arrow_schema(schema)
    return ordered.mapInArrow(_diagnose(arrow.names, arrow.types), schema)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops the row (its role is then null, so that its conversation is still known), 1 empties the text, 2 takes the
    stops from it, 3 repeats the row, 4 makes the role ``user``.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.pmod(F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")), F.lit(20)).cast("int")
    rows = conversations.select("conv_id", "turn", named[2].alias("role"), named[3].alias("text"), fault.alias("fault"))
    hit = F.col("fault")
    return rows.withColumn("time", F.explode(F.sequence(F.lit(1), F.when(hit == 3, 2).otherwise(1)))).select(
        "conv_id", "turn",
        F.when(hit == 4, "user").when(hit != 0, F.col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _sql() -> str:
    """The same repair as a walk over each conversation's rows with the best edits by state.

    none, s, u and a name the states by the initial read last; each holds cost, audit and text.
    """
    def after(state: str, cost: str, letter: str, row: str) -> str:
        text = row if state == "none" else f"{state}.t || chr(10) || {row}"
        return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}', t := {text})"

    def least(*choices: str) -> str:
        return f"least({', '.join(choices)})"

    def gone(state: str) -> str:
        return f"struct_pack(c := {state}.c + {DELETE_COST}, a := {state}.a || 'D', t := {state}.t)"

    def onto(state: str, initial: str, before: tuple[str, ...], given: str | None) -> str:
        kept = [after(b, f"late + if(initial = '{initial}', 0, big)", "K", "role || ':' || text") for b in before]
        other = [after(b, f"late + {RELABEL_COST}", "R", f"'{given}:' || text") for b in before] if given else []
        return least(gone(state), *(f"if(must_go, {gone(state)}, {x})" for x in kept + other))

    def insert(state: str, role: str) -> str:
        return after(state, str(INSERT_COST), "I", f"'{role}:'")

    return rf"""
WITH RECURSIVE bits AS (
    SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) AS r(i)
    UNION ALL
    SELECT i, xor(c >> 1, if(c & 1 = 1, 3988292384, 0)::UBIGINT), k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS part FROM bits WHERE k = 8), given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations
), hit AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(
        list_transform(range(1, length(name) + 1), lambda k: ord(substring(name, k, 1))::UBIGINT),
        lambda h, b: xor(h >> 8, part[(xor(h, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT
    ) % 20 AS fault
    FROM given, crc
), damaged AS (
    SELECT conv_id, turn, if(fault = 4, 'user', role) AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hit, range(2) AS twice(n) WHERE fault <> 0 AND (n = 0 OR fault = 3)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           NOT regexp_matches(text, '[^ 	-
]') AS blank, substring(role, 1, 1) AS initial
    FROM damaged
), seen AS (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
    FROM numbered
), judged AS (
    SELECT *, blank OR again AS must_go,
           NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut
    FROM seen
), walk AS (
    SELECT conv_id, 0::BIGINT AS done, struct_pack(c := 0::BIGINT, a := '', t := '') AS none,
           struct_pack(c := 1000000000000::BIGINT, a := '', t := '') AS s,
           struct_pack(c := {INSERT_COST}::BIGINT, a := 'I', t := 'user:') AS u,
           struct_pack(c := {2 * INSERT_COST}::BIGINT, a := 'II', t := 'user:' || chr(10) || 'assistant:') AS a
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, done + 1, none, s, u, {least("a", insert("u", "assistant"))} FROM (
        SELECT conv_id, done, none, s, {least("u", insert("none", "user"), insert("s", "user"), insert("a", "user"))} AS u, a
        FROM (
            SELECT w.conv_id, done, {gone("none")} AS none, {onto("s", "s", ("none",), None)} AS s,
                   {onto("u", "u", ("none", "s", "a"), "user")} AS u, {onto("a", "a", ("u",), "assistant")} AS a
            FROM walk AS w
            JOIN (SELECT *, if(cut, {TRUNCATED_COST}, 0) AS late, 1000000000000 AS big FROM judged) AS j
            ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.done + 1
        )
    )
), ends AS (SELECT conv_id, arg_max(least(none, a), done) AS best FROM walk GROUP BY conv_id), faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
           count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(best.t) AS repaired_sha256
FROM ends AS e LEFT JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP13_SQL = _sql()
