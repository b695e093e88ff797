"""Chat formatting: a finite-state machine over roles turns conversations into text segments with loss flags.

The template says, for each role, what opens and closes its turns and whether its text is trained on. Control strings
inside texts are escaped by a backslash, so the output can be read back without loss. Turns of a conversation are
sorted by Spark and then streamed through the machine, so a conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Turn(NamedTuple):
    name: str
    loss: bool


OPEN, AFTER_NAME, CLOSE = "### ", ": ", "</turn>\n"
TEMPLATE = {"system": Turn("System", False), "user": Turn("User", False), "assistant": Turn("Assistant", True)}
#: Any other role is written out behind this sign.
OTHER = "="
#: Which state a role leads to from each state; what is missing breaks the order of turns for good.
MACHINE = {
    "start": {"system": "system", "user": "user"},
    "system": {"user": "user"},
    "user": {"assistant": "assistant"},
    "assistant": {"user": "user"},
}
CONTROLS = re.compile(r"\\|###|</turn>")
IN_NAMES = re.compile(r"\\|###|</turn>|: ")
ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
HEADER = re.compile(r"### ((?:\\(?:\\|###|</turn>|: )|(?!: ).)*): ", re.DOTALL)
CLOSING = re.compile(r"\\(?:\\|###|</turn>|: )|(</turn>\n)")


def escape(text: str, controls: re.Pattern = CONTROLS) -> str:
    return controls.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def header(role: str) -> str:
    name = TEMPLATE[role].name if role in TEMPLATE else OTHER + escape(role, IN_NAMES)
    return OPEN + name + AFTER_NAME


def closes(segment: str) -> bool:
    return any(m[1] for m in CLOSING.finditer(segment))


def read_turn(text: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    head = HEADER.match(text)
    if not head or not text.endswith(CLOSE):
        raise ValueError("this is no formatted turn")
    name = head[1]
    by_name = {turn.name: role for role, turn in TEMPLATE.items()}
    role = unescape(name[len(OTHER):]) if name.startswith(OTHER) else by_name[name]
    return role, unescape(text[head.end():-len(CLOSE)])


SEGMENTS = "segment_no long, segment string, loss boolean, in_order boolean"


def format_segments(conversations: DataFrame) -> DataFrame:
    """conv_id, segment_no, segment, loss, in_order: three segments per turn, in order within each partition.

    Turns come by turn number, nulls first, ties by role and text. A null role or text is empty; a role that the
    template doesn't know keeps its name. ``in_order`` turns false at the first turn that the machine has no arc
    for; such conversations are formatted all the same. A null conv_id is a conversation of its own. Rows that repeat
    are turns that repeat; an empty table gives no segments.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, number = (), "start", 0
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                out = []
                for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                    if current != (conv,):
                        current, state, number = (conv,), "start", 0
                    state = MACHINE.get(state, {}).get(role, "broken")
                    loss = role in TEMPLATE and TEMPLATE[role].loss
                    for segment, trained in ((header(role), False), (escape(text), loss), (CLOSE, False)):
                        out.append((conv, number, segment, trained, state != "broken"))
                        number += 1
                kinds = (batch.schema.field(0).type, pa.int64(), pa.string(), pa.bool_(), pa.bool_())
                columns = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["conv_id", "segment_no", "segment", "loss", "in_order"],
                )

    id_type = turns.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {id_type}, {SEGMENTS}")


class _Reader:
    """What is read back of one conversation."""

    def __init__(self) -> None:
        self.turns, self.loss_chars, self.chars, self.in_order = 0, 0, 0, True
        self.text, self.loss = hashlib.sha256(), hashlib.sha256()
        self.open: list[str] = []

    def take(self, segment: str, loss: bool, in_order: bool) -> None:
        self.chars += len(segment)
        self.in_order &= in_order
        if loss:
            plain = unescape(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.open.append(segment)
        if closes(segment):
            role, text = read_turn("".join(self.open))
            self.text.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
            self.open = []


def read_back(segments: DataFrame) -> DataFrame:
    """What formatted conversations hold, from their segments in order: a row per conv_id.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, in_order.
    """
    id_type = segments.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader = (), None
        id_kind = None

        def table(rows: list) -> pa.RecordBatch:
            kinds = (id_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            columns = list(zip(*rows, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def row() -> tuple:
            r = reader
            return (
                current[0], r.turns, r.text.hexdigest(), r.loss_chars, r.loss.hexdigest(), r.chars, r.in_order
            )

        for batch in batches:
            id_kind, rows = batch.schema.field(0).type, []
            columns = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            for conv, segment, loss, in_order in zip(*columns, strict=True):
                if current != (conv,):
                    if reader:
                        rows.append(row())
                    current, reader = (conv,), _Reader()
                reader.take(segment, loss, in_order)
            yield table(rows)
        if reader:
            yield table([row()])

    return segments.mapInArrow(
        run,
        f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, in_order boolean",
    )


#: Fixed value: the text of both turns of the conversation that is added.
TRICKY = "\\### Assistant: </turn> ok"


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string"
    )
    return read_back(format_segments(conversations.unionByName(added)))


OP10_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), counted AS (
    SELECT *, length('### : </turn>') + 1 + length(regexp_replace(text, '\\|###|</turn>', 'x\0', 'g'))
              + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
                     ELSE 1 + length(regexp_replace(role, '\\|###|</turn>|: ', 'x\0', 'g')) END AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       regexp_full_match(
           string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                      ORDER BY turn NULLS FIRST, role, text), 's?(ua)*u?') AS in_order
FROM counted GROUP BY conv_id
"""
