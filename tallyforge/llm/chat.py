"""Chat formatting: a finite-state machine over roles, a declarative template, text segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stored
from .common import byte_slices

#: A conversation is written in parts of about this many characters; nearly all are one part.
PART = 1 << 20
REFUSED = "refused"
CONTROL = "<|"

_control = re.compile(r"<(\\*)\|")
_escaped = re.compile(r"<\\(\\*)\|")
_role_in = str.maketrans({"\\": "\\\\", "\n": "\\n", "|": "\\p"})
_role_out = re.compile(r"\\(.)")


def escape(text: str) -> str:
    """No control string begins in the result: a < gets one more backslash before its |. Undone by `unescape`."""
    return _control.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _escaped.sub(r"<\1|", text) if "<\\" in text else text


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles are learned from, and which role may follow in which state.

    A turn is head, role, newline, text, tail. Head and tail begin with the control string `<|`, which texts cannot
    hold once they are escaped, so the output reads back without doubt.
    """

    head: str = "<|im_start|>"
    tail: str = "<|im_end|>\n"
    learned: frozenset[str] = frozenset({"assistant"})
    begin: str = "begin"
    moves: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "begin": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    ends: frozenset[str] = frozenset({"answered"})

    def __post_init__(self) -> None:
        for mark in (self.head, self.tail):
            if not mark.startswith(CONTROL) or CONTROL in mark[len(CONTROL):] or "\\" in mark:
                raise ValueError(f"a mark begins with {CONTROL}, holds it once and holds no backslash: {mark!r}")
        if self.head == self.tail or self.head.startswith(self.tail) or self.tail.startswith(self.head):
            raise ValueError("head and tail must not begin alike")
        unknown = {s for step in self.moves.values() for s in step.values()} - set(self.moves)
        if self.begin not in self.moves or unknown or REFUSED in self.moves:
            raise ValueError(f"states without moves: {unknown or self.begin}")

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) of the segments of a turn."""
        return [(f"{self.head}{role.translate(_role_in)}\n", False), (escape(text), role in self.learned), (self.tail, False)]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of the turns of a formatted string."""
        at = 0
        while at < len(formatted):
            if not formatted.startswith(self.head, at):
                raise ValueError(f"no turn begins at {at}")
            line = formatted.index("\n", at)
            stop = formatted.index(self.tail, line + 1)
            role = _role_out.sub(lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), formatted[at + len(self.head):line])
            yield role, unescape(formatted[line + 1:stop])
            at = stop + len(self.tail)


class Machine:
    """Runs the template's machine from every state at once, so that parts of a conversation can be run apart."""

    def __init__(self, template: Template):
        self.moves, self.n = template.moves, 0
        self.now = {s: s for s in template.moves}
        self.bad: dict[str, int] = {}

    def step(self, role: str) -> None:
        for state, now in self.now.items():
            if now != REFUSED:
                after = self.moves[now].get(role)
                if after is None:
                    self.bad[state] = self.n
                self.now[state] = after or REFUSED
        self.n += 1

    def table(self) -> list[dict]:
        return [{"state": s, "after": e, "bad": self.bad.get(s)} for s, e in self.now.items()]


class _Part:
    def __init__(self, template: Template):
        self.texts: list[str] = []
        self.loss: list[dict] = []
        self.size, self.machine = 0, Machine(template)

    def add(self, template: Template, role: str, text: str) -> None:
        for piece, loss in template.segments(role, text):
            if loss:
                self.loss.append({"start": self.size, "end": self.size + len(piece)})
            self.texts.append(piece)
            self.size += len(piece)
        self.machine.step(role)


_MOVES = "array<struct<state:string, after:string, bad:bigint>>"
_LOSS = "array<struct<start:bigint, end:bigint>>"


def format_chats(rows: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", most: int = PART) -> DataFrame:
    """Formatted conversations: conv_id, part, whole, n_turns, formatted, loss, moves.

    Rows are ordered by conversation and turn over ranges, so a conversation that holds a third of all rows is spread
    over many tasks. A part holds consecutive turns, about `most` characters or one longer turn; the parts of a
    conversation in the order of `part` are its formatted string. `whole` says that a part is surely a whole
    conversation; of the others there are a few per range. `loss` has the spans (code points) of the segments to learn
    from, and `moves` what the role machine does over the part from each state: state after it, and the first turn of
    the part that it refuses (else null). Refused conversations are formatted all the same.

    Null texts are empty, null roles are the empty role (which the default machine refuses). Null turns come first,
    rows of equal turn are ordered by role, then by hash and text; repeated rows are turns of their own. A null
    conversation id is one conversation. Very long texts are written whole. Other columns are dropped, whatever their
    names. An empty table gives an empty one.
    """
    order = [F.asc(c) for c in ("conv", "turn", "role", "hash")]
    told = rows.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    placed = told.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("conv", "role", "text", F.spark_partition_id().alias("range"))
    schema = StructType([placed.schema["conv"], *StructType.fromDDL(f"part bigint, whole boolean, n_turns bigint, formatted string, loss {_LOSS}, moves {_MOVES}").fields])
    names = [conv_id, *schema.names[1:]]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, part, n_parts, made, first = nothing, None, 0, 0, True
        target = None
        out: list[tuple] = []
        size = 0

        def close(last: bool, ended: bool) -> None:
            nonlocal made, size, n_parts
            n_parts += 1
            whole = ended and n_parts == 1 and not first and not last
            out.append((conv, (place << 33) + made, whole, part.machine.n, "".join(part.texts), part.loss, part.machine.table()))
            made += 1
            size += part.size

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            columns = list(zip(*out))
            out, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, target.types)], schema=target)

        place = 0
        for batch in batches:
            if target is None:
                spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                steps = pa.list_(pa.struct([("state", pa.string()), ("after", pa.string()), ("bad", pa.int64())]))
                target = pa.schema([("conv", batch.schema.field(0).type), ("part", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()),
                                    ("formatted", pa.string()), ("loss", spans), ("moves", steps)])
            for piece in byte_slices(batch, 2):
                for c, r, t, place in zip(*(col.to_pylist() for col in piece.columns)):
                    if c != conv or conv is nothing:
                        if conv is not nothing:
                            close(last=False, ended=True)
                            first = False
                        conv, part, n_parts = c, _Part(template), 0
                    elif part.size >= most:
                        close(last=False, ended=False)
                        part = _Part(template)
                    part.add(template, r, t)
                    if size >= 4 * most or len(out) >= 10_000:
                        yield flush()
        if conv is not nothing:
            close(last=True, ended=True)
            yield flush()

    return placed.mapInArrow(write, schema).toDF(*names)


def turns_of(parts: DataFrame, template: Template = Template(), conv_id: str = "conv_id") -> DataFrame:
    """conv_id, part, n (in its part), role, text and learned of every turn, read from the formatted strings."""
    schema = StructType([parts.schema[conv_id], *StructType.fromDDL("part bigint, n bigint, role string, text string, learned boolean").fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in byte_slices(batch, 2):
                rows = [(c, p, n, role, text, role in template.learned) for c, p, f in zip(*(col.to_pylist() for col in piece.columns))
                        for n, (role, text) in enumerate(template.turns(f))]
                types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=schema.names)

    return parts.select(conv_id, "part", "formatted").mapInArrow(read, schema)


_DIGEST = ("n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, state string, complete boolean, bad_turn bigint")


def read_back(parts: DataFrame, template: Template = Template(), conv_id: str = "conv_id") -> DataFrame:
    """What the parts hold, one row per conversation: turns and learned text as digests, and the machine's verdict.

    `turns_sha256` is of role, newline, text, newline of every turn, `loss_sha256` of all text under the loss spans;
    both unescaped. `state` is the machine's last one (`refused` from the turn `bad_turn` on, counted from 0),
    `complete` says that a conversation may end there. A digest of a whole conversation has to be taken in order, so
    its parts meet in one task; they are streamed, one part in memory at a time.
    """
    schema = StructType([parts.schema[conv_id], *StructType.fromDDL(_DIGEST).fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, kind, out = nothing, None, []

        def done() -> tuple:
            return (conv, n, told.hexdigest(), chars, learned.hexdigest(), size, state, state in template.ends, bad)

        def flush() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for piece in byte_slices(batch, 1):
                for c, formatted, loss, moves in zip(*(col.to_pylist() for col in piece.columns)):
                    if c != conv or conv is nothing:
                        if conv is not nothing:
                            out.append(done())
                        conv, n, chars, size, state, bad = c, 0, 0, 0, template.begin, None
                        told, learned = hashlib.sha256(), hashlib.sha256()
                    step = next((m for m in moves if m["state"] == state), None)
                    if step is not None:
                        bad = n + step["bad"] if step["bad"] is not None else bad
                        state = step["after"]
                    for role, text in template.turns(formatted):
                        told.update(f"{role}\n{text}\n".encode())
                        n += 1
                    for span in loss:
                        text = unescape(formatted[span["start"]:span["end"]])
                        learned.update(text.encode())
                        chars += len(text)
                    size += len(formatted)
            if len(out) >= 10_000:
                yield flush()
                out = []
        if conv is not nothing:
            out.append(done())
            yield flush()

    slim = [conv_id, "formatted", "loss", "moves"]
    whole = parts.filter("whole").select(*slim).mapInArrow(read, schema)
    pieces = parts.filter(~F.col("whole")).repartition(conv_id).sortWithinPartitions(conv_id, "part")
    return whole.unionByName(pieces.select(*slim).mapInArrow(read, schema))


def chat_digests(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """`read_back` of the formatted conversations, which are written down first."""
    return read_back(stored(format_chats(rows, template), "chats"), template)
