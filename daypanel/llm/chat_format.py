"""Chat formatting by schema fingerprints.

The nested field paths of a record (or of a table) are hashed; the hash selects
a declarative mapping that says where turns, roles and texts are. Every layout
ends as rows (id, turn, role, text), which a template turns into training text:

    <|im_start|>role\\ntext<|im_end|>\\n

Control strings inside a text are escaped by one backslash after each ``<`` that
stands before backslashes and a ``|``; taking one away restores the text, so the
output can be read back exactly. The loss mask covers the assistant's texts.

Conversations stream through a task in (id, turn) order: no conversation is ever
held whole, however many rows it has."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from daypanel.llm import common

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns. ``fields``: (path, role) in turn order,
    fields with the same role joined by an empty line. ``turns``: the path of a
    list with a role and a text in each item. ``rows``: one turn in each row."""
    name: str
    fields: tuple[tuple[str, str], ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    rows: bool = False

    def paths(self) -> frozenset[str]:
        if self.rows:
            return frozenset((self.role, self.text))
        if self.turns:
            return frozenset((f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"))
        return frozenset(path for path, _ in self.fields)


LAYOUTS = (
    Layout("prompt_completion", (("prompt", "user"), ("completion", "assistant"))),
    Layout("prompt_response", (("prompt", "user"), ("response", "assistant"))),
    Layout("system_prompt_response", (("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Layout("question_answer", (("question", "user"), ("answer", "assistant"))),
    Layout("instruction_output", (("instruction", "user"), ("output", "assistant"))),
    Layout("instruction_input_output", (("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Layout("messages", turns="messages", role="role", text="content"),
    Layout("conversations", turns="conversations", role="from", text="value"),
    Layout("data_messages", turns="data.messages", role="role", text="content"),
    Layout("turn_rows", role="role", text="text", rows=True),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    return xxhash.xxh64_hexdigest("\n".join(sorted(paths)).encode())


def by_fingerprint(layouts=LAYOUTS) -> dict[str, Layout]:
    return {fingerprint(layout.paths()): layout for layout in layouts}


def value_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a parsed record; null fields count as absent."""
    if value is None:
        return set()
    if isinstance(value, dict):
        return set().union(*(value_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(value_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def schema_paths(kind: T.DataType, prefix: str = "") -> set[str]:
    """The same paths of a table's schema."""
    if isinstance(kind, T.StructType):
        return set().union(*(schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
                             for f in kind.fields))
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    return {prefix}


def select_layout(paths, layouts=LAYOUTS, empty=frozenset()) -> Layout | None:
    """The mapping for a set of paths, by its hash. Paths that no mapping knows (ids,
    scores, sources) are left out first. ``empty`` are paths of nulls: they count as
    absent, or as present where nothing is found without them. A set with paths of
    several layouts, as extra columns make it, selects the most specific of the
    layouts it holds, the first of equals."""
    known, chosen = frozenset().union(*(layout.paths() for layout in layouts)), by_fingerprint(layouts)
    for there in (frozenset(paths) & known, (frozenset(paths) | frozenset(empty)) & known):
        if fingerprint(there) in chosen:
            return chosen[fingerprint(there)]
    for there in (frozenset(paths), frozenset(paths) | frozenset(empty)):
        held = [layout for layout in layouts if layout.paths() <= there]
        if held:
            return max(held, key=lambda layout: len(layout.paths()))
    return None


def null_paths(value, prefix: str = "", layouts=LAYOUTS) -> set[str]:
    """The paths of nulls in a parsed record, and of the roles and texts that the
    items of an empty list of turns would have."""
    if isinstance(value, dict):
        return set().union(*(null_paths(v, f"{prefix}.{k}" if prefix else k, layouts) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(null_paths(v, f"{prefix}[]", layouts) for v in value))
    if isinstance(value, list):
        return set().union(*(layout.paths() for layout in layouts if layout.turns == prefix))
    return {prefix} if value is None else set()


def _at(value, path: str):
    for part in path.split("."):
        value = value.get(part) if isinstance(value, dict) else None
    return value


def _as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record, layout: Layout) -> list[tuple[str, str]]:
    if layout.turns:
        items = [item for item in _at(record, layout.turns) or () if isinstance(item, dict)]
        found = [(_as_text(item.get(layout.role)), _as_text(item.get(layout.text))) for item in items]
        return [(ROLES.get(role, role), text) for role, text in found]
    if layout.rows:
        role = _as_text(record.get(layout.role))
        return [(ROLES.get(role, role), _as_text(record.get(layout.text)))]
    turns: list[tuple[str, str]] = []
    for path, role in layout.fields:
        text = _as_text(_at(record, path))
        if turns and turns[-1][0] == role:
            turns[-1] = (role, f"{turns[-1][1]}\n\n{text}" if text else turns[-1][1])
        else:
            turns.append((role, text))
    return turns


def turns_from_json(records: DataFrame, *, record: str = "record", key: str = "conv_id",
                    layouts=LAYOUTS) -> DataFrame:
    """Rows (key, layout, turn, role, text) from a column of JSON records of any
    mix of layouts. A record without a mapping, a null and one that is no JSON
    object gives one row with a null layout, turn, role and text, and an empty list
    of turns one with its layout, so none is lost. Null texts are empty. Repeated keys are told apart by the caller, who sees one row set each."""
    common.ship()
    kind = records.schema[key].dataType

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    value = json.loads(line) if line else None
                except ValueError:
                    value = None
                layout, turns = None, []
                if isinstance(value, dict):
                    layout = select_layout(value_paths(value), layouts, null_paths(value, layouts=layouts))
                if layout is not None:
                    turns = turns_of(value, layout)
                out += [(name, layout.name, i, role, text) for i, (role, text) in enumerate(turns)] or [
                    (name, layout and layout.name, None, None, None)]
            names = (key, "layout", "turn", "role", "text")
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (batch.schema.field(0).type, pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    schema = T.StructType([T.StructField(key, kind), T.StructField("layout", T.StringType()),
                           T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])
    return records.select(key, record).mapInArrow(parse, schema)


def turns_from_rows(rows: DataFrame, *, key: str = "conv_id", turn: str = "turn", layouts=LAYOUTS) -> DataFrame:
    """The same rows from a table that holds one turn in each row; its schema's
    fingerprint must select such a mapping, whatever other columns there are."""
    layout = select_layout(schema_paths(rows.schema), [layout for layout in layouts if layout.rows])
    if layout is None:
        raise ValueError(f"no mapping for a table of turns with the fields {sorted(schema_paths(rows.schema))}")
    role = F.coalesce(F.col(layout.role), F.lit(""))
    return rows.select(F.col(key).alias("conv_id"), F.lit(layout.name).alias("layout"), F.col(turn).alias("turn"),
                       reduce(lambda named, one: named.when(role == one[0], one[1]), ROLES.items(), F).otherwise(role).alias("role"),
                       F.coalesce(F.col(layout.text), F.lit("")).alias("text"))


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _escaped_role(role: Column) -> Column:
    return F.replace(F.replace(_escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def format_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, formatted, loss_start, loss_chars) of the pieces whose
    concatenation in order is a conversation's text. loss_start and loss_chars
    are code points within the piece; both are 0 where nothing is learned.

    Rows come out sorted by (conv_id, turn, role, text) within a task that holds
    all of a conversation: repeated turns follow each other, null turns and ids
    come first, null roles and texts are empty."""
    placed = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                           F.coalesce("text", F.lit("")).alias("text"))
              .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    head = F.concat(F.lit(START), _escaped_role(F.col("role")), F.lit("\n"))
    text = _escaped(F.col("text"))
    learned = F.col("role") == LOSS_ROLE
    return placed.select("conv_id", "turn", F.concat(head, text, F.lit(END)).alias("formatted"),
                         F.when(learned, F.length(head)).otherwise(0).cast("long").alias("loss_start"),
                         F.when(learned, F.length(text)).otherwise(0).cast("long").alias("loss_chars"))


class Reader:
    """Reads one conversation back from pieces of its text, cut anywhere."""

    def __init__(self):
        self.rest, self.n_turns, self.chars = "", 0, 0
        self.turns, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0

    def feed(self, piece: str, loss: str) -> None:
        self.chars += len(piece)
        *whole, self.rest = (self.rest + piece).split(END)
        for turn in whole:
            if not turn.startswith(START):
                raise ValueError(f"a turn starts with {turn[:20]!r}")
            role, _, text = turn[len(START):].partition("\n")
            self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
            self.n_turns += 1
        learned = unescape(loss)
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())

    def result(self) -> tuple:
        if self.rest:
            raise ValueError(f"text after the last turn: {self.rest[:20]!r}")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted text alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars. ``pieces`` are
    format_turns' rows, in its order."""
    common.ship()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, current, reader = None, None, None

        def done(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            kind, rows = batch.schema.field(0).type, []
            for name, piece, start, chars in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if reader is None or name != current:
                    if reader is not None:
                        rows.append((current, *reader.result()))
                    current, reader = name, Reader()
                reader.feed(piece, piece[start:start + chars])
            if rows:
                yield done(rows)
        if reader is not None:
            yield done([(current, *reader.result())])

    schema = T.StructType([pieces.schema["conv_id"], T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])
    return pieces.select("conv_id", "formatted", "loss_start", "loss_chars").mapInArrow(digest, schema)
