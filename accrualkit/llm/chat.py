"""Chat formatting: heterogeneous layouts to canonical turns, to one training text with a loss mask.

A layout is recognised by a fingerprint: the hash of its sorted nested field
paths, as far as any declared mapping uses them.  The fingerprint selects a
declarative mapping that yields canonical turns (conversation, turn number,
role, text).  Tables are recognised once by their schema, JSON records one by
one, so a file may mix layouts.

The template writes a turn as ``### Role:``, a newline, the escaped text and
``</turn>`` with a newline.  Inside texts a backslash goes before each
backslash, ``###`` and ``</turn>``, so no text can open or close a turn and
``read_back`` restores every text exactly.  The loss mask covers the escaped
texts of assistant turns.

A formatted conversation is stored as pieces of about ``PIECE_CHARS``, cut
between turns, with the spans of the loss mask in each piece.  Formatting and
reading back hold one turn at a time, so a conversation that holds a third of
all rows needs no more memory than another.

Defined cases: a null text or role counts as empty, a null conversation id is
one more conversation, turns go by number (nulls first), then role and text;
repeated rows are repeated turns; records of unknown layout, of invalid JSON,
nested too deeply to be read or with text that UTF-8 cannot hold (a lone
surrogate) have no turns and are kept apart with layout ``unknown``; a null or
non-object element of a list of turns is no turn; a very long text is one turn
in one piece; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: layout: where turns and their fields are.  ``list``: an array of turns; ``fields``: one turn per
#: entry, its non-empty parts joined by a blank line; ``rows``: one row per turn already.
MAPPINGS: dict[str, dict] = {
    "rows": {"rows": ("conv_id", "turn", "role", "text")},
    "messages": {"list": ("messages", "role", "content")},
    "from_value": {"list": ("conversations", "from", "value")},
    "dialogue": {"list": ("dialog", "speaker", "text")},
    "instruction": {"fields": (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))},
    "instruction_plain": {"fields": (("user", ("instruction", "input")), ("assistant", ("output",)))},
    "instruction_response": {"fields": (("user", ("instruction",)), ("assistant", ("response",)))},
    "prompt_completion": {"fields": (("user", ("prompt",)), ("assistant", ("completion",)))},
    "prompt_response": {"fields": (("user", ("prompt",)), ("assistant", ("response",)))},
    "system_prompt": {"fields": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))},
    "question_answer": {"fields": (("user", ("question",)), ("assistant", ("answer",)))},
}
#: other names of the canonical roles
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
PIECE_CHARS = 1 << 20

# --- layouts ----------------------------------------------------------------


def mapping_paths(mapping: dict) -> frozenset[str]:
    if "rows" in mapping:
        return frozenset(mapping["rows"])
    if "list" in mapping:
        name, role, text = mapping["list"]
        return frozenset((name, f"{name}[].{role}", f"{name}[].{text}"))
    return frozenset(p for _, parts in mapping["fields"] for p in parts)


def paths_fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


KNOWN_PATHS = frozenset().union(*map(mapping_paths, MAPPINGS.values()))
BY_FINGERPRINT = {paths_fingerprint(mapping_paths(m)): name for name, m in MAPPINGS.items()}


#: Objects and lists that the paths of mappings go through.
PATH_DEPTH = 1 + max(p.count(".") + p.count("[]") for p in KNOWN_PATHS)


def schema_paths(schema: T.DataType, prefix: str = "") -> set[str]:
    """Nested field paths of a schema: ``a``, ``a.b``, ``a[].b``."""
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, f"{prefix}[]")
    if not isinstance(schema, T.StructType):
        return set()
    out = set()
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        out |= {path} | schema_paths(f.dataType, path)
    return out


def value_paths(value, prefix: str = "", depth: int = PATH_DEPTH) -> set[str]:
    """Nested field paths of a parsed record, as deep as mappings look."""
    if not depth:
        return set()
    if isinstance(value, list):
        return set().union(*(value_paths(v, f"{prefix}[]", depth - 1) for v in value)) if value else set()
    if not isinstance(value, dict):
        return set()
    out = set()
    for name, v in value.items():
        path = f"{prefix}.{name}" if prefix else str(name)
        out |= {path} | value_paths(v, path, depth - 1)
    return out


def select_layout(paths) -> str | None:
    """The layout of these field paths: by fingerprint, else the largest mapping that they contain."""
    known = KNOWN_PATHS & set(paths)
    exact = BY_FINGERPRINT.get(paths_fingerprint(known))
    if exact:
        return exact
    inside = [n for n, m in MAPPINGS.items() if mapping_paths(m) <= known]
    return max(inside, key=lambda n: (len(mapping_paths(MAPPINGS[n])), n)) if inside else None


def _role(name) -> str:
    text = "" if name is None else str(name)
    return ROLE_NAMES.get(text, text)


def record_turns(record, layout: str | None) -> list[tuple[str, str]]:
    """(role, text) of each turn of a parsed record."""
    text = lambda v: "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    if layout is None:
        return []
    mapping = MAPPINGS[layout]
    if "list" in mapping:
        name, role, content = mapping["list"]
        turns = record.get(name)
        return [(_role(t.get(role)), text(t.get(content))) for t in turns if isinstance(t, dict)] if isinstance(turns, list) else []
    if "rows" in mapping:
        return [(_role(record.get("role")), text(record.get("text")))]
    joined = [(role, "\n\n".join(filter(None, (text(record.get(p)) for p in parts)))) for role, parts in mapping["fields"]]
    return [(role, t) for role, t in joined if t or role != "system"]


_TURNS = pa.schema([("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string())])


def parsed(raw: str | None):
    """The JSON value of ``raw``; None if it is invalid, nested deeper than the parser goes, or not writable as UTF-8."""
    try:
        record = json.loads(raw or "")
        json.dumps(record, ensure_ascii=False).encode()
    except (ValueError, RecursionError):  # invalid UTF-8 is a ValueError too
        return None
    return record


def turns_from_json(df: DataFrame, id_column: str, json_column: str) -> DataFrame:
    """conv, turn, role, text, layout of JSON records, each in a layout of its own.

    A record without turns (unknown layout, invalid JSON) gives one row with a null turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                record = parsed(raw)
                layout = select_layout(value_paths(record)) if isinstance(record, dict) else None
                turns = record_turns(record, layout)
                rows += [(conv, i, role, text, layout) for i, (role, text) in enumerate(turns)] or [(conv, None, None, None, "unknown")]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TURNS, strict=True)] if rows else [pa.array([], f.type) for f in _TURNS], schema=_TURNS)

    return df.select(F.col(id_column).cast("long").alias("conv"), F.col(json_column).cast("string").alias("raw")).mapInArrow(
        run, "conv long, turn long, role string, text string, layout string"
    )


def turns_from_table(df: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """conv, turn, role, text of a table whose schema has a declared layout."""
    layout = select_layout(schema_paths(df.schema))
    if layout is None:
        raise ValueError(f"no mapping for the layout {sorted(schema_paths(df.schema))}")
    mapping, conv = MAPPINGS[layout], F.col(id_column).cast("long").alias("conv")
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    canonical = lambda role: F.coalesce(names[role], role, F.lit(""))
    if "rows" in mapping:
        return df.select(conv, F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if "list" in mapping:
        name, role, content = mapping["list"]
        each = df.select(conv, F.posexplode(F.filter(name, lambda t: t.isNotNull())).alias("turn", "t"))
        return each.select("conv", F.col("turn").cast("long"), canonical(F.col("t")[role].cast("string")).alias("role"), F.coalesce(F.col("t")[content].cast("string"), F.lit("")).alias("text"))
    made = []
    for role, parts in mapping["fields"]:
        text = F.concat_ws("\n\n", *[F.nullif(F.col(p).cast("string"), F.lit("")) for p in parts])
        made.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
    kept = F.filter(F.array(*made), lambda t: (t["text"] != "") | (t["role"] != "system"))
    each = df.select(conv, F.posexplode(kept).alias("turn", "t"))
    return each.select("conv", F.col("turn").cast("long"), "t.role", "t.text")


# --- template ---------------------------------------------------------------

# Fixed values of the template
END = "</turn>\n"
HEADINGS = {"system": "System", "user": "User", "assistant": "Assistant"}
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ([^\n]*):\n((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_ROLES = {v: k for k, v in HEADINGS.items()}


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def heading(role: str) -> str:
    return f"### {HEADINGS.get(role) or 'Role ' + json.dumps(role)}:\n"


def parse_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of each turn; raises on anything else."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        name = m[1]
        role = _ROLES[name] if name in _ROLES else json.loads(name.removeprefix("Role "))
        yield role, unescape(m[2]), m.start(2), m.end(2)
        at = m.end()


_PIECES_DDL = "conv long, piece long, formatted string, turns long, loss array<struct<start:long,end:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PIECES = pa.schema([("conv", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()), ("turns", pa.int64()), ("loss", pa.list_(_SPAN))])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, piece, parts, chars, turns, loss, begun, done = None, 0, [], 0, 0, [], False, []

    def cut():
        done.append((conv, piece, "".join(parts), turns, [{"start": a, "end": b} for a, b in loss]))

    for batch in batches:
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            if begun and (c != conv or chars >= PIECE_CHARS):
                cut()
                piece, parts, chars, turns, loss = (piece + 1 if c == conv else 0), [], 0, 0, []
            conv, begun = c, True
            head, body = heading(role or ""), escape(text or "")
            if role == "assistant":
                loss.append((chars + len(head), chars + len(head) + len(body)))
            parts.append(head + body + END)
            chars, turns = chars + len(parts[-1]), turns + 1
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done, strict=True), _PIECES, strict=True)], schema=_PIECES)
            done.clear()
    if begun:
        cut()
        yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done, strict=True), _PIECES, strict=True)], schema=_PIECES)


def format_turns(turns: DataFrame) -> DataFrame:
    """conv, piece, formatted, turns, loss (spans in the piece) of canonical turns."""
    return (
        turns.select("conv", "turn", "role", "text")
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .mapInArrow(_format, _PIECES_DDL)
    )


_DIGESTS_DDL = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGESTS = pa.schema(
    [
        ("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, done = None, None, []

    def close():
        done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for batch in batches:
        for c, formatted, loss in zip(*(batch.column(i).to_pylist() for i in (0, 2, 4)), strict=True):
            if state is not None and c != conv:
                close()
                state = None
            if state is None:
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in parse_turns(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"] : span["end"]])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(formatted)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done, strict=True), _DIGESTS, strict=True)], schema=_DIGESTS)
            done.clear()
    if state is not None:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done, strict=True), _DIGESTS, strict=True)], schema=_DIGESTS)


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation: turns and texts under the loss mask as parsed from the formatted pieces."""
    return pieces.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(_digest, _DIGESTS_DDL)
