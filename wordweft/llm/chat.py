"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A record's nested field paths (list positions left out) are
sorted and hashed. The hash picks a mapping from the registry: either a list of messages with the places of
role and text, or fixed fields in the order of their turns. The mapping gives the canonical turns, a list of
(role, text), from which one string per record is formatted and the loss mask is set.

Template: ``### role:`` newline, text, newline, ``</turn>`` newline, for each turn. Inside roles and texts a
backslash, and the start of any control string, is escaped by a backslash, so the template can be read back
without loss. The loss mask covers the escaped assistant texts, as [start, end) spans of code points.

Records of unknown layout come out with layout null, no turns and an empty string; they are not dropped.
Nulls: a null role or text is empty; a null or unreadable record, one nested too deep to be read, and a list of
scalars where messages belong have an unknown layout; an empty list of messages has no turns. Extra fields of a record change its paths and so its fingerprint; layouts are a
parameter and list their optional fields. Repeated turns are all kept, in order of (turn, role, text).
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Declarative layouts. ``list``: path of the messages, with the fields of role and text. ``turns``: fields in
#: order with their roles; a field named in ``optional`` may be missing. ``roles``: names of speakers.
LAYOUTS = {
    "messages": {"list": "messages", "role": "role", "text": "content"},
    "turns": {"list": "turns", "role": "role", "text": "text"},
    "conversations": {"list": "conversations", "role": "from", "text": "value",
                      "roles": {"human": "user", "gpt": "assistant"}},
    "nested chat": {"list": "chat.messages", "role": "author.role", "text": "content.text"},
    "instruction": {"turns": [("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")],
                    "optional": ["system", "input"]},
    "prompt": {"turns": [("system", "system"), ("user", "prompt"), ("assistant", "completion")], "optional": ["system"]},
    "prompt and response": {"turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")], "optional": ["system"]},
    "question": {"turns": [("system", "context"), ("user", "question"), ("assistant", "answer")], "optional": ["context"]},
}
LOSS_ROLE = "assistant"
#: Behind the path of an empty list; a list of scalars has its own path.
EMPTY = "[0]"
_SPECIAL = re.compile(r"\\|### |</turn>")
_TURN = re.compile(r"### ((?:[^\\:\n]|\\.)*):\n(.*?)\n</turn>\n", re.DOTALL)


def field_paths(value, path: str = "") -> set[str]:
    """Paths of the leaves of a record; all items of a list share one path, and an empty list has one of its own."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items())) if value else {path}
    if isinstance(value, list):
        return set().union(*(field_paths(v, path + "[]") for v in value)) if value else {path + EMPTY}
    return {path}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def registry(layouts: dict = LAYOUTS) -> dict[str, tuple[str, dict]]:
    """Fingerprint -> (name, layout), one fingerprint per set of optional fields."""
    out = {}
    for name, layout in layouts.items():
        if "list" in layout:
            parts = layout["list"] + "[]"
            out[fingerprint({f"{parts}.{layout['role']}", f"{parts}.{layout['text']}"})] = (name, layout)
            out[fingerprint({layout["list"] + EMPTY})] = (name, layout)
            continue
        fields, optional = [f for _, f in layout["turns"]], layout.get("optional", [])
        for n in range(len(optional) + 1):
            for left_out in itertools.combinations(optional, n):
                out[fingerprint({f for f in fields if f not in left_out})] = (name, layout)
    return out


def _at(value, path: str):
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record, known: dict) -> tuple[str | None, list[tuple[str, str]]]:
    """(layout, turns) of one record."""
    if not isinstance(record, dict):
        return None, []
    name, layout = known.get(fingerprint(field_paths(record)), (None, None))
    if layout is None:
        return None, []
    if "list" in layout:
        roles = layout.get("roles", {})
        turns = [(_text(_at(m, layout["role"])), _text(_at(m, layout["text"]))) for m in _at(record, layout["list"])]
        return name, [(roles.get(role, role), text) for role, text in turns]
    turns = [(role, _text(record[field])) for role, field in layout["turns"] if field in record]
    # Fields that speak for one role in a row are one turn; an empty optional field says nothing.
    merged: list[tuple[str, str]] = []
    for role, group in itertools.groupby(turns, key=lambda t: t[0]):
        texts = [t for _, t in group]
        merged.append((role, "\n".join([texts[0], *(t for t in texts[1:] if t)])))
    return name, merged


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_role(role: str) -> str:
    return re.sub(r"([\\:\n])", r"\\\1", role)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and the spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape_role(role)}:\n", escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "\n</turn>\n"]
        at += len(head) + len(body) + len("\n</turn>\n")
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def records_of_turns(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) -> conv_id and the conversation as a JSON record."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.collect_list("t").alias("ts"))
    messages = F.transform(F.array_sort("ts"), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select("conv_id", F.to_json(F.struct(messages.alias("turns"))).alias("record"))


def format_records(records: DataFrame, key: str = "conv_id", layouts: dict = LAYOUTS) -> DataFrame:
    """key and JSON ``record`` of any layout -> key, layout, n_turns, formatted, loss_spans."""
    kind = "bigint" if dict(records.dtypes)[key] in ("bigint", "int") else "string"
    schema = f"{key} {kind}, layout string, n_turns bigint, formatted string, loss_spans array<struct<start:bigint,stop:bigint>>"

    def convert(batches):
        known = registry(layouts)
        for batch in batches:
            out = []
            for text in batch.column("record").to_pylist():
                try:
                    name, turns = canonical_turns(json.loads(text) if text is not None else None, known)
                except (ValueError, RecursionError):  # no JSON, or nested deeper than any layout
                    name, turns = None, []
                formatted, spans = format_turns(turns)
                out.append((name, len(turns), formatted, [{"start": a, "stop": b} for a, b in spans]))
            columns = list(zip(*out)) or [()] * 4
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], span)],
                names=[key, "layout", "n_turns", "formatted", "loss_spans"])

    return records.select(F.col(key).cast(kind).alias(key), "record").mapInArrow(convert, schema)


def digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What the formatted strings say when they are read back: turns and text under the loss mask."""
    schema = (f"{key} {dict(formatted.dtypes)[key]}, layout string, n_turns bigint, turns_sha256 string, loss_chars bigint, "
              "loss_sha256 string, formatted_chars bigint")

    def read(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"]:s["stop"]]) for s in spans)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("layout"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[key, "layout", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(key, "layout", "formatted", "loss_spans").mapInArrow(read, schema)
