"""Chat formatting by schema fingerprint.

A record's layout is recognised by the hash of its nested field paths; the hash selects
a declarative mapping to canonical turns; a template writes them as one text with a
loss mask and can be read back exactly.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """One turn of fixed role; its text is the non-empty values of ``paths`` with a blank line between. Optional turns without text are left out."""

    role: str
    paths: tuple[str, ...]
    optional: bool = False


@dataclass(frozen=True)
class Each:
    """One turn per element of list ``path``; ``text`` may end in ``[].name`` for content given in parts."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """``required`` and ``optional`` are groups of nested field paths; every subset of the optional groups has a fingerprint of its own."""

    name: str
    required: tuple[str, ...]
    turns: tuple[Turn | Each, ...]
    optional: tuple[tuple[str, ...], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


_SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}

LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), (Each("messages", "role", "content"),), roles=_SPOKEN),
    Layout(
        "message parts",
        ("messages[].content[].text", "messages[].content[].type", "messages[].role"),
        (Each("messages", "role", "content[].text"),),
        roles=_SPOKEN,
    ),
    Layout("no messages", ("messages[]",), ()),
    Layout("spoken", ("conversations[].from", "conversations[].value"), (Each("conversations", "from", "value"),), roles=_SPOKEN),
    Layout("no conversations", ("conversations[]",), ()),
    Layout(
        "instruction",
        ("instruction", "output"),
        (Turn("system", ("system",), True), Turn("user", ("instruction", "input")), Turn("assistant", ("output",))),
        optional=(("input",), ("system",)),
    ),
    Layout("instruction and response", ("instruction", "response"), (Turn("user", ("instruction", "context")), Turn("assistant", ("response",))), optional=(("context",), ("category",))),
    *(
        Layout(f"{asked} and {said}", (asked, said), (Turn("system", ("system",), True), Turn("user", (asked,)), Turn("assistant", (said,))), optional=(("system",),))
        for asked, said in (("prompt", "response"), ("prompt", "completion"), ("question", "answer"), ("input", "output"))
    ),
)

#: Top-level fields that say nothing about the layout.
METADATA = frozenset({"id", "conv_id", "source", "lang", "language", "metadata", "dataset", "url", "score", "timestamp"})


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of the leaves below ``value``; list elements count together as ``[]``; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str] | tuple[str, ...]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=16).hexdigest()


def mappings(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """The layout for every fingerprint that one of them covers."""
    known: dict[str, Layout] = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for groups in itertools.combinations(layout.optional, n):
                known.setdefault(fingerprint({*layout.required, *itertools.chain(*groups)}), layout)
    return known


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    turns = []
    for rule in layout.turns:
        if isinstance(rule, Turn):
            text = "\n\n".join(t for t in (_text(record.get(p)) for p in rule.paths) if t)
            if text or not rule.optional:
                turns.append((rule.role, text))
            continue
        outer, _, inner = rule.text.partition("[].")
        for element in record[rule.path]:
            role = _text(element.get(rule.role))
            value = element.get(outer)
            text = "".join(_text(part.get(inner)) for part in value) if inner and isinstance(value, list) else _text(value)
            turns.append((layout.roles.get(role, role), text))
    return turns


# The template. Control strings open with "<|"; inside texts a backslash is put between the
# two characters, after those already there, so no text can hold a control string.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the code point ranges under the loss mask, one per assistant turn."""
    parts: list[str] = []
    mask, at = [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{_role_out(role)}\n", escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END + "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), mask


_READ = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(_role_in(m[1]), unescape(m[2])) for m in _READ.finditer(formatted)]


FORMATTED = "conv_id bigint, layout string, fingerprint string, n_turns bigint, formatted string, mask array<struct<begin:int,end:int>>"
_FORMATTED_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("layout", pa.string()),
        ("fingerprint", pa.string()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("mask", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    ]
)


def format_chats(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Format every record: conv_id, layout, fingerprint, n_turns, formatted, mask.

    ``records`` has conv_id and ``record``, a JSON object in any of the layouts. Values
    that are null count as empty text. A record that no mapping fits keeps its
    fingerprint and has null layout and text; one that is null or no JSON object has a
    null fingerprint too. Rows are formatted one by one, repeated ids included; other
    columns are not read. A conversation is one row, so one task holds it whole.
    """
    known = mappings(layouts)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, record in zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist()):
                rows.append({"conv_id": conv_id, **_formatted(record, known)})
            yield pa.RecordBatch.from_pylist(rows, schema=_FORMATTED_ARROW)

    return records.select("conv_id", "record").mapInArrow(formatted, FORMATTED)


def _formatted(record: str | None, known: dict[str, Layout]) -> dict:
    nothing = {"layout": None, "fingerprint": None, "n_turns": 0, "formatted": None, "mask": []}
    try:
        value = json.loads(record) if record is not None else None
    except ValueError:
        value = None
    if not isinstance(value, dict):
        return nothing
    key = fingerprint(field_paths({k: v for k, v in value.items() if k not in METADATA}))
    layout = known.get(key)
    if layout is None:
        return nothing | {"fingerprint": key}
    turns = canonical_turns(value, layout)
    text, mask = render(turns)
    return {"layout": layout.name, "fingerprint": key, "n_turns": len(turns), "formatted": text, "mask": [{"begin": b, "end": e} for b, e in mask]}


def turn_records(turns: DataFrame) -> DataFrame:
    """Records in layout ``messages`` from rows by turn (conv_id, turn, role, text): conv_id, record.

    Turns go by number, then role and text; null roles and texts are empty; a null
    conv_id is one conversation; repeated rows are repeated turns.
    """
    listed = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))))
    grouped = turns.groupBy("conv_id").agg(listed.alias("turns"))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return grouped.select("conv_id", F.to_json(F.struct(messages.alias("messages"))).alias("record"))


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when they are read back. Records without a text have no turns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for conv_id, text, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "mask"))):
                turns = read_back(text or "")
                loss = "".join(unescape((text or "")[m["begin"] : m["end"]]) for m in mask)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                values = (conv_id, len(turns), _sha(said), len(loss), _sha(loss), len(text or ""))
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in DIGESTS.split(", ")])

    return formatted.select("conv_id", "formatted", "mask").mapInArrow(read, DIGESTS)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
