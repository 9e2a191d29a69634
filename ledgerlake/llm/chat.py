"""Chat formatting: records of different layouts to canonical turns, and turns to one template.

A record's layout is known by its fingerprint: a hash of the set of its nested field paths
that any layout declares (NULL fields don't count, but where a layout needs them).
:data:`LAYOUTS` declares for each layout which paths it needs, which it may have, and where
roles and texts are; every combination has its fingerprint, so a record is looked up, not
guessed at. A content may be a list of parts with texts, which follow one another.

Leaves that no layout declares are left out and counted (``ignored``). Where more than that
would be lost, a record has no layout: if it has fields of several layouts, something other
than text in the place of a text, undeclared leaves in a turn without text, or no turn.
Records of no layout give one row with a NULL role that holds the ``record`` as it is;
:func:`unmatched` gives these, and :func:`format_records` writes and counts them.

The template marks a turn as ``<|im_start|>role LF text<|im_end|>LF``. Wherever a text holds
``<`` and ``|`` with any number of backslashes between them, one more backslash is put
there, so no text can hold a mark, and taking one away restores it. In a role, backslashes
and line feeds are escaped as well. The loss mask is the escaped text of assistants' turns.

A NULL text or role is empty, a NULL turn number comes first; equal numbers are ordered by role
and text, and repeated rows count as often as they occur. Turns are formatted and parsed
one by one, in parallel; only the digest reads a conversation in order, as a stream, so that
the longest conversation needs no more memory than a short one. Other columns of the input
play no part. An empty table gives an empty output and counts of 0.
"""

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class Layout:
    """``turns``: (role, path of its text) in order, or one list of turns.

    Of a list: its path ("" for a record that is one turn itself), the names of role and
    text in it, and what foreign roles are called here.
    """

    needs: frozenset[str]
    may: frozenset[str] = frozenset()
    turns: tuple[tuple[str, str], ...] = ()
    path: str | None = None
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()


def _fields(*names: str) -> frozenset[str]:
    return frozenset(names)


LAYOUTS = (
    Layout(_fields(), _fields("turn", "role", "text"), path="", text="text"),
    Layout(
        _fields("messages[].role"),
        _fields(
            "messages[].content",
            "messages[].content[]",
            "messages[].content[].text",
            "messages[].content[].type",
        ),
        path="messages",
    ),
    Layout(
        _fields("conversations[].from"),
        _fields("conversations[].value"),
        path="conversations",
        role="from",
        text="value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout(
        _fields("prompt", "completion"),
        _fields("system"),
        turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion")),
    ),
    Layout(
        _fields("prompt.text", "response.text"),
        turns=(("user", "prompt.text"), ("assistant", "response.text")),
    ),
    Layout(
        _fields("instruction", "output"),
        _fields("input", "system"),
        turns=(("system", "system"), ("user", "instruction\ninput"), ("assistant", "output")),
    ),
)


def field_paths(value: object, path: str = "", null: bool = False) -> Iterator[str]:
    """Paths of all leaves that are not NULL, or are; ``[]`` stands for any place in a list."""
    if isinstance(value, dict):
        for name, inner in value.items():
            yield from field_paths(inner, f"{path}.{name}" if path else name, null)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{path}[]", null)
    elif (value is None) == null:
        yield path


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def _registry() -> dict[str, Layout]:
    found = {}
    for layout in LAYOUTS:
        options = sorted(layout.may)
        for some in chain.from_iterable(
            combinations(options, n) for n in range(len(options) + 1)
        ):
            found[fingerprint(layout.needs | set(some))] = layout
    return found


_BY_FINGERPRINT = _registry()


_DECLARED = frozenset().union(*(x.needs | x.may for x in LAYOUTS))


def _value(record: object, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value: object) -> str | None:
    """A text, or the texts of a list of parts one after another."""
    if isinstance(value, list):
        return "".join(_text(x.get("text") if isinstance(x, dict) else x) or "" for x in value)
    if isinstance(value, dict):  # without leaves, or its record has no layout
        return None
    return None if value is None else str(value)


def _at(record: object, path: str) -> str | None:
    return _text(_value(record, path))


def _layout_of(record: dict, leaves: list[str]) -> tuple[str, Layout | None]:
    """The fingerprint of the record's declared paths and its layout."""
    known = _DECLARED.intersection(leaves)
    mark = fingerprint(known)
    if not known:  # a turn whose fields are all NULL, if it has no others
        return mark, LAYOUTS[0] if LAYOUTS[0].may.issuperset(record) and not leaves else None
    if mark in _BY_FINGERPRINT:
        return mark, _BY_FINGERPRINT[mark]
    nulls = set(field_paths(record, null=True))

    def is_null(path: str) -> bool:
        return path in nulls or any(path.startswith(f"{x}.") for x in nulls)

    fit = [
        x
        for x in LAYOUTS
        if known <= x.needs | x.may and x.needs and all(map(is_null, x.needs - known))
    ]
    return (fingerprint(known | fit[0].needs), fit[0]) if len(fit) == 1 else (mark, None)


def _loses(record: dict, layout: Layout, known: frozenset[str], leaves: set[str]) -> bool:
    """Whether more than undeclared leaves beside a text would be left out."""
    others = leaves - known
    below = tuple(x + mark for x in known for mark in ".[")
    if any(x.startswith(below) for x in others):
        return True
    if layout.path is None:
        return bool(others) and not all(_at(record, x) for x in layout.needs)
    prefix = f"{layout.path}[]" if layout.path else ""
    for item in record[layout.path] if layout.path else [record]:
        parts = _value(item, layout.text)
        for part in parts if isinstance(parts, list) else ():
            if isinstance(part, dict) and part.get("text") is None and any(field_paths(part)):
                return True
        if others and not _text(parts) and not known.issuperset(field_paths(item, prefix)):
            return True
    return False


def read_record(record: dict) -> tuple[str, list[tuple[int | None, str, str]] | None, int]:
    """The record's fingerprint, its turns (number, role, text), None for no layout, and the
    number of its leaves that are ignored."""
    leaves = list(field_paths(record))
    mark, layout = _layout_of(record, leaves)
    known = layout.needs | layout.may if layout else frozenset()
    if layout is None or _loses(record, layout, known, set(leaves)):
        return fingerprint(leaves), None, 0
    ignored = sum(x not in known for x in leaves)
    if layout.path is None:
        found = []
        for role, paths in layout.turns:
            texts = [x for path in paths.split("\n") if (x := _at(record, path)) is not None]
            if texts or layout.needs.intersection(paths.split("\n")):
                found.append((len(found), role, "\n".join(texts)))
        return mark, found, ignored
    items = record[layout.path] if layout.path else [record]
    names = dict(layout.roles)
    turns = [
        (
            item.get("turn") if not layout.path else k,
            names.get(role := _at(item, layout.role) or "", role),
            _at(item, layout.text) or "",
        )
        for k, item in enumerate(items)
    ]
    return mark, turns, ignored


def turns_of(record: dict) -> tuple[str, list[tuple[int | None, str, str]] | None]:
    """The record's fingerprint and its turns (number, role, text), None for no layout."""
    return read_record(record)[:2]


def _fits(turns: list[tuple]) -> bool:
    """Whether numbers are of 64 bits and texts can be written as UTF-8, without lone surrogates."""
    for turn, role, text in turns:
        whole = isinstance(turn, int) and not isinstance(turn, bool) and -(1 << 63) <= turn < 1 << 63
        if turn is not None and not whole:
            return False
        for x in (role, text):
            if not isinstance(x, str) or _SURROGATE.search(x):
                return False
    return True


def _read(raw: str | None) -> tuple[str | None, list[tuple] | None, int]:
    """:func:`read_record` of a record as JSON; no turns for what is none, or can't be kept."""
    try:
        record = json.loads(raw or "null")
        mark, turns, ignored = read_record(record) if isinstance(record, dict) else (None, None, 0)
    except (ValueError, RecursionError):  # no JSON, names that are no UTF-8, or nested too deep
        return None, None, 0
    return (mark, turns, ignored) if turns is not None and _fits(turns) else (mark, None, 0)


_TURNS = (
    "conv_id long, fingerprint string, turn long, role string, text string, ignored long, "
    "record string"
)


def canonical_turns(records: DataFrame) -> DataFrame:
    """Turns (conv_id, fingerprint, turn, role, text) of records (conv_id, record as JSON).

    A record's first turn has the number of leaves that are ``ignored``, the others 0. Only
    the row of a record of no layout has the ``record``.
    """

    def turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, raw in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "record"))):
                mark, found, n = _read(raw)
                if found is None:
                    rows.append((conv, mark, None, None, None, 0, raw))
                else:
                    rows += [(conv, mark, *x, 0 if k else n, None) for k, x in enumerate(found)]
            if rows:
                long, text = pa.int64(), pa.string()
                kinds = (long, text, long, text, text, long, text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
                    names=[x.split()[0] for x in _TURNS.split(", ")],
                )

    return records.select("conv_id", "record").mapInArrow(turns, _TURNS)


def turn_records(rows: DataFrame) -> DataFrame:
    """A table with one turn a row (conv_id, turn, role, text) as records."""
    return rows.select("conv_id", F.to_json(F.struct("turn", "role", "text")).alias("record"))


_SURROGATE = re.compile("[\ud800-\udfff]")


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = unescape(role)
    return re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], plain)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its loss begins and ends; both 0 if it has none."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    span = (len(head), len(head) + len(body)) if role == LOSS_ROLE else (0, 0)
    return f"{head}{body}{END}\n", *span


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, _, rest = formatted.removeprefix(START).partition("\n")
    return unescape_role(role), unescape(rest[: rest.index(END)])


_FORMATTED = "conv_id long, turn long, formatted string, loss_start long, loss_end long"


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted turn a row, with the loss mask as a span of its code points."""

    def formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(x).to_pylist() for x in ("role", "text"))
            rows = [format_turn(role, text or "") for role, text in zip(roles, texts)]
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("conv_id", "turn")),
                    *(pa.array(values, kind) for values, kind in zip(columns, kinds)),
                ],
                names=[x.split()[0] for x in _FORMATTED.split(", ")],
            )

    slim = turns.where("role is not null").select("conv_id", "turn", "role", "text")
    return slim.mapInArrow(formatted, _FORMATTED)


def unmatched(turns: DataFrame) -> DataFrame:
    """The records of no layout (conv_id, fingerprint of all paths, record) among the turns."""
    return turns.where("role is null").select("conv_id", "fingerprint", "record")


def format_records(records: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Formatted turns and records of no layout as written tables, and what was counted.

    Counts are of records of no layout (``unmatched``) and of leaves left out (``ignored``),
    taken while the turns are written. The records are read again only if some match none.
    """
    turns, seen = canonical_turns(records), Observation()
    counted = turns.observe(
        seen, F.count_if(F.col("role").isNull()).alias("unmatched"), F.sum("ignored").alias("ignored")
    )
    formatted = written(format_turns(counted), "formatted")
    counts = {name: seen.get.get(name) or 0 for name in ("unmatched", "ignored")}
    rest = unmatched(turns)
    return formatted, written(rest if counts["unmatched"] else rest.limit(0), "unmatched"), counts


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = ("formatted", "loss_start", "loss_end")
        for formatted, start, end in zip(*(batch.column(x).to_pylist() for x in columns)):
            rows.append((*parse_turn(formatted), unescape(formatted[start:end]), len(formatted)))
        parsed = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(x) for x in ("conv_id", "turn")),
                *(pa.array(values, kind) for values, kind in zip(parsed, kinds)),
            ],
            names=["conv_id", "turn", "role", "text", "loss", "size"],
        )


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their turns in order."""
    own, any_, rows = None, False, []
    turns = loss = None
    counts = [0, 0, 0]  # turns, loss, formatted

    def close() -> None:
        rows.append((own, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

    def batch_of() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
            names=[x.split()[0] for x in _DIGESTS.split(", ")],
        )

    for batch in batches:
        names = ("conv_id", "role", "text", "loss", "size")
        for conv, role, text, kept, size in zip(*(batch.column(x).to_pylist() for x in names)):
            if not any_ or conv != own:
                if any_:
                    close()
                own, any_ = conv, True
                turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            turns.update(f"{role}\n{text}\n".encode())
            loss.update(kept.encode())
            counts = [counts[0] + 1, counts[1] + len(kept), counts[2] + size]
        if rows:
            yield batch_of()
            rows.clear()
    if any_:
        close()
        yield batch_of()


def digests(formatted: DataFrame) -> DataFrame:
    """What reading formatted turns back gives, by conversation."""
    return (
        formatted.mapInArrow(
            _parsed, "conv_id long, turn long, role string, text string, loss string, size long"
        )
        .repartition("conv_id")
        .sortWithinPartitions(
            F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"
        )
        .mapInArrow(_digested, _DIGESTS)
    )
