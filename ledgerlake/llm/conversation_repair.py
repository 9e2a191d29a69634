"""Cheapest repair of conversations whose turns do not alternate.

Rows of a conversation are edited until their roles' initials read ``(s?(ua)+)?``: nothing, or an
optional system turn and then user and assistant in turn. Keep costs 0, Rerole to user or
assistant 2, Delete 3, Insert of an empty user or assistant turn 2; a truncated row that is not
deleted costs 1 more, and blank and repeated rows must be deleted. Of all cheapest repairs the
one whose edits, written as their initials, come first in ASCII is taken.

Method: a Viterbi search over the four states of that pattern (nothing yet, after s, after u,
after a), one pass over the rows in order. Survivors' paths are branches of one tree of
backpointers. Each node counts what refers to it: its children and the survivors that end
there. Branches that lose their last survivor are cut off, and once all survivors share an
ancestor, its edits are given out and forgotten, so that memory holds the rows since
then and no more. A survivor that costs more than what another one needs to imitate it
(``_LEAD``) can't win any more and is dropped, which lets the others coalesce. Ties compare the
whole unresolved paths: no survivor's path begins with another's, as all end at the same row, so
their order is that of the survivors before, then of the new edits, and is carried along as
a rank.

Defined results. Rows are taken by turn, NULL first, then by role and text. NULL roles and texts
are one space. White space is space and U+0009 to U+000D. A row's first fault counts: blank
(nothing but white space), duplicate (an earlier row of the conversation has the same role and
text), truncated (the last character before trailing white space is none of ``.!?``). An
empty role has no initial and must be replaced or deleted. A NULL conv_id is a conversation like
others; other columns of the input play no part; very long texts travel whole. An empty
table gives no rows, and a conversation whose rows are all dropped a single row without an edit.

At scale: earlier occurrences are found by grouping digests, combined map-side, so that nothing
remembers a conversation's texts. A conversation is one stream through one task, of
constant memory but for rows whose repair is open; it is never collected.
"""

from collections import deque
from collections.abc import Iterable, Iterator
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs, and the state that each initial leads to from each state.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
_ROLES = {"u": "user", "a": "assistant"}
# What ends a conversation from each state: the roles to insert.
_FINISH = {"": "", "s": "ua", "u": "a", "a": ""}
# _LEAD[x, y]: state x can do what y does for at most so much more, whatever rows follow. After
# a system turn or an assistant's, what may come is alike; from u or to u it takes an insertion;
# a system turn that only the beginning can keep is deleted; an end needs a whole pair after s.
_LEAD = {
    ("", "s"): 0,
    ("", "u"): 2,
    ("", "a"): 0,
    ("s", ""): 4,
    ("s", "u"): 2,
    ("s", "a"): 4,
    ("u", ""): 5,
    ("u", "s"): 2,
    ("u", "a"): 2,
    ("a", ""): 3,
    ("a", "s"): 0,
    ("a", "u"): 2,
}
_SPACES = " \t\n\x0b\x0c\r"


class _Node:
    """An edit in the tree of backpointers. ``refs`` counts its children and survivors."""

    __slots__ = ("up", "down", "refs", "edit", "role", "row")

    def __init__(self, up: "_Node | None", edit: str, role: str | None, row: tuple | None):
        self.up, self.edit, self.role, self.row = up, edit, role, row
        self.down: list[_Node] = []
        self.refs = 0
        if up is not None:
            up.down.append(self)
            up.refs += 1


class Search:
    """The repair of one conversation; rows go in, edits come out as soon as they are certain.

    An edit is (edit, role, row): its initial, the role of the turn it leaves (None if deleted),
    and the row it belongs to (None if inserted).
    """

    def __init__(self):
        self._root = _Node(None, "", None, None)
        self._root.refs = 1
        # By state: cost, rank of the path among the survivors, last node of the path.
        self._alive = {"": (0, 0, self._root)}

    def open_edits(self) -> int:
        """Nodes of the tree, which is what memory holds."""
        count, nodes = 0, deque([self._root])
        while nodes:
            node = nodes.popleft()
            nodes.extend(node.down)
            count += 1
        return count - 1

    def add(self, row: tuple, role: str, must_go: bool, truncated: bool) -> Iterator[tuple]:
        """Take a row; yields what is certain now."""
        best: dict[str, tuple] = {}
        for state, (cost, rank, node) in self._alive.items():
            for into, paid, edits, roles in self._moves(state, role, must_go, truncated):
                key = (cost + paid, rank, edits)
                if into not in best or key < best[into][0]:
                    best[into] = (key, node, roles)
        kept = [
            (key[1:], key[0], state, node, roles)
            for state, (key, node, roles) in best.items()
            if not any(
                other != state and best[other][0][0] + _LEAD[other, state] < key[0]
                for other in best
            )
        ]
        kept.sort(key=lambda x: x[0])
        alive = {}
        for rank, ((_, edits), cost, state, node, roles) in enumerate(kept):
            for edit, left in zip(edits, roles):
                node = _Node(node, edit, left, None if edit == "I" else row)
            node.refs += 1
            alive[state] = (cost, rank, node)
        for _, _, node in self._alive.values():
            self._release(node)
        self._alive = alive
        yield from self._certain()

    def end(self) -> Iterator[tuple]:
        """The rest of the edits."""
        ends = {
            state: (cost + INSERT * len(_FINISH[state]), rank)
            for state, (cost, rank, _) in self._alive.items()
        }
        # Rank first: no path begins with another one, so what is appended decides nothing.
        state = min(ends, key=ends.get)
        node = self._alive[state][2]
        for initial in _FINISH[state]:
            node = _Node(node, "I", _ROLES[initial], None)
        node.refs += 1
        for _, _, old in self._alive.values():
            self._release(old)
        yield from self._certain()

    @staticmethod
    def _moves(state: str, role: str, must_go: bool, truncated: bool) -> Iterator[tuple]:
        """(next state, cost, edits, roles left) for one row; Insert comes before Keep or Rerole.

        Insert before Delete is never first in ASCII, and two of them lead nowhere new.
        """
        yield state, DELETE, "D", (None,)
        if must_go:
            return
        for inserted in ("", "a" if state == "u" else "u"):
            at = _NEXT[state][inserted] if inserted else state
            before = tuple(_ROLES[x] for x in inserted)
            paid, mark = INSERT * len(before) + TRUNCATED * truncated, "I" * len(before)
            if role[:1] in _NEXT[at]:
                yield _NEXT[at][role[:1]], paid, f"{mark}K", (*before, role)
            for initial, other in _ROLES.items():
                if initial in _NEXT[at]:
                    yield _NEXT[at][initial], paid + REROLE, f"{mark}R", (*before, other)

    def _release(self, node: _Node) -> None:
        node.refs -= 1
        while not node.refs and node.up is not None:
            above = node.up
            above.down.remove(node)
            above.refs -= 1
            node = above

    def _certain(self) -> Iterator[tuple]:
        """Move the root down to the ancestor that all survivors share."""
        root = self._root
        while root.refs == 1 and root.down:
            root = root.down[0]
            root.up = None
            yield root.edit, root.role, root.row
        self._root = root


def _order(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"
    )


def _trimmed(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(_SPACES))


def _with_faults(rows: DataFrame) -> DataFrame:
    """Rows with their faults; ``later`` if the same role and text came at an earlier turn.

    ``tied`` rows have the same role and text as others, none of them earlier.
    """
    last = F.substring(_trimmed("text"), -1, 1)
    rows = rows.withColumns(
        {
            "blank": last == "",
            "truncated": ~last.isin(".", "!", "?"),
            "digest": F.unhex(F.sha2("text", 256)),
        }
    )
    again = (
        rows.where("copies > 0 and not blank")
        .groupBy(F.col("conv_id").alias("of"), F.col("role").alias("as"), "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.sum("copies").alias("n"))
        .where("n > 1")
        .withColumnRenamed("digest", "what")
    )
    same = (
        rows["conv_id"].eqNullSafe(again["of"])
        & (rows["role"] == again["as"])
        & (rows["digest"] == again["what"])
    )
    first = F.col("turn").eqNullSafe(F.col("first.turn"))
    return rows.join(again, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        "blank",
        "truncated",
        (F.col("n").isNotNull() & ~first).alias("later"),
        (F.col("n").isNotNull() & first).alias("tied"),
    )


_EDITS = (
    "step long, edit string, cost long, fault string, turn {turn}, was string, role string, "
    "text string"
)


def repair(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The edits of every conversation of rows (conv_id, turn, role, text).

    The column named by ``copies``, if any, says for how many adjacent copies a row stands.
    Returns (conv_id, step, edit, cost, fault, turn, was, role, text) in the
    order of ``step`` from 0: the initial of the edit, what it costs, the row's turn and its
    role before, and the role and text of the turn that is left, NULL if the row is deleted.
    A conversation without any row has one row without an edit.
    """
    count = F.lit(1) if copies is None else F.col(copies)
    rows = rows.select(
        "conv_id",
        "turn",
        *(F.coalesce(F.col(x), F.lit(" ")).alias(x) for x in ("role", "text")),
        count.cast("int").alias("copies"),
    )
    turn, conv = (rows.schema[x].dataType.simpleString() for x in ("turn", "conv_id"))
    schema = f"conv_id {conv}, {_EDITS.format(turn=turn)}"
    arrow = pa.schema(
        [("conv_id", _arrow(conv)), ("step", pa.int64()), ("edit", pa.string())]
        + [("cost", pa.int64()), ("fault", pa.string()), ("turn", _arrow(turn))]
        + [(x, pa.string()) for x in ("was", "role", "text")]
    )

    def edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, own, before, step, out = None, None, None, 0, []

        def give(edits: Iterable[tuple]) -> None:
            nonlocal step
            for edit, role, row in edits:
                at, was, text, fault = row or (None, None, "", None)
                cost = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
                cost += TRUNCATED * (fault == "truncated" and edit != "D")
                left = None if edit == "D" else text
                out.append((own, step, edit, cost, fault, at, was, role, left))
                step += 1

        def close() -> None:
            give(search.end())
            if not step:
                out.append((own, 0, None, 0, None, None, None, None, None))

        def batch_of() -> pa.RecordBatch:
            columns = zip(*out)
            made = [pa.array(x, field.type) for x, field in zip(columns, arrow)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, schema=arrow)

        names = ("conv_id", "turn", "role", "text", "copies", "blank", "truncated", "later", "tied")
        for batch in batches:
            for conv, turn, role, text, count, *flags in zip(
                *(batch.column(x).to_pylist() for x in names)
            ):
                blank, truncated, later, tied = flags
                if search is None or conv != own:
                    if search is not None:
                        close()
                    search, own, before, step = Search(), conv, None, 0
                for _ in range(count):
                    this = (turn, role, text)
                    repeated = later or (tied and this == before)
                    fault = (
                        "blank"
                        if blank
                        else "duplicate"
                        if repeated
                        else "truncated"
                        if truncated
                        else None
                    )
                    before = this
                    must_go, cut = blank or repeated, fault == "truncated"
                    give(search.add((turn, role, text, fault), role, must_go, cut))
                if len(out) >= 1000:
                    yield batch_of()
            if out:
                yield batch_of()
        if search is not None:
            close()
        if out:
            yield batch_of()

    return _order(_with_faults(rows)).mapInArrow(edited, schema)


def _arrow(kind: str) -> pa.DataType:
    known = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if kind not in known:
        raise ValueError(f"conv_id and turn are whole numbers or strings, not {kind}")
    return known[kind]


def repaired_turns(edits: DataFrame) -> DataFrame:
    """The turns that edits leave, (conv_id, step, role, text)."""
    return edits.where("edit != 'D'").select("conv_id", "step", "role", "text")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summaries(edits: DataFrame) -> DataFrame:
    """What :func:`repair` found and did, by conversation.

    ``gaps`` are turn numbers missing between the least and the greatest, ``illegal`` counts
    adjacent roles before the repair whose initials are none of su, ua and au, ``cost`` is that
    of all edits, ``audit`` their initials in order, and ``repaired_sha256`` digests the turns
    that are left, ``role:text`` joined by line feeds.
    """
    conv = edits.schema["conv_id"].dataType.simpleString()
    arrow = pa.schema(
        [("conv_id", _arrow(conv))]
        + [(x, pa.int64()) for x in _COUNTS]
        + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []

        def close() -> None:
            if (turns := state["turns"]) is not None:
                state["gaps"] = turns[1] - turns[0] + 1 - turns[2]
            audit = "".join(state["audit"])
            counts = (state[x] for x in _COUNTS)
            out.append((state["conv"], *counts, audit, state["digest"].hexdigest()))

        def batch_of() -> pa.RecordBatch:
            made = [pa.array(x, field.type) for x, field in zip(zip(*out), arrow)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, schema=arrow)

        names = ("conv_id", "edit", "cost", "fault", "turn", "was", "role", "text")
        for batch in batches:
            for conv, edit, cost, fault, turn, was, role, text in zip(
                *(batch.column(x).to_pylist() for x in names)
            ):
                if state is None or conv != state["conv"]:
                    if state is not None:
                        close()
                    state = dict.fromkeys(_COUNTS, 0) | {"conv": conv, "audit": [], "turns": None}
                    state |= {"digest": hashlib.sha256(), "any": False, "before": None}
                if edit is None:
                    continue
                state["audit"].append(edit)
                state["cost"] += cost
                if fault is not None:
                    state[fault] += 1
                if edit != "I":
                    # Adjacent before the repair: two rows, whatever was inserted between them.
                    if state["before"] is not None:
                        state["illegal"] += state["before"][:1] + was[:1] not in ("su", "ua", "au")
                    state["before"] = was
                    if turn is not None:
                        first, last, count = state["turns"] or (turn, turn, 1)
                        state["turns"] = (first, turn, count + (turn != last))
                if edit != "D":
                    joint = "\n" if state["any"] else ""
                    state["digest"].update(f"{joint}{role}:{text}".encode())
                    state["any"] = True
            if out:
                yield batch_of()
        if state is not None:
            close()
            yield batch_of()

    fields = [f"{x} long" for x in _COUNTS]
    schema = ", ".join([f"conv_id {conv}", *fields, "audit string", "repaired_sha256 string"])
    return (
        edits.repartition("conv_id")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), "step")
        .mapInArrow(summed, schema)
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in where a checksum of conv_id and turn says so.

    NULLs are one space there. One row in twenty each is dropped, emptied, robbed of its
    ``.!?``, repeated, or becomes the user's; the column ``copies`` says how many rows are left.
    """
    key = F.concat_ws(
        ":", *(F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn"))
    )
    code = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(x), F.lit(" ")) for x in ("role", "text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "")
        .when(code == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )
