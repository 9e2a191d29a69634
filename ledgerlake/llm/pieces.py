"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a node between any two characters and an edge for every piece
that matches there. The search goes from left to right and holds, for each node of the last
``longest piece`` characters, its best edge. As soon as the paths back from all of these
meet in one node, everything before it is settled: its ids are given out and forgotten. So
a text of any length needs a window bounded by the longest piece.

What is best depends on the model's kind, read from the model file:

unigram
    The path of the largest sum of scores.
BPE
    The path that merging gives. That has a local test: tokens are what merging makes of
    a text if and only if each two neighbours are what it makes of the two of them. A
    node then has exactly one edge whose token agrees with the best edge of the node where
    it begins.

No piece crosses a line feed or holds a space after another character, so all paths meet
there, and parts between such places are searched once each and remembered, a bounded number
of them in each worker.

Characters of no piece become the pieces of their UTF-8 bytes. A space is put before a
text that is not empty, as the model asks. NULL and empty texts have no ids. Decoding
joins the pieces, turns their marks into spaces and takes off the first. An empty table gives
no rows. Of ties in score the path is taken that the library takes; repeated rows are encoded
alike.
"""

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import steps

PIECE_BPE = "piece_bpe_32k.model"
_MOST_PARTS = 200_000
_MOST_NEIGHBOURS = 400_000
_SPACE = "▁"
_NONE = -1 << 24  # no token: what is before a text
_UNKNOWN_PENALTY = 10.0
#: Nodes between two looks for a place where all paths meet.
_LOOK = 32


class _Parts(dict):
    """Parts and their ids; a part that is not there is searched for, and then is.

    A full table becomes the old one, from which parts that occur again come back.
    """

    def __init__(self, search: Callable[[str], tuple[int, ...]]):
        self._search = search
        self._old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        if len(self) >= _MOST_PARTS:
            self._old = dict(self)
            self.clear()
        found = self._old.get(part)
        if found is None:
            found = self._search(part)
        self[part] = found
        return found


class PieceCoder:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = proto.SentencePiece
        self.unigram = proto.trainer_spec.model_type == proto.trainer_spec.UNIGRAM
        usual = (kinds.NORMAL, kinds.USER_DEFINED)
        self._ids = {x.piece: i for i, x in enumerate(proto.pieces) if x.type in usual}
        self._scores = [x.score for x in proto.pieces]
        bytes_ = {x.piece: i for i, x in enumerate(proto.pieces) if x.type == kinds.BYTE}
        self._bytes = [bytes_[f"<0x{b:02X}>"] for b in range(256)]
        self._longest = max(map(len, self._ids))
        self._unknown = min(self._scores[i] for i in self._ids.values()) - _UNKNOWN_PENALTY
        self._text = [
            bytes([self._bytes.index(i)])
            if x.type == kinds.BYTE
            else (x.piece.replace(_SPACE, " ").encode() if x.type in usual else b"")
            for i, x in enumerate(proto.pieces)
        ]
        self._prefix = proto.normalizer_spec.add_dummy_prefix
        self._pieces = [x.piece for x in proto.pieces]
        self._tree: dict = {}  # of the pieces read backwards; "" has the id
        for piece, token in self._ids.items():
            node = self._tree
            for letter in reversed(piece):
                node = node.setdefault(letter, {})
            node[""] = token
        self._neighbours: dict[tuple[int, int], bool] = {}
        self._cut = self._pattern()
        self._parts = _Parts(self._ids_of)

    def _pattern(self) -> re.Pattern:
        """Parts between places that no piece crosses.

        Those are around line feeds, before spaces, and between a letter and any mark that
        no piece has after a letter.
        """
        if any("\n" in x or _SPACE in x.lstrip(_SPACE) for x in self._ids):
            return re.compile("(?s:.+)")
        after = {b for x in self._ids for a, b in zip(x, x[1:]) if a.isalpha()}
        marks = "".join(x for x in ".,;:!?)\"" if x not in after)
        word = f"{_SPACE}*[^\\W\\d_]+(?=[{re.escape(marks)}])|" if marks else ""
        return re.compile(f"\n|{word}{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+")

    def merged(self, text: str) -> list[str]:
        """What merging makes of a text: the best pair first, the leftmost of equals."""
        tokens = list(text)
        while True:
            best = None
            for k in range(len(tokens) - 1):
                found = self._ids.get(tokens[k] + tokens[k + 1])
                if found is not None and (best is None or self._scores[found] > best[0]):
                    best = (self._scores[found], k)
            if best is None:
                return tokens
            k = best[1]
            tokens[k : k + 2] = [tokens[k] + tokens[k + 1]]

    def _text_of(self, token: int) -> str:
        return self._pieces[token] if token >= 0 else chr(-1 - token)

    def _agree(self, left: int, right: int) -> bool:
        """Whether merging leaves the two neighbours as they are; remembered, for it recurs."""
        if len(self._neighbours) > _MOST_NEIGHBOURS:
            self._neighbours.clear()
        one, two = self._text_of(left) if left != _NONE else "", self._text_of(right)
        known = self.merged(one + two) == ([one, two] if one else [two])
        self._neighbours[left, right] = known
        return known

    def search(self, text: str) -> Iterator[int]:
        """The tokens of the best path, each given out as soon as it is settled.

        A token is a piece's id, or -1 minus the code point of a character of no piece.
        """
        tree, remembered, unigram = self._tree, self._neighbours, self.unigram
        tokens: list[int] = [_NONE]  # of each node of the window, the best edge's token
        begins: list[int] = [0]  # and the node where it begins
        total = [0.0]  # and for unigrams the path's sum
        first = 0  # the window's first node: everything before it is given out
        for end in range(1, len(text) + 1):
            if unigram:
                best, begin, value = self._largest_sum(text, end, first, total)
                total.append(value)
            else:
                node, start, best = tree, end, None
                while start > first:
                    start -= 1
                    node = node.get(text[start])
                    if node is None:
                        break
                    token = node.get("")
                    if token is not None:
                        left = tokens[start - first]
                        agree = remembered.get((left, token))
                        if agree is None:
                            agree = self._agree(left, token)
                        if agree:  # no other edge does
                            best, begin = token, start
                            break
                if best is None:
                    best, begin = -1 - ord(text[end - 1]), end - 1
            tokens.append(best)
            begins.append(begin)
            if end % _LOOK == 0 or end == len(text):
                meet = end if end == len(text) else self._meeting(begins, first, end)
                settled = []
                node = meet
                while node > first:
                    settled.append(tokens[node - first])
                    node = begins[node - first]
                yield from reversed(settled)
                del tokens[: meet - first], begins[: meet - first], total[: meet - first]
                first = meet

    def _largest_sum(
        self, text: str, end: int, first: int, total: list[float]
    ) -> tuple[int, int, float]:
        """Token, begin and sum of the best path to a node, the longest token of equals."""
        best = (-1 - ord(text[end - 1]), end - 1, total[end - 1 - first] + self._unknown)
        node, start = self._tree, end
        while start > first:
            start -= 1
            node = node.get(text[start])
            if node is None:
                break
            token = node.get("")
            if token is not None:
                value = total[start - first] + self._scores[token]
                if value >= best[2]:
                    best = (token, start, value)
        return best

    def _meeting(self, begins: list[int], first: int, last: int) -> int:
        """The node in which the paths back from all open nodes meet."""
        open_ = set(range(max(first, last - self._longest + 1), last + 1))
        while len(open_) > 1:
            top = max(open_)
            open_.remove(top)
            open_.add(begins[top - first])
        return open_.pop()

    def _ids_of(self, part: str) -> tuple[int, ...]:
        found: list[int] = []
        for token in self.search(part):
            if token >= 0:
                found.append(token)
            else:
                found += [self._bytes[b] for b in chr(-1 - token).encode()]
        return tuple(found)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = (" " + text if self._prefix else text).replace(" ", _SPACE)
        return list(chain.from_iterable(map(self._parts.__getitem__, self._cut.findall(text))))

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self._text.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ") if self._prefix else text


@lru_cache(maxsize=2)
def piece_coder(path: str) -> PieceCoder:
    """One coder per worker process and model file."""
    with open(path, "rb") as model:
        return PieceCoder(model.read())


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of each row of (doc_id, text); ids as little-endian 32-bit integers.

    Rows are independent: NULL and repeated doc_ids are rows like others, and other
    columns play no part.
    """

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for step in steps(batches, "text"):
            ids = [
                np.array(coder.encode(x), "<u4").tobytes() for x in step.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text) of each row of (doc_id, ids)."""

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([coder.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]),
                ],
                names=["doc_id", "n_tokens", "ids_crc32", "text"],
            )

    return encoded.mapInArrow(
        decoded, "doc_id long, n_tokens long, ids_crc32 long, text string"
    )
