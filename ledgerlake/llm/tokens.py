"""Ids of whole texts by the tokenizers library, each distinct word encoded once.

The vocabulary's pre-tokenizer never joins what a space or a line feed parts, nor a letter
and a mark such as a comma after it, so a text's ids are those of its parts one after another.
The table of known parts is per worker and of bounded size.
"""

import os
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores

WORD_BPE = "word_bpe_49k.json"
_MOST_PARTS = 400_000
#: Parts go to the library many at a time, this word between them; it is a token by itself.
_BETWEEN = "~"
_AT_ONCE = 200


def vocabulary(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PartEncoder:
    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self._encode = partial(tokenizer.encode_batch_fast, add_special_tokens=False)
        (self._between,) = tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        vocabulary_ = tokenizer.get_vocab()
        self._ends_word = np.zeros(max(vocabulary_.values()) + 1, bool)
        self._ends_word[[i for x, i in vocabulary_.items() if x.endswith("</w>")]] = True
        self._parts = pa.array([], pa.string())  # and, by the same index, of each part:
        self._lengths = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._starts = np.zeros(0, np.int64)
        self._uses = np.zeros(0, np.int64)

    def _forget_rare(self) -> None:
        """Keep the parts that occurred in several steps, at most half of the table."""
        least = max(2, int(np.median(self._uses)) + 1)
        kept = np.flatnonzero(self._uses >= least)
        lengths, starts = self._lengths[kept], self._starts[kept]
        ends = np.cumsum(lengths)
        at = np.repeat(starts - ends + lengths, lengths) + np.arange(int(lengths.sum()))
        self._parts = self._parts.take(pa.array(kept))
        self._ids, self._lengths, self._starts = self._ids[at], lengths, ends - lengths
        self._uses = np.zeros(len(kept), np.int64)

    def _learn(self, parts: list[str]) -> pa.Array:
        """Add parts to the table, in the order that is returned, many of them in one call of the library.

        Words of letters alone go with spaces between: if as many tokens end a word as there
        are words, each word has one of them, its last. Others go with a word between that
        is a token by itself, and those that hold it one by one.
        """
        letters = [x for x in parts if x.isalpha()]
        others = [x for x in parts if not x.isalpha()]
        done: list[list[str]] = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        groups = [letters[k : k + _AT_ONCE] for k in range(0, len(letters), _AT_ONCE)]
        for group, found in zip(groups, self._encode([" ".join(x) for x in groups])):
            own = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self._ends_word[own])
            if len(ends) == len(group):
                done.append(group)
                ids.append(own)
                lengths.append(np.diff(ends, prepend=-1))
            else:
                others += group
        plain = [x for x in others if _BETWEEN not in x]
        groups = [plain[k : k + _AT_ONCE] for k in range(0, len(plain), _AT_ONCE)]
        joined = [f" {_BETWEEN} ".join(x) + f" {_BETWEEN}" for x in groups]
        for group, found in zip(groups, self._encode(joined)):
            own = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(own == self._between)
            done.append(group)
            ids.append(np.delete(own, ends))
            lengths.append(np.diff(ends, prepend=-1) - 1)
        odd = [x for x in others if _BETWEEN in x]
        for part, found in zip(odd, self._encode(odd)):
            done.append([part])
            ids.append(np.array(found.ids, np.uint32))
            lengths.append(np.array([len(found.ids)]))
        counts = np.concatenate([np.zeros(0, np.int64), *lengths])
        starts = len(self._ids) + np.cumsum(counts) - counts
        new = pa.array(list(chain.from_iterable(done)), pa.string())
        self._parts = pa.concat_arrays([self._parts, new])
        self._lengths = np.concatenate([self._lengths, counts])
        self._ids = np.concatenate([self._ids, *ids])
        self._starts = np.concatenate([self._starts, starts])
        self._uses = np.concatenate([self._uses, np.zeros(len(parts), np.int64)])
        return new

    def _index(self, parts: pa.Array) -> np.ndarray:
        """The table's index of each of the parts, which are distinct."""
        if len(self._parts) > _MOST_PARTS:
            self._forget_rare()
        found = pc.index_in(parts, value_set=self._parts)
        out = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if found.null_count:
            first = len(self._parts)
            unknown = parts.filter(pc.is_null(found))
            learned = self._learn(unknown.to_pylist())
            out[out < 0] = first + pc.index_in(unknown, value_set=learned).to_numpy()
        self._uses[out] += 1
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's begin, one entry longer."""
        spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        spaced = pc.replace_substring_regex(spaced, r"(\pL)([.,;:!?])", r"\1 \2")
        lists = pc.split_pattern(spaced, " ")
        parts = lists.flatten().cast(pa.string()).dictionary_encode()
        codes = self._index(parts.dictionary)
        codes = codes[parts.indices.to_numpy(zero_copy_only=False)]
        lengths = self._lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._ids[np.repeat(self._starts[codes] - ends + lengths, lengths) + np.arange(total)]
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], ends])
        return ids, before[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]


@lru_cache(maxsize=4)
def part_encoder(path: str) -> PartEncoder:
    """One encoder per worker process and vocabulary."""
    return PartEncoder(path)
