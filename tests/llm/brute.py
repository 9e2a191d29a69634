"""Plain versions of what the operators compute, and documents that are odd in every way."""

import re
from collections import Counter
from itertools import pairwise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PASSAGE = " ".join(f"passage{k}" for k in range(60))
STORY = " ".join(f"word{k * k % 97}x{k}" for k in range(120))
LONG = " ".join(f"w{k % 1009}-{k % 31}" for k in range(30_000))
TEXTS = [
    (1, f"Before this. {PASSAGE} And after."),
    (2, f"Elsewhere,\tit says\n{PASSAGE}\nor so."),
    (3, STORY),
    (4, STORY),
    (5, STORY.replace("word1x1 ", "another ")),
    (6, None),
    (7, ""),
    (8, " \t\n"),
    (9, "one two"),
    (10, "ONE two"),
    (11, LONG),
    (12, "ha " * 200),
    (13, "été naïve — 日本語 \U0001d518 <|endoftext|> a▁b"),
    (14, "line one\nline two\nline three\nline four\nline five\nline six"),
    (15, "head\nline one\nline two\nline three\nline four\nline five\nline six\ntail"),
    (16, f"{STORY} {PASSAGE}"),
    (17, "solo"),
    (17, "solo"),
    (18, "same id, one text"),
    (18, "same id, other text"),
    (None, "no id"),
    (None, None),
]
#: Further columns, named as the operators name theirs.
EXTRA = (
    "row_key string, row int, class int, component int, kept int, spans int, pack int, chunks int, "
    "removed int, node int, part int, range int, extra int, ids int, lang string, source string, "
    "n_chars long"
)


def odd_documents(spark, rows=None):
    """The rows (doc_id, text) with the further columns, over several partitions."""
    rows = TEXTS if rows is None else rows
    n = EXTRA.count(",") + 1
    full = [(doc, text, "k", *([7] * (n - 4)), "en", "s", -1) for doc, text in rows]
    frame = spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}")
    return frame.repartition(3)


def repeated_words(texts, window):
    """Of each text: its words, and those left of it."""
    words = [WORD.findall(x or "") for x in texts]
    seen = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((w, [x for x, y in zip(w, gone) if not y]))
    return out


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def similar(a, b):
    common = len(a & b)
    return bool(a) and 100 * common >= 75 * (len(a) + len(b) - common)


def groups(sets):
    """For each set the index of the first one it is connected with."""
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if similar(a, sets[j]):
                one, two = root(i), root(j)
                up[max(one, two)] = min(one, two)
    return [root(i) for i in range(len(sets))]


def line_chunks(text, value, every):
    """Chunks of lines; ``value`` gives a line's number."""
    lines = text.split("\n")
    numbers = [0, *map(value, lines)]
    chunks, chunk = [], []
    for line, (before, own) in zip(lines, pairwise(numbers)):
        chunk.append(line)
        if (before * 31 + own) % every == 0:
            chunks.append(chunk)
            chunk = []
    return [*chunks, chunk] if chunk else chunks


def without_runs(rows):
    """All runs of two or more lines, looked up among all earlier ones of their length."""
    texts = {row: row[1].split("\n") for row in dict.fromkeys(rows) if row[1] is not None}
    order = sorted(texts, key=lambda row: (row[0] is not None, row[0] or 0))
    first, gone = {}, {row: set() for row in texts}
    for row in order:
        lines = texts[row]
        for at in range(len(lines)):
            for till in range(at + 2, len(lines) + 1):
                own, start, end = first.setdefault(tuple(lines[at:till]), (row, at, till))
                if own != row or at >= end:
                    gone[row].update(range(at, till))
    out = Counter()
    for row in rows:
        lines, lost = texts.get(row, []), gone.get(row, ())
        kept = None if row[1] is None else "\n".join(x for k, x in enumerate(lines) if k not in lost)
        out[row[0], kept, len(lines), len(lost)] += 1
    return out
