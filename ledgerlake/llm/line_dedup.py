"""Removal of repeated runs of lines, by content-defined chunks; DataFrame operations only.

A line goes if it is in a run of two or more lines that also stands earlier, by doc_id, row key
and place, and not overlapping it. The first place of every run stays, and so do single lines.

Chunks find most of it. A text's lines get hashes, and a rolling hash over each line and the one
before it says where a chunk ends, so that the same lines are cut at the same places wherever
they stand: an insertion shifts what follows but moves no later boundary. A chunk of two or
more lines that also occurs earlier, byte by byte, is removed as a whole. A run is seldom cut
exactly at its edges, and short ones fall within a chunk of other lines. So the pairs of
neighbouring lines that are not within a removed chunk are compared too, byte by byte: they extend
each match to the edges of its run, and are the runs that no chunk holds. Pairs within a removed
chunk are left out, for they stand earlier where the chunk does, and can't be anything's first.

Every row is kept, with what is left of its text, lines joined by line feeds. A NULL text
stays NULL and has no lines; an empty text has one. Rows that repeat both doc_id and text
share one fate: they count as one place. NULL doc_ids come first. Other columns are carried
along, whatever their names. An empty table gives no rows. Very long texts are split whole.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import row_key, written

#: One line in so many ends a chunk.
EVERY = 3
_BASE = 31


def _line_value(line: Column) -> Column:
    """A line's hash as a number of 32 bits."""
    return F.conv(F.left(F.md5(line), F.lit(8)), 16, 10).cast("long")


def _column(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``inline`` makes an array a column of its own, so that no later expression computes it
    anew for every element."""
    return rows.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _with_chunks(rows: DataFrame, every: int) -> DataFrame:
    """The rows with ``spans``, the chunks of ``lines`` as an array of (at, n)."""
    rows = _column(rows, "_values", F.transform("lines", _line_value))
    before = F.concat(F.array(F.lit(0).cast("long")), F.col("_values"))
    cuts = F.zip_with(
        F.col("_values"),
        F.slice(before, 1, F.size("_values")),
        lambda own, earlier: (earlier * _BASE + own) % every == 0,
    )
    ends = F.filter(F.transform(cuts, lambda cut, i: F.when(cut, i)), lambda i: i.isNotNull())
    rows = _column(rows, "_ends", F.array_distinct(F.concat(ends, F.array(F.size("lines") - 1))))
    starts = F.concat(F.array(F.lit(0)), F.transform("_ends", lambda i: i + 1))
    spans = F.zip_with(
        F.slice(starts, 1, F.size("_ends")),
        F.col("_ends"),
        lambda start, end: F.struct(start.alias("at"), (end - start + 1).alias("n")),
    )
    return _column(rows, "spans", spans).drop("_values", "_ends")


def _pieces(rows: DataFrame) -> DataFrame:
    """(row_key, piece) of all chunks of two or more lines and of all pairs of lines.

    A piece is (at, n, chunk, hash).
    """
    chunks = F.transform(
        F.filter("spans", lambda x: x["n"] > 1),
        lambda x: F.struct(
            x["at"].alias("at"),
            x["n"].alias("n"),
            F.lit(True).alias("chunk"),
            F.xxhash64(F.slice("lines", x["at"] + 1, x["n"])).alias("hash"),
        ),
    )
    pairs = F.zip_with(
        F.slice("lines", 1, F.size("lines") - 1),
        F.slice("lines", 2, F.size("lines") - 1),
        lambda one, two: F.xxhash64(one, two),
    )
    pairs = F.transform(
        pairs,
        lambda x, i: F.struct(
            i.alias("at"), F.lit(2).alias("n"), F.lit(False).alias("chunk"), x.alias("hash")
        ),
    )
    return rows.select("row_key", F.inline(F.concat(chunks, pairs)))


def remove_repeated_chunks(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``row`` (the input's columns), ``kept`` (the text that is left), n_lines, n_removed.

    Hashes of pieces travel first, counted map-side. Only pieces whose hash repeats travel as
    text, where they are compared, and only places travel back. Tables are written before the
    joins by hash and text, so that adaptive execution can split a hot one.
    """
    keyed = docs.select(F.struct("*").alias("row")).select("*", "row.doc_id", "row.text")
    keyed = keyed.select("row", "doc_id", "text", row_key())
    source = keyed.where("text is not null").select("row_key", "doc_id", "text")
    lines = F.split("text", "\n", -1)
    placed = _pieces(_with_chunks(_column(source.select("row_key", "text"), "lines", lines), every))
    shared = placed.groupBy("chunk", "hash").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(shared.select("chunk", "hash"), "shared_pieces")
    wanted = placed.join(shared, ["chunk", "hash"]).groupBy("row_key")
    wanted = wanted.agg(F.collect_set(F.struct("at", "n", "chunk")).alias("wanted"))
    rows = _column(source.join(wanted, "row_key"), "lines", lines)
    bodies = F.transform(
        "wanted",
        lambda x: F.struct(
            x["at"].alias("at"),
            x["n"].alias("n"),
            x["chunk"].alias("chunk"),
            F.array_join(F.slice("lines", x["at"] + 1, x["n"]), "\n").alias("body"),
        ),
    )
    found = written(rows.select("row_key", "doc_id", F.inline(bodies)), "pieces")
    chunks = _repeated(found.where("chunk"), F.lit(1), "first_chunks").groupBy("row_key")
    chunks = chunks.agg(
        F.collect_set(F.struct("at", (F.col("at") + F.col("n") - 1).alias("till"))).alias("chunks")
    )
    chunks = written(chunks, "removed_chunks")
    within = F.exists("chunks", lambda x: (F.col("at") >= x["at"]) & (F.col("at") < x["till"]))
    pairs = found.where("not chunk").join(chunks, "row_key", "left")
    pairs = pairs.where(~F.coalesce(within, F.lit(False))).drop("chunks")
    # Overlapping pairs of one text are one run of a repeated line, which needs two lines more.
    pairs = _repeated(pairs, F.lit(2), "first_pairs").groupBy("row_key")
    removed = chunks.join(pairs.agg(F.collect_set("at").alias("pairs")), "row_key", "full")
    rows = keyed.join(removed, "row_key", "left")
    return _without(_column(rows, "lines", lines))


def _repeated(pieces: DataFrame, apart: Column, name: str) -> DataFrame:
    """Pieces whose text also stands earlier, in another row or at least ``apart`` before it."""
    place = F.struct("doc_id", "row_key", "at")
    first = pieces.groupBy("body").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = written(first.where("not first <=> last").select("body", "first"), name)
    other = (F.col("row_key") != F.col("first.row_key")) | (F.col("at") >= F.col("first.at") + apart)
    return pieces.join(first, "body").where(other)


def _without(rows: DataFrame) -> DataFrame:
    """What is left of the lines without ``chunks`` and ``pairs``."""
    runs = F.flatten(F.transform("chunks", lambda x: F.sequence(x["at"], x["till"])))
    none = F.array().cast("array<int>")
    gone = F.concat(
        F.coalesce(runs, none),
        F.coalesce("pairs", none),
        F.coalesce(F.transform("pairs", lambda i: i + 1), none),
    )
    every_one = F.sequence(F.lit(0), F.size("lines") - 1)
    any_gone = F.col("chunks").isNotNull() | F.col("pairs").isNotNull()
    rows = _column(rows, "left", F.when(any_gone, F.array_except(every_one, gone)))
    body = F.array_join(F.transform("left", lambda i: F.col("lines")[i]), "\n")
    n_lines = F.when(F.col("text").isNotNull(), F.size("lines")).otherwise(0).cast("long")
    n_removed = F.when(F.col("left").isNotNull(), F.size("lines") - F.size("left")).otherwise(0)
    return rows.select(
        "row",
        F.when(F.col("left").isNull(), F.col("text")).otherwise(body).alias("kept"),
        n_lines.alias("n_lines"),
        n_removed.cast("long").alias("n_removed"),
    )


def remove_repeated_runs(docs: DataFrame) -> DataFrame:
    """As :func:`remove_repeated_chunks`, by pairs of lines alone: a run that stands earlier is made of
    pairs of neighbours that do.

    All pairs travel as hashes; those whose hash repeats are compared byte by byte.
    """

    def column(rows: DataFrame, name: str, value: Column) -> DataFrame:
        return rows.select("*", F.inline(F.array(F.struct(value.alias(name)))))

    keyed = docs.select(F.struct("*").alias("row"), row_key())
    source = keyed.where("row.text is not null").select(
        "row_key", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")
    )
    lines = F.split("text", "\n", -1)
    rows = column(source.select("row_key", "text"), "lines", lines)
    hashes = F.zip_with(
        F.slice("lines", 1, F.size("lines") - 1),
        F.slice("lines", 2, F.size("lines") - 1),
        lambda one, two: F.xxhash64(one, two),
    )
    placed = rows.select("row_key", F.posexplode(hashes).alias("at", "hash"))
    shared = placed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    # Written, as are both sides of the join by pair: joins can split a hot pair.
    shared = written(shared, "shared_pairs")
    wanted = placed.join(shared, "hash").groupBy("row_key")
    wanted = wanted.agg(F.collect_set("at").alias("wanted"))
    rows = column(source.join(wanted, "row_key"), "lines", lines)
    pairs = F.transform(
        "wanted",
        lambda i: F.struct(
            i.alias("at"), F.concat(F.col("lines")[i], F.lit("\n"), F.col("lines")[i + 1]).alias("pair")
        ),
    )
    found = written(rows.select("row_key", "doc_id", F.inline(pairs)), "pairs")
    place = F.struct("doc_id", "row_key", "at")
    first = found.groupBy("pair").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = written(first.where("not first <=> last").select("pair", "first"), "first_pairs")
    removed = (
        found.join(first, "pair")
        .where("row_key != first.row_key or at > first.at + 1")
        .groupBy("row_key")
        .agg(F.collect_set("at").alias("removed"))
    )
    rows = keyed.join(removed, "row_key", "left").select("*", F.col("row.text").alias("text"))
    rows = column(rows, "lines", lines)
    gone = F.array_union("removed", F.transform("removed", lambda i: i + 1))
    every_one = F.sequence(F.lit(0), F.size("lines") - 1)
    rows = column(rows, "left", F.when(F.col("removed").isNotNull(), F.array_except(every_one, gone)))
    body = F.array_join(F.transform("left", lambda i: F.col("lines")[i]), "\n")
    n_lines = F.when(F.col("text").isNotNull(), F.size("lines")).otherwise(0).cast("long")
    n_removed = F.when(F.col("left").isNotNull(), F.size("lines") - F.size("left")).otherwise(0)
    return rows.select(
        "row",
        F.when(F.col("left").isNull(), F.col("text")).otherwise(body).alias("kept"),
        n_lines.alias("n_lines"),
        n_removed.cast("long").alias("n_removed"),
    )


#: Repeated runs in SQL over ``documents``, by pairs of neighbouring lines.
SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM {documents}),
pairs AS (
  SELECT doc_id, i, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS pair
  FROM lines),
ranked AS (
  SELECT doc_id, i, first_value(doc_id) OVER earlier AS first_doc, first_value(i) OVER earlier AS first_i
  FROM pairs WHERE pair IS NOT NULL WINDOW earlier AS (PARTITION BY pair ORDER BY doc_id, i)),
gone AS (
  SELECT DISTINCT doc_id, unnest([i, i + 1]) AS i FROM ranked
  WHERE doc_id <> first_doc OR i > first_i + 1),
kept AS (
  SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(g.i)::BIGINT AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS kept
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, {columns}
FROM {documents} d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
