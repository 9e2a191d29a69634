"""Connected components of links that no single machine needs to hold."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written


class Forest:
    """Union-find with path halving; the smallest member stands for its group."""

    def __init__(self):
        self._up: dict[int, int] = {}

    def root(self, node: int) -> int:
        up = self._up
        while (above := up.setdefault(node, node)) != node:
            up[node] = up[above]
            node = up[node]
        return node

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self._up[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        return [(node, root) for node in self._up if (root := self.root(node)) != node]


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars around each group's smallest node."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(*(batch.column(x).to_pylist() for x in "ab")):
            forest.join(a, b)
    if found := forest.stars():
        columns = [pa.array(x, pa.int64()) for x in zip(*found)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


#: Links that one task unites; more of them are first brought closer by rounds over all.
TASK_LINKS = 200_000


def _toward_smallest(links: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours (only the larger ones, or only the smaller) linked to its smallest."""
    both = links.union(links.select("b", "a"))
    if not larger_only:
        both = both.where("a > b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    linked = both.join(least, "a").where("b > a" if larger_only else "b <= a")
    moved = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger_only:
        moved = moved.union(least.select("a", "least"))
    return moved.where("a > b").distinct()


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being its component's smallest node.

    Each round unites the links of each partition, which leaves a forest of each. Forests
    that fit one task, some ten megabytes, are united there. Others are brought closer: every
    node's larger neighbours and then its smaller ones are pointed at the smallest, which
    keeps the components and, repeated, leaves one star for each. A node with very many
    links is counted map-side, and its links are split by the adaptive join. Rounds end
    when the forests fit or nothing changes.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = links.where("a > b").mapInArrow(_united, "a long, b long")
    mark = None
    while True:
        links = written(links, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] <= task_links:
            links = written(links.coalesce(1).mapInArrow(_united, "a long, b long"), "stars")
        if now[0] <= task_links or now == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct()
            )
        mark = now
        links = _toward_smallest(_toward_smallest(links, True), False)
