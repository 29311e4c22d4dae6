"""Problem 4: one identifier for every group of linked words (connected components).

Two-dimensional grid union-find. Words become 64-bit ids; ids are hashed into ``blocks``
blocks, and an edge goes to the partition of its pair of blocks (numbered bijectively), so
the edges of one hot vertex spread over a whole row of the grid. Each partition runs a local
union-find and sends one parent for each of its vertices; the parents that a vertex has in
the partitions of its row and column are exchanged. A vertex with one parent is settled;
different parents of a vertex become the edges of the next, smaller round. The rounds end
when no vertex has two parents, whatever the size of the graph.

The order that decides which vertex is a root, and the blocks, are hashed anew in each
round, so in a long chain a fixed share of the vertices is settled per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.runtime import Workspace
from lexloom.sources.tables import table

EDGES_PER_PARTITION = 500_000
#: Edges that a task holds before it folds them into its forest.
FOLD_EDGES = 1_000_000


class Forest:
    """Union-find over 64-bit ids, fed with arrays of edges.

    A batch of edges is united by hooking: each root is hung below the least root that an
    edge ties it to, then all paths are compressed, until no edge joins two trees. The root
    of a tree is its vertex of least rank, a hash of id and ``salt``.
    """

    def __init__(self, salt: int) -> None:
        import numpy as np

        self.salt = np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        self.ids = np.zeros(0, np.int64)
        self.roots = np.zeros(0, np.int64)

    def _rank(self, ids):
        import numpy as np

        x = ids.view(np.uint64) ^ self.salt
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))

    def unite(self, a, b) -> None:
        """Add the edges (a[i], b[i])."""
        import numpy as np

        a = np.concatenate([a, self.ids])
        b = np.concatenate([b, self.roots])
        ids = np.unique(np.concatenate([a, b]))
        ids = ids[np.argsort(self._rank(ids), kind="stable")]  # place = rank, ties cannot occur: the hash is a bijection
        order = np.argsort(ids)
        at = ids[order]
        x, y = order[np.searchsorted(at, a)], order[np.searchsorted(at, b)]
        parent = np.arange(len(ids))
        while True:
            x, y = parent[x], parent[y]
            apart = x != y
            if not apart.any():
                break
            x, y = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(parent, y, x)
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
        self.ids, self.roots = ids, ids[parent]


def _local_union_find(salt: int, keep_roots: bool, whole: bool):
    """Arrow function: edges (a, b) to (v, root) rows of local forests.

    ``whole`` makes one forest of the partition, folding edges as they come; otherwise each
    ``FOLD_EDGES`` edges are a forest of their own. Rows (root, root) come only with
    ``keep_roots``. Repeated edges and self links fold together here.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def rows(forest):
            v, root = forest.ids, forest.roots
            if not keep_roots:
                v, root = v[v != root], root[v != root]
            for lo in range(0, len(v), 100_000):
                part = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(v[part]), pa.array(root[part])], names=["v", "root"])

        forest, held, n = Forest(salt), [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
            n += batch.num_rows
            if n >= FOLD_EDGES:
                forest.unite(*(np.concatenate(c) for c in zip(*held)))
                held, n = [], 0
                if not whole:
                    yield from rows(forest)
                    forest = Forest(salt)
        if n:
            forest.unite(*(np.concatenate(c) for c in zip(*held)))
        yield from rows(forest)

    return run


def _blocks(edges: int, per_partition: int) -> int:
    """Blocks whose pairs give partitions of about ``per_partition`` edges, at least 3."""
    want = max(6, -(-edges // per_partition))
    b = 3
    while b * (b + 1) // 2 < want:
        b += 1
    return b


def _grid(edges: DataFrame, round_no: int, blocks: int) -> DataFrame:
    """Edges in the partition of their pair of blocks: pairs x <= y are numbered row by row."""
    p, q = (F.pmod(F.xxhash64(F.lit(round_no), c), F.lit(blocks)) for c in ("a", "b"))
    with_blocks = edges.withColumn("_x", F.least(p, q)).withColumn("_y", F.greatest(p, q))
    number = F.expr(f"cast(_x * {blocks} - _x * (_x - 1) div 2 + (_y - _x) as int)")
    return with_blocks.repartitionById(blocks * (blocks + 1) // 2, number).select("a", "b")


def _exchange(forest: DataFrame) -> DataFrame:
    """Parents of each vertex over its row and column: ``(v, parent, other)``.

    One row per vertex with its least root as ``parent``, and one row without ``v`` for each
    other root. A vertex has at most one row per grid partition, so no window is large.
    """
    w = Window.partitionBy("v").orderBy("root")
    seen = forest.select(
        "v", "root", F.first("root").over(w).alias("parent"), F.lag("root").over(w).alias("before")
    ).where("before is null or before <> root")
    first = F.col("before").isNull()
    return seen.select(
        F.when(first, F.col("v")).alias("v"), "parent", F.when(~first, F.col("root")).alias("other")
    )


def _hot(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Keys with more than ``most`` rows; there are at most ``rows / most`` of them, so they may be broadcast."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(key)


def _follow(layer: DataFrame, later: DataFrame, rows: int, most: int) -> DataFrame:
    """``layer`` with each parent replaced by the parent that a later layer gave it.

    Popular parents are looked up by a broadcast map, so no task gets all their members.
    """
    later = later.select(F.col("v").alias("_v"), F.col("parent").alias("_parent"))

    def look_up(part: DataFrame, side: DataFrame) -> DataFrame:
        return part.join(side, F.col("parent") == F.col("_v"), "left").select("v", F.coalesce("_parent", "parent").alias("parent"))

    if rows <= most:  # then no parent can be popular
        return look_up(layer, later)
    hot = F.broadcast(_hot(layer, "parent", most).withColumnRenamed("parent", "_hot"))
    is_hot = F.col("parent") == F.col("_hot")
    few = F.broadcast(later.join(hot, F.col("_v") == F.col("_hot")).drop("_hot"))
    return look_up(layer.join(hot, is_hot, "left_anti"), later).unionByName(look_up(layer.join(hot, is_hot, "left_semi"), few))


def settle(edges: DataFrame, workspace: Workspace, edges_per_partition: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(v, parent)`` of every vertex of the edges, and the tables it is read from.

    Vertices of one component have one parent.
    """
    layers: list[tuple[DataFrame, int]] = []
    tables: list[DataFrame] = []
    n = edges.count()
    round_no = 0
    while n:
        round_no += 1
        forest = _grid(edges, round_no, _blocks(n, edges_per_partition)).mapInArrow(
            _local_union_find(round_no, keep_roots=True, whole=True), "v long, root long"
        )
        seen = workspace.keep(_exchange(forest), f"round{round_no}")
        tables.append(seen)
        workspace.drop(edges)
        edges = seen.where("other is not null").select(F.col("other").alias("a"), F.col("parent").alias("b"))
        n = edges.count()
        layer = seen.where("v is not null").select("v", "parent")
        layers.append((layer, layer.count()))
    if not layers:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("parent")), [edges]
    # from the last layer back: the parent of a settled vertex is settled in a later layer
    final = layers.pop()[0]
    for layer, rows in reversed(layers):
        final = _follow(layer, final, rows, edges_per_partition)
    return final, tables


def assign_groups(
    pairs: DataFrame,
    left: str,
    right: str,
    workspace: Workspace,
    *,
    edges_per_partition: int = EDGES_PER_PARTITION,
) -> DataFrame:
    """``(word, group_word)`` for each distinct word of the pairs.

    ``group_word`` is the smallest word (UTF-8 byte order) that is linked with ``word``
    directly or through others, itself included. Rows with a null or empty side are
    ignored; repeated rows and self links change nothing, but a word that is only linked
    with itself is a group of its own. An empty input gives an empty result. Two words whose
    ids collide are noticed when the words are listed, and all ids are then hashed anew.
    """
    sides = pairs.select(
        F.col(f"`{left}`").cast("string").alias("x"), F.col(f"`{right}`").cast("string").alias("y")
    ).where("x <> '' and y <> ''")
    attempt = 0
    while True:
        members = _members(sides, attempt, workspace, edges_per_partition)
        if members.where("clash").isEmpty():
            break
        workspace.drop(members)
        attempt += 1
    w = Window.partitionBy("root").orderBy("word")
    least = F.first("word").over(w).alias("group_word")
    if members.count() <= edges_per_partition:  # then no group can be large
        return members.select("word", least)
    hot = workspace.keep(_hot(members, "root", edges_per_partition).withColumnRenamed("root", "_hot"), "hot")
    is_hot = F.col("root") == F.col("_hot")
    few = members.join(F.broadcast(hot), is_hot, "left_semi")
    names = few.groupBy(F.col("root").alias("_root")).agg(F.min("word").alias("group_word"))
    return members.join(F.broadcast(hot), is_hot, "left_anti").select("word", least).unionByName(
        few.join(F.broadcast(names), F.col("root") == F.col("_root")).select("word", "group_word")
    )


def _members(sides: DataFrame, attempt: int, workspace: Workspace, edges_per_partition: int) -> DataFrame:
    """``(word, root, clash)`` of each distinct word; ``clash`` if another word has its id."""

    def number(c: str):
        return F.xxhash64(F.lit(attempt), c)

    pairs = sides.where("x <> y").select(number("x").alias("a"), number("y").alias("b"))
    # fold each input split first: repeats and local chains never reach the network
    folded = pairs.mapInArrow(_local_union_find(0, keep_roots=False, whole=False), "a long, b long")
    parents, tables = settle(workspace.keep(folded, "edges"), workspace, edges_per_partition)
    # one table in place of those of the rounds, before the words are shuffled
    parents = workspace.keep(parents, "parents")
    workspace.drop(*tables)
    words = sides.select(F.explode(F.array("x", "y")).alias("word")).select(number("word").alias("id"), "word")
    named = words.groupBy("id").agg(F.min("word").alias("word"), F.max("word").alias("_last"))
    members = named.join(parents, F.col("id") == F.col("v"), "left").select(
        "word", F.coalesce("parent", "id").alias("root"), (F.col("word") != F.col("_last")).alias("clash")
    )
    kept = workspace.keep(members, "members")
    workspace.drop(parents)
    return kept


def p4_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Each word of ``links`` with the smallest word of its group."""
    return assign_groups(table(spark, data_dir, "links"), "key", "lemma", Workspace(spark, "p4"))
