"""Problem 3: records that differ only in formatting, by external sort and an adjacent scan.

Canonical records are range-partitioned and sorted (Spark's external sort spills), then
each partition is scanned once: neighbours with equal full keys form a run. The sort key
ends with the arrival number, so a group that holds a third of all rows is cut over many
partitions instead of filling one; runs that continue across partition borders are joined
up from one small border row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.runtime import Workspace, shuffle_partitions
from lexloom.sources.tables import table

#: Unicode punctuation, white space, controls and characters without width.
_NO_DIFFERENCE = r"[\p{P}\p{Z}\p{Cc}\p{Cf}\s]+"


def canonical_field(c: Column) -> Column:
    """A field without white space, punctuation and letter case (native expressions only)."""
    return F.regexp_replace(F.lower(F.upper(c)), _NO_DIFFERENCE, "")


def canonical_key(fields: list[Column]) -> Column:
    """The full key of a record: its canonical fields in sorted order, apart by U+0000."""
    return F.array_join(F.sort_array(F.array(*[canonical_field(f) for f in fields])), "\0")


def find_runs(
    df: DataFrame, fields: list[str], order_col: str, workspace: Workspace, partitions: int | None = None
) -> DataFrame:
    """``(seq, keep_seq)`` for each record: its order value and the smallest of its group.

    Rows with a null or blank field, or a null order value, take no part. Fully equal rows
    count as copies as well. Order values are expected to be unique; rows that share one
    stay separate rows.
    """
    slim = df.select(
        *[F.col(f"`{f}`").cast("string").alias(f"f{i}") for i, f in enumerate(fields)],
        F.col(f"`{order_col}`").cast("long").alias("seq"),
    ).where("seq is not null")
    for i in range(len(fields)):
        slim = slim.where(F.col(f"f{i}").rlike(r"[^\p{Z}\p{Cc}\s]"))
    keyed = slim.select(canonical_key([F.col(f"f{i}") for i in range(len(fields))]).alias("key"), "seq")
    n = partitions or shuffle_partitions(df.sparkSession)
    ordered = keyed.repartitionByRange(n, "key", "seq").sortWithinPartitions("key", "seq")
    scanned = workspace.keep(ordered.mapInArrow(_scan_partition, _SCAN_SCHEMA), "runs")
    # at most one border row per partition, so the broadcast side has at most n rows
    borders = scanned.where("border").groupBy("key").agg(F.min("keep_seq").alias("border_keep"))
    joined = scanned.where("not border").join(F.broadcast(borders), "key", "left")
    keep = F.least("keep_seq", "border_keep")  # least() passes over nulls
    return joined.select("seq", keep.alias("keep_seq"))


_SCAN_SCHEMA = "key string, seq long, keep_seq long, border boolean"


def _scan_partition(batches):
    """Scan a sorted partition, comparing full neighbouring keys over batch borders too.

    Each row gets the first order value of its run. Only rows of the partition's first run
    carry their key, because only that run can have begun in an earlier partition; a border
    row at the end tells the key and the first order value of the last run.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    last_key = last_keep = None
    in_first = True
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        keys, seqs = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
        new = np.ones(n, dtype=bool)
        if n > 1:
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        goes_on = last_key is not None and keys[0].as_py() == last_key
        new[0] = not goes_on
        run = np.cumsum(new)
        heads = np.concatenate([[last_keep if goes_on else 0], seqs[new]]).astype(np.int64)
        keeps = heads[run]
        if in_first:
            border_run = 0 if goes_on else (1 if last_key is None else -1)
            first = run == border_run
            in_first = bool(first[-1])
        else:
            first = np.zeros(n, dtype=bool)
        shown = pc.if_else(pa.array(first), keys, pa.scalar(None, keys.type))
        yield pa.RecordBatch.from_arrays(
            [shown, b.column(1), pa.array(keeps), pa.array(np.zeros(n, dtype=bool))],
            names=["key", "seq", "keep_seq", "border"],
        )
        last_key, last_keep = keys[n - 1].as_py(), int(keeps[-1])
    if last_key is not None:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([last_key], pa.string()),
                pa.array([None], pa.int64()),
                pa.array([last_keep], pa.int64()),
                pa.array([True]),
            ],
            names=["key", "seq", "keep_seq", "border"],
        )


def collapse_copies(
    df: DataFrame, fields: list[str], order_col: str, workspace: Workspace, partitions: int | None = None
) -> DataFrame:
    """One row per group: ``fields`` of the representative, its order value and ``copies``.

    Counts are pre-aggregated before their shuffle, so a hot group is one row per task.
    """
    runs = find_runs(df, fields, order_col, workspace, partitions)
    counts = runs.groupBy("keep_seq").agg(F.count(F.lit(1)).alias("copies"))
    rows = df.select(F.col(f"`{order_col}`").cast("long").alias("keep_seq"), *[F.col(f"`{f}`") for f in fields])
    return rows.join(counts, "keep_seq")


def p3_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Copies of senses: the record kept and each other record of its group."""
    runs = find_runs(table(spark, data_dir, "senses"), ["lemma", "definition"], "seq", Workspace(spark, "p3"))
    return runs.where("keep_seq <> seq").select("keep_seq", F.col("seq").alias("dup_seq"))


def p3_collapsed(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every distinct sense once, with its number of copies."""
    out = collapse_copies(table(spark, data_dir, "senses"), ["lemma", "definition"], "seq", Workspace(spark, "p3c"))
    return out.select(F.col("keep_seq").alias("seq"), "lemma", "definition", "copies")


_SQL_KEY = """
with s as (
  select seq, lemma, definition,
         regexp_replace(lower(upper(lemma)), '[\\p{P}\\p{Z}\\p{Cc}\\p{Cf}\\s]+', '', 'g') as a,
         regexp_replace(lower(upper(definition)), '[\\p{P}\\p{Z}\\p{Cc}\\p{Cf}\\s]+', '', 'g') as b
  from senses
  where regexp_matches(lemma, '[^\\p{Z}\\p{Cc}\\s]') and regexp_matches(definition, '[^\\p{Z}\\p{Cc}\\s]')
    and seq is not null
), g as (
  select seq, lemma, definition,
         min(seq) over w as keep_seq, count(*) over w as copies
  from s window w as (partition by least(a, b), greatest(a, b))
)
"""

SQL = {
    "p3_found": _SQL_KEY + "select keep_seq, seq as dup_seq from g where seq <> keep_seq",
    "p3_collapsed": _SQL_KEY + "select seq, lemma, definition, copies from g where seq = keep_seq",
}
