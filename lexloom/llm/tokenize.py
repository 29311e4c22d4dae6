"""Problem 6: token ids of every text by a public vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.bpe_fst import transducer, vocabulary_path
from lexloom.runtime import spread
from lexloom.sources.tables import table


def encode_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Rows ``(id_col, ids array<int>)``, one for each input row.

    A map-only plan: the scan reads two columns, each Arrow batch is encoded by the
    worker's transducer, and nothing is shuffled. Ids carry no special tokens; text that
    spells a special token is ordinary text.

    Null and empty texts give the empty list. Null ids stay null, repeated rows stay
    repeated, texts of any length are encoded whole, an empty table gives an empty table,
    and other columns are not read.
    """
    path = vocabulary or vocabulary_path()
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        t = transducer(path)
        for b in batches:
            if not b.num_rows:
                continue
            packed = [t.encode_bytes(x) if x else b"" for x in b.column(1).to_pylist()]
            ends = np.zeros(len(packed) + 1, dtype=np.int32)
            np.cumsum([len(x) // 4 for x in packed], out=ends[1:])
            values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
            ids = pa.ListArray.from_arrays(pa.array(ends), values)
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["id", "ids"])

    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = spread(slim).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.select(F.col("id").alias(id_col), "ids")


def decode_ids(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """Rows ``(id_col, text)``: the inverse of :func:`encode_texts`.

    A null list gives a null text, an empty list the empty text; bytes that are not UTF-8
    are shown as U+FFFD. An id outside the vocabulary is an error that names it.
    """
    path = vocabulary or vocabulary_path()
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        t = transducer(path)
        for b in batches:
            texts = [None if x is None else t.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    slim = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return slim.mapInArrow(run, f"id {kind}, text string").select(F.col("id").alias(id_col), "text")


def p6_ids(spark: SparkSession, data_dir: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every document by byte_bpe_50k."""
    return encode_texts(table(spark, data_dir, "documents"))


def p6_roundtrip(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents whose decoded ids differ from their text (none are expected)."""
    docs = table(spark, data_dir, "documents")
    back = decode_ids(encode_texts(docs)).withColumnRenamed("text", "decoded")
    same = F.coalesce(F.col("text"), F.lit("")) == F.col("decoded")
    return docs.select("doc_id", "text").join(back, "doc_id").where(~same).select("doc_id")
