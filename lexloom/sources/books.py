"""Books: plain text, HTML, FB2, EPUB and their gzip forms, as one text per file."""

from __future__ import annotations

import gzip
import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexloom.functions import rules


def book_text(name: str, data: bytes) -> str:
    """Text of one file by its name; bytes that are not UTF-8 become U+FFFD."""
    low = name.lower()
    if low.endswith(".gz"):
        return book_text(name[:-3], gzip.decompress(data))
    if low.endswith(".epub"):
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            pages = sorted(n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
            return "\n".join(rules.html_text(z.read(n).decode("utf-8", "replace"), book=True) for n in pages)
    text = data.decode("utf-8-sig", "replace")
    return rules.html_text(text, book=True) if low.endswith((".html", ".htm", ".xhtml", ".fb2")) else text


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, text)`` with the file's path as id; one task reads whole files."""

    @F.pandas_udf(StringType())
    def text(names, contents):
        return names.combine(contents, book_text)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("doc_id"), text("path", "content").alias("text"))
