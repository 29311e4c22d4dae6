"""Encyclopedia XML dumps and prepared pages."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexloom.functions import native, rules

PAGE = (
    "title string, ns bigint, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string,_bytes:bigint>>"
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(title, ns, redirect, text)`` of an XML dump, one ``page`` element per row."""
    raw = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    return raw.select("title", "ns", F.col("redirect._title").alias("redirect"), F.col("revision.text._VALUE").alias("text"))


def prepare_candidates(pages: DataFrame, longest: int = 65536, domain_only: bool = False) -> DataFrame:
    """``(title, categories, lead)`` of articles that have text; redirects are left out.

    ``domain_only`` keeps pages with a subject category.

    The lead ends at the first heading. Of repeated titles the greatest lead is taken, so
    the result does not depend on the number of partitions.
    """
    cats = F.regexp_extract_all("text", F.lit(r"(?iu)\[\[\s*(?:категория|category)\s*:\s*([^\]|]+)"), F.lit(1))
    lead = F.substring(F.split("text", r"(?m)^={2,}", 2)[0], 1, longest)
    rows = pages.where("ns = 0 and redirect is null and text is not null").select("title", F.array_join(cats, "\n").alias("categories"), lead.alias("lead"))
    if domain_only:
        from lexloom.operators.layers import page_tests

        rows = native.keep_rows(rows, page_tests(F.col("title"), F.col("categories"))["domain"])
    return rows.groupBy("title").agg(F.max(F.struct("lead", "categories")).alias("r")).select("title", "r.categories", "r.lead")


def inflate(c):
    """Text of a zlib stream; null for null, empty and broken streams."""

    @F.pandas_udf(StringType())
    def run(s):
        def one(x):
            try:
                return zlib.decompress(x).decode("utf-8", "replace") if x else None
            except zlib.error:
                return None

        return s.map(one)

    return run(c)


def lead_definitions(pages: DataFrame) -> DataFrame:
    """``(title, base_title, definition)`` of pages whose lead defines them."""
    d = rules.lead_rule(F.col("title"), F.col("lead"))
    return pages.select("title", native.base_title(F.col("title")).alias("base_title"), d.alias("definition")).where("definition <> ''")
