"""Binary dictionary bundle (.ifo .idx .dict): laid out and packed by the executors, joined by the file system.

Each task packs the bytes of its range of bodies or keys into one part file of the shared
folder; the parts, in order, are the file. Only their names and sizes reach the driver, which
copies them stream by stream and never holds their content.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import articles, graph, leaks
from lexloom.runtime import Workspace

MAX_KEY_BYTES = 255
_LIMIT = 0xFFFFFFFF


def index_records(senses: DataFrame, links: DataFrame, overrides: DataFrame | None, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """(bodies, index): ``bodies(place, body, offset, size)`` and ``index(key, offset, size)``.

    Bodies are laid out as articles by lemma, then override texts, then joint bodies of keys
    with several lemmas (one per set of lemmas). Keys over 255 bytes get no index entry, but
    their body is written. An override hides the links of its key.
    """
    art = workspace.keep(articles.build_articles(senses), "articles")
    edges = graph.clean_edges(links).join(art.select("lemma"), "lemma", "left_semi")
    groups = edges.groupBy("key").agg(F.sort_array(F.collect_set("lemma")).alias("ls"))
    if overrides is None:
        overrides = art.sparkSession.createDataFrame([], "key string, definition string")
    groups = workspace.keep(groups.join(overrides.select("key"), "key", "left_anti"), "groups")
    several = groups.where(F.size("ls") > 1).select("ls").distinct()
    joint = (
        several.select("ls", F.posexplode("ls").alias("i", "lemma"))
        .join(art, "lemma")
        .groupBy("ls")
        .agg(F.sort_array(F.collect_list(F.struct("i", "article"))).alias("parts"))
        .select(F.array_join("ls", "\0").alias("name"), F.array_join(F.transform("parts", lambda p: p["article"]), "\n").alias("body"))
    )
    bodies = (
        art.select(F.lit(0).alias("class"), F.col("lemma").alias("name"), F.col("article").alias("body"))
        .unionByName(overrides.select(F.lit(1).alias("class"), F.col("definition").alias("name"), F.col("definition").alias("body")).distinct())
        .unionByName(joint.select(F.lit(2).alias("class"), "name", "body"))
        .withColumn("place", F.concat(F.col("class").cast("string"), F.lit("\1"), F.col("name")))
    )
    placed = workspace.keep(articles.with_offsets(bodies, "place", F.octet_length("body").cast("long")), "bodies")
    want = groups.select("key", F.concat(F.when(F.size("ls") > 1, "2").otherwise("0"), F.lit("\1"), F.array_join("ls", "\0")).alias("place"))
    want = want.unionByName(overrides.select("key", F.concat(F.lit("1\1"), F.col("definition")).alias("place")))
    index = want.where(F.octet_length("key") <= MAX_KEY_BYTES).join(placed.select("place", "offset", "size"), "place")
    return placed.select("place", "body", "offset", "size"), index.select("key", "offset", "size")


def _pack_parts(ordered: DataFrame, record, workspace: Workspace, name: str) -> tuple[DataFrame, int]:
    """Rows of each partition, in its order, packed to one binary row ``(part, data)``; and the number of records."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            if cols and cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols[0][0]], pa.int32()), pa.array([b"".join(record(*r) for r in zip(*cols[1:]))], pa.binary()), pa.array([len(cols[0])], pa.int64())],
                    names=["part", "data", "n"],
                )

    packed = ordered.select(F.spark_partition_id().alias("_p"), *ordered.columns).mapInArrow(run, "part int, data binary, n long")
    kept = workspace.keep(packed.withColumn("place", F.monotonically_increasing_id()), name)
    return kept, kept.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _join_parts(parts: DataFrame, path: str) -> int:
    """Stream the packed blocks, in order, into one file; returns its size. One block (an Arrow batch) is held at a time."""
    spark = parts.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out, size = fs.create(target, True), 0
    try:
        for r in parts.orderBy("part", "place").select("data").toLocalIterator():
            out.write(bytearray(r["data"]))
            size += len(r["data"])
    finally:
        out.close()
    return size


def _body(body: str) -> bytes:
    return body.encode("utf-8")


def _entry(key: str, offset: int, size: int) -> bytes:
    if offset > _LIMIT or size > _LIMIT:
        raise ValueError("the format's 32-bit limit is exceeded")
    return key.encode("utf-8") + b"\0" + struct.pack(">II", offset, size)


def write_bundle(bodies: DataFrame, index: DataFrame, base: str, title: str) -> dict[str, int]:
    """Write the three files (a path of any Hadoop file system). Records are packed in parallel, in global order."""
    spark = bodies.sparkSession
    ws = Workspace(spark, "bundle")
    d, articles_n = _pack_parts(bodies.select("body", "offset").orderBy("offset").select("body"), _body, ws, "dict")
    i, count = _pack_parts(index.select("key", "offset", "size").orderBy("key"), _entry, ws, "idx")
    dict_bytes, idx_bytes = _join_parts(d, f"{base}.dict"), _join_parts(i, f"{base}.idx")
    ws.drop(d, i)
    info = (
        "StarDict's dict ifo file\nversion=2.4.2\n"
        f"wordcount={count}\nidxfilesize={idx_bytes}\nbookname={title}\nsametypesequence=m\n"
    )
    _write_text(spark, f"{base}.ifo", info)
    return {"wordcount": count, "idx_bytes": idx_bytes, "dict_bytes": dict_bytes, "bodies": articles_n}


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_info(text: str) -> dict[str, str]:
    """``key=value`` lines of an .ifo file."""
    return dict(line.split("=", 1) for line in text.splitlines() if "=" in line)


def parse_index(data: bytes, offset_bits: int = 32, strict: bool = True) -> list[tuple[str, int, int]]:
    """(key, offset, size) records; a broken record is an error, or with ``strict=False`` skipped (a cut tail ends the list)."""
    form = struct.Struct(">QI" if offset_bits == 64 else ">II")
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\0", at)
        if end < 0 or end + 1 + form.size > len(data):
            if not strict:
                break
            raise ValueError("the index is broken")
        offset, size = form.unpack_from(data, end + 1)
        try:
            out.append((data[at:end].decode("utf-8"), offset, size))
        except UnicodeDecodeError:
            if strict:
                raise
        at = end + 1 + form.size
    return out


def parse_synonyms(data: bytes | None) -> list[tuple[str, int]]:
    """(alias, index number) records; an unfinished record at the end is ignored."""
    out, at = [], 0
    while data and (end := data.find(b"\0", at)) >= 0 and end + 5 <= len(data):
        out.append((data[at:end].decode("utf-8", "replace"), struct.unpack_from(">I", data, end + 1)[0]))
        at = end + 5
    return out


def validate(spark: SparkSession, base: str, strict: bool = False) -> dict[str, int]:
    """Check counts, sizes, byte order and pointer ranges of a bundle; the first fault is an error.

    ``strict`` also reads each article once and rejects lines that are no meaning.

    Keys and articles are read as DataFrames; order and ranges are checked by the executors.
    """
    from lexloom.sources.stardict import file_size, read_index, read_text, resolve

    info = read_info(read_text(spark, f"{base}.ifo"))
    index = read_index(spark, base)
    size = file_size(spark, f"{base}.dict")
    c = index.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("offset", "size").alias("a"),
        F.count_if((F.octet_length("word") == 0) | (F.octet_length("word") > MAX_KEY_BYTES)).alias("bad_length"),
        F.count_if((F.col("size") == 0) | (F.col("offset") + F.col("size") > size)).alias("outside"),
        F.count_if("unordered").alias("unordered"),
    ).first()
    for fault, text in (("bad_length", "a key has a bad length"), ("outside", "a pointer lies outside the dictionary"), ("unordered", "keys are out of order")):
        if c[fault]:
            raise ValueError(f"{text} ({c[fault]} entries)")
    if int(info["wordcount"]) != c["n"]:
        raise ValueError("wordcount differs from the index")
    if int(info["idxfilesize"]) != file_size(spark, f"{base}.idx"):
        raise ValueError("idxfilesize differs from the index")
    texts = resolve(spark, base, index.select("offset", "size").distinct(), "raw")
    empty = texts.where(F.trim("article") == "").count()
    if empty:
        raise ValueError(f"{empty} articles are empty")
    if strict:
        fault = leaks.leaked_lines(texts, "offset").first()
        if fault is not None:
            raise ValueError(f"the article at {fault['offset']} shows no meaning ({fault['fault']}): {fault['line']!r}")
    return {"keys": c["n"], "articles": c["a"]}
