"""Binary dictionary bundles as DataFrames: the index is cut into blocks, articles are read where they are needed."""

from __future__ import annotations

import gzip
import html
import io
import re
import tarfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.sinks.stardict import parse_index, parse_synonyms, read_info

_TAG = re.compile(r"<[^<>]{1,80}>")


def file_size(spark: SparkSession, path: str) -> int:
    """Size of a file; -1 if it does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getLen() if fs.exists(p) else -1


def _first(spark: SparkSession, base: str, *suffixes: str) -> str | None:
    return next((base + s for s in suffixes if file_size(spark, base + s) >= 0), None)


def _content(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _unzip(path: str, data: bytes) -> bytes:
    return gzip.decompress(data) if path.endswith((".gz", ".dz")) else data


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file (an .ifo has a few lines)."""
    return bytes(_content(spark, path).first()["content"]).decode("utf-8")


def article_text(data: bytes, kind: str) -> str:
    """Text of an article: NULs at the end go, tags of HTML (or what looks like it) go, entities are resolved; ``raw`` keeps all."""
    if kind == "raw":
        return data.decode("utf-8", "replace")
    text = data.rstrip(b"\0").decode("utf-8", "replace")
    if kind == "h" or "<" in text and "</" in text:
        text = _TAG.sub(" ", text)
    return html.unescape(text)


def read_index(spark: SparkSession, base: str, strict: bool = True) -> DataFrame:
    """``(idx_no, word, offset, size, unordered)``; parsed by one task, as records have no fixed size. The file is limited by its 32-bit format."""
    path = _first(spark, base, ".idx", ".idx.gz")
    if path is None:
        raise FileNotFoundError(base + ".idx")
    bits = int(read_info(read_text(spark, base + ".ifo")).get("idxoffsetbits", 32) or 32)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, last = parse_index(_unzip(name, data), bits, strict), b""
                for lo in range(0, len(rows), 50_000):
                    part = rows[lo : lo + 50_000]
                    wrong = []
                    for w, _, _ in part:
                        k = w.encode("utf-8")
                        wrong.append(k < last)
                        last = k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range(lo, lo + len(part)), pa.int64()), *[pa.array(c, t) for c, t in zip(zip(*part), (pa.string(), pa.int64(), pa.int64()))], pa.array(wrong, pa.bool_())],
                        names=["idx_no", "word", "offset", "size", "unordered"],
                    )

    return _content(spark, path).mapInArrow(run, "idx_no long, word string, offset long, size long, unordered boolean")


def resolve(spark: SparkSession, base: str, pointers: DataFrame, kind: str = "m") -> DataFrame:
    """``pointers(offset, size)`` plus ``article``. A plain .dict is read by ranges through the file system of the task.

    Pointers are sorted by offset within a task, so that a task reads its part of the file
    forwards. A compressed file is unpacked once per task.
    """
    path = _first(spark, base, ".dict", ".dict.dz")
    if path is None:
        raise FileNotFoundError(base + ".dict")
    size = file_size(spark, path) if path.endswith(".dict") else None
    local = path.removeprefix("file://").replace("file:", "", 1) if path.startswith("file:") else path

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), local)
        with system.open_input_file(place) as f:
            source = f if size is not None else io.BytesIO(gzip.decompress(f.read()))
            for b in batches:
                texts = []
                for o, n in zip(b.column("offset").to_pylist(), b.column("size").to_pylist()):
                    source.seek(o)
                    data = source.read(n)
                    texts.append(article_text(data, kind) if len(data) == n else None)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "article"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pointers.schema.fields)
    ordered = pointers.repartitionByRange("offset").sortWithinPartitions("offset")
    return ordered.mapInArrow(run, fields + ", article string")


def read_bundle(spark: SparkSession, base: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(``entries(idx_no, word, article)``, ``synonyms(alias, idx_no)``) of a bundle.

    Only plain text and HTML articles are known; others are an error. Entries that point
    outside the file have a null article. ``base`` is the path without suffix.
    """
    kind = read_info(read_text(spark, base + ".ifo")).get("sametypesequence", "m")
    if kind not in ("m", "h"):
        raise ValueError(f"articles of type {kind!r} are not supported")
    index = read_index(spark, base, strict).select("idx_no", "word", "offset", "size")
    entries = resolve(spark, base, index, kind).select("idx_no", "word", "article")
    syn = _first(spark, base, ".syn")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for data in b.column(1).to_pylist():
                rows = parse_synonyms(data)
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["alias", "idx_no"])

    form = "alias string, idx_no long"
    return entries, _content(spark, syn).mapInArrow(run, form) if syn else spark.createDataFrame([], form)


def read_keys(spark: SparkSession, bases: list[str]) -> DataFrame:
    """``(word)``: the distinct keys of several bundles; keys that are not UTF-8 and a cut tail are passed over."""
    out = None
    for base in bases:
        keys = read_index(spark, base, strict=False).select("word")
        out = keys if out is None else out.unionByName(keys)
    return (spark.createDataFrame([], "word string") if out is None else out).distinct()


def unpack_archive(spark: SparkSession, archive: str, folder: str) -> str:
    """Unpack a tar archive of one bundle (any compression tarfile knows) into a shared folder; returns the base path.

    Member names are cut to their last part, so nothing is written outside the folder.
    """
    data = bytes(_content(spark, archive).first()["content"])
    base = None
    jvm = spark.sparkContext._jvm
    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
        for m in tar:
            name = m.name.rsplit("/", 1)[-1]
            if not m.isfile() or not re.search(r"\.(?:ifo|idx(?:\.gz)?|dict(?:\.dz)?|syn)$", name):
                continue
            target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
            out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
            out.write(bytearray(tar.extractfile(m).read()))
            out.close()
            if name.endswith(".ifo"):
                base = f"{folder}/{name[:-4]}"
    if base is None:
        raise ValueError(f"{archive} holds no bundle")
    return base


