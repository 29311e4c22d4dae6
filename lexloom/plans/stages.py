"""Stage tables that are kept between runs, each under a signature of what it was made from."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def fingerprint(path: str, block: int = 128 * 1024) -> dict:
    """Size, time and a hash of both ends of a local file."""
    st = os.stat(path)
    h = hashlib.blake2b(digest_size=16)
    with open(path, "rb") as f:
        h.update(f.read(block))
        if st.st_size > block:
            f.seek(max(block, st.st_size - block))
            h.update(f.read(block))
    return {"name": os.path.basename(path), "size": st.st_size, "mtime": int(st.st_mtime), "ends": h.hexdigest()}


def signature(payload: dict, parent: str = "") -> str:
    """Hash of a stage's inputs, chained to the stage before."""
    text = json.dumps({"parent": parent, **payload}, sort_keys=True, ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


class StageCache:
    """Parquet stage tables with a signature file that is written last, so a broken write is no hit."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _signature_frame(self, name: str) -> DataFrame:
        return self.spark.read.json(f"{self.root}/{name}/signature")

    def valid(self, name: str, sig: str) -> bool:
        try:
            rows = self._signature_frame(name).collect()
        except Exception:
            return False
        return len(rows) == 1 and rows[0]["signature"] == sig

    def get(self, name: str, sig: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table: read if its signature is ``sig``, otherwise made and written."""
        path = f"{self.root}/{name}/table"
        if not self.valid(name, sig):
            make().write.mode("overwrite").parquet(path)
            one = self.spark.createDataFrame([(sig,)], "signature string")
            one.coalesce(1).write.mode("overwrite").json(f"{self.root}/{name}/signature")
        return self.spark.read.parquet(path)


class Artifacts:
    """Finished outputs (folders) kept under a signature, to be restored instead of built."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _copy(self, source: str, target: str) -> None:
        (a, fa), (b, fb) = self._path(source), self._path(target)
        fb.delete(b, True)
        self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fa, a, fb, b, False, True, self.spark.sparkContext._jsc.hadoopConfiguration())

    def save(self, name: str, sig: str, folder: str) -> None:
        """Keep a copy; it counts only once its marker is written, which is last."""
        at = f"{self.root}/{name}/{sig}"
        self._copy(folder, f"{at}/files")
        marker, fs = self._path(f"{at}/complete")
        fs.create(marker, True).close()

    def restore(self, name: str, sig: str, folder: str) -> bool:
        """Copy what was kept under the signature to ``folder``; False if there is nothing complete."""
        at = f"{self.root}/{name}/{sig}"
        marker, fs = self._path(f"{at}/complete")
        if not fs.exists(marker):
            return False
        self._copy(f"{at}/files", folder)
        return True

    def restore_latest(self, name: str, folder: str) -> str | None:
        """Restore the newest complete output of a name; returns its signature."""
        top, fs = self._path(f"{self.root}/{name}")
        if not fs.exists(top):
            return None
        kept = [(f.getModificationTime(), f.getPath().getName()) for f in fs.listStatus(top) if f.isDirectory()]
        return next((sig for _, sig in sorted(kept, reverse=True) if self.restore(name, sig, folder)), None)
