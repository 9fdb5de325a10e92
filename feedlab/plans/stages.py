"""Stage outputs that a restarted job finds again (M1/K2).

A stage's folder is named by a fingerprint of its name, its parameters and its
inputs: the files' paths, sizes and times for stored data, the fingerprint of
the stage before for stage outputs.  A marker written after the output commits
it.  A job that died is run again with the same folder: committed stages are
read, the first one without a marker is written anew, and a changed parameter
or input changes the fingerprints of exactly the stages that depend on it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Part of every fingerprint: raise it when an operator's result changes.
RESULTS_VERSION = 1


@dataclass(frozen=True)
class Stage:
    """A committed stage output."""

    name: str
    fingerprint: str
    path: str
    df: DataFrame


class Stages:
    """Committed stage outputs under ``root``, a folder that all executors share.

    ``ran`` and ``reused`` list the stages of this object in order.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ran: list[str] = []
        self.reused: list[str] = []

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def stored(self, path: str) -> list:
        """Path, size and time of each file below ``path``; files may be matched by a pattern."""
        p, fs = self._fs(path)
        out = []
        for top in fs.globStatus(p) or ():
            files = fs.listFiles(top.getPath(), True)
            while files.hasNext():
                f = files.next()
                out.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
        if not out:
            raise FileNotFoundError(path)
        return sorted(out)

    def fingerprint(self, name: str, inputs: Sequence[Stage | str], params: dict) -> str:
        known = [i.fingerprint if isinstance(i, Stage) else self.stored(i) for i in inputs]
        text = json.dumps([RESULTS_VERSION, name, known, params], sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()

    def run(self, name: str, build: Callable[[], DataFrame], inputs: Sequence[Stage | str] = (), **params) -> Stage:
        """The stage's output: read where it is committed, else built, written and committed."""
        mark = self.fingerprint(name, inputs, params)
        path = f"{self.root}/{name}-{mark[:32]}"
        done, fs = self._fs(f"{path}.done")
        if fs.exists(done):
            self.reused.append(name)
        else:
            build().write.mode("overwrite").parquet(path)
            fs.create(done, True).close()
            self.ran.append(name)
        return Stage(name, mark, path, self.spark.read.parquet(path))

    def forget(self, keep: Sequence[Stage] = ()) -> None:
        """Delete every stage output below the root but those in ``keep``.  The markers
        go first, so that a half-deleted output is never read."""
        root, fs = self._fs(self.root)
        if not fs.exists(root):
            return
        kept = {s.path.rsplit("/", 1)[1] for s in keep}
        paths = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(root)]
        for _, p in sorted((not n.endswith(".done"), p.toString()) for n, p in paths if n.removesuffix(".done") not in kept):
            fs.delete(self._fs(p)[0], True)
