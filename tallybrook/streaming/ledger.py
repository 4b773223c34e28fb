"""What a streaming query has written: a small file for each batch beside its checkpoint, with the batch's figures."""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession


class Ledger:
    """Batches by number, each with its figures. A batch is noted after its tables are written; one that runs again is written again only if it was not noted.

    Every EACH batches the figures are summed into one file, so that few files are there however long the query runs."""

    EACH = 100

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _fs(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self) -> dict[tuple[str, int], str]:
        fs, path = self._fs(self.folder)
        if not fs.exists(path):
            return {}
        found = {s.getPath().getName() for s in fs.listStatus(path)}
        return {(m[1], int(m[2])): n for n in found if (m := re.fullmatch(r"(batch|upto)-(\d+)\.json", n))}

    def _read(self, name: str) -> dict[str, int]:
        fs, path = self._fs(f"{self.folder}/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, name: str, figures: dict[str, int]) -> None:
        fs, path = self._fs(f"{self.folder}/{name}")
        _, hidden = self._fs(f"{self.folder}/_{name}")
        stream = fs.create(hidden, True)
        try:
            stream.write(bytearray(json.dumps(figures), "utf-8"))
        finally:
            stream.close()
        fs.rename(hidden, path)

    def has(self, batch: int) -> bool:
        names = self._names()
        return ("batch", batch) in names or any(kind == "upto" and k >= batch for kind, k in names)

    def note(self, batch: int, figures: dict[str, int]) -> None:
        self._write(f"batch-{batch}.json", {k: int(v or 0) for k, v in figures.items()})
        if batch and batch % self.EACH == 0:
            self._write(f"upto-{batch}.json", self.sums())
            for (kind, k), name in self._names().items():
                if k < batch or kind == "batch" and k == batch:
                    fs, path = self._fs(f"{self.folder}/{name}")
                    fs.delete(path, False)

    def sums(self) -> dict[str, int]:
        """The figures of all noted batches, of this run of the query and of those before."""
        names = self._names()
        last = max((k for kind, k in names if kind == "upto"), default=-1)
        parts = [n for (kind, k), n in names.items() if kind == "upto" and k == last or kind == "batch" and k > last]
        out: dict[str, int] = {}
        for p in parts:
            for k, v in self._read(p).items():
                out[k] = out.get(k, 0) + v
        return out
