"""What belongs to a stored table, in one small file.

Data is written to fresh folders and counts from the moment a new version of the manifest names
them; a run that dies before leaves the table as it was. One writer at a time: a second one that started
from the same version is refused. Folders that no version names any more are removed after a commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vacancia.session import shuffles_dropped

_VERSIONS = "_manifest"


class Manifest:
    """State (a JSON object with folder names in it) of the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.state = self._newest()

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _newest(self) -> tuple[int, dict]:
        versions = [n for n in self._names(_VERSIONS) if n.endswith(".json") and not n.startswith(".")]
        if not versions:
            return 0, {}
        fs, p = self._path(f"{_VERSIONS}/{versions[-1]}")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return int(versions[-1].split(".")[0]), json.loads(text)

    def stage(self, df: DataFrame, name: str) -> str:
        """Writes ``df`` to a folder that belongs to nothing yet; returns the folder's name below ``root``."""
        folder = f"data/{name}-{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            df.write.parquet(f"{self.root}/{folder}")
        return folder

    def read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def commit(self, state: dict) -> None:
        """Makes ``state`` the next version and removes the folders that it does not name."""
        name = f"{_VERSIONS}/{self.version + 1:012d}.json"
        fs, final = self._path(name)
        draft = self._path(f"{_VERSIONS}/.{uuid.uuid4().hex}")[1]
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"{name} exists: another run committed first")
        self.version, self.state = self.version + 1, state
        self._clear()

    def _clear(self) -> None:
        text = json.dumps(self.state)
        for folder in self._names("data"):
            if f"data/{folder}" not in text:
                fs, p = self._path(f"data/{folder}")
                fs.delete(p, True)
        for old in self._names(_VERSIONS)[:-2]:
            fs, p = self._path(f"{_VERSIONS}/{old}")
            fs.delete(p, False)
