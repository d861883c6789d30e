"""Tables that are changed by publishing, so that nothing being read is overwritten.

A table is a folder of data folders, each written once under a name of its own, and of
manifests, numbered files that list the data folders of one version. A change writes its
data first and then creates the next manifest, which fails if somebody else has created
it meanwhile. Readers take the newest whole manifest and keep reading its folders however
many versions follow; ``vacuum`` removes what no recent version names.

``batch`` makes a change happen once: a change with a batch number that the table has
already taken in is left out, as when a stream or a load is run again after a failure.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


class PublishedTable:
    """A versioned Parquet table in shared storage."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str | None = None,
                 partitioned: bool = False):
        self.spark, self.path, self.schema, self.partitioned = spark, path.rstrip("/"), schema, partitioned

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _manifest_names(self) -> list[str]:
        fs, folder = self._fs(f"{self.path}/{MANIFESTS}")
        if not fs.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(folder))

    def _load(self, name: str) -> dict | None:
        """A manifest; None for one whose writer died half-way."""
        fs, target = self._fs(f"{self.path}/{MANIFESTS}/{name}")
        stream = fs.open(target)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def manifest(self) -> dict:
        """The newest version: number, data folders, last batch, and what was noted."""
        for name in reversed(self._manifest_names()):
            found = self._load(name)
            if found is not None:
                return found
        return {"version": 0, "folders": [], "batch": -1, "note": {}}

    def exists(self) -> bool:
        return bool(self.manifest()["folders"])

    def read(self, manifest: dict | None = None) -> DataFrame:
        """The table as of the newest (or the given) version."""
        folders = (manifest or self.manifest())["folders"]
        if not folders:
            if self.schema is None:
                raise FileNotFoundError(f"{self.path} has no published version")
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        if self.partitioned:  # every data folder has partition folders of its own
            return reduce(DataFrame.unionByName, [reader.parquet(f"{self.path}/{f}") for f in folders])
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def took(self, batch: int | None) -> bool:
        return batch is not None and self.manifest()["batch"] >= batch

    def append(self, df: DataFrame, batch: int | None = None, note: dict | None = None, shape=None) -> bool:
        """Add rows; False if the batch is in the table already."""
        return self._change(df, batch, note, shape, keep=True)

    def replace(self, df: DataFrame, batch: int | None = None, note: dict | None = None, shape=None) -> bool:
        """Publish ``df`` as the whole table; it may read the version it replaces."""
        return self._change(df, batch, note, shape, keep=False)

    def _change(self, df, batch, note, shape, keep: bool) -> bool:
        now = self.manifest()
        if batch is not None and now["batch"] >= batch:
            return False
        names = self._manifest_names()
        number = int(names[-1].split(".")[0]) + 1 if names else 1
        folder = f"data-{number:012d}-{uuid.uuid4().hex}"
        writer = df.write if shape is None else shape(df.write)
        writer.parquet(f"{self.path}/{folder}")
        new = [folder] if not self.partitioned or self._has_parts(folder) else []
        self._publish(number, {
            "version": number, "folders": [*(now["folders"] if keep else []), *new],
            "batch": now["batch"] if batch is None else batch, "note": {**now["note"], **(note or {})}})
        return True

    def _has_parts(self, folder: str) -> bool:
        """Whether a partitioned write has left any rows; without, it leaves no schema."""
        fs, target = self._fs(f"{self.path}/{folder}")
        return any(s.isDirectory() for s in fs.listStatus(target))

    def _publish(self, number: int, manifest: dict) -> None:
        fs, target = self._fs(f"{self.path}/{MANIFESTS}/{number:012d}.json")
        stream = fs.create(target, False)  # fails if this version was published meanwhile
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()

    def vacuum(self, keep: int = 2) -> None:
        """Remove manifests but the newest ``keep``, and data folders none of these names."""
        names = self._manifest_names()
        recent = [m for m in map(self._load, names[-keep:]) if m]
        held = {f for m in recent for f in m["folders"]}
        newest = max((m["version"] for m in recent), default=0)
        fs, root = self._fs(self.path)
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            # a folder of a later number may be one that is being written now
            if name.startswith("data-") and name not in held and int(name.split("-")[1]) <= newest:
                fs.delete(status.getPath(), True)
        for name in names[:-keep]:
            fs.delete(self._fs(f"{self.path}/{MANIFESTS}/{name}")[1], False)
