"""Rows that batches of a stream add, kept in few folders.

Every batch writes its own rows into a folder of its own and a manifest, which lists the
folders that hold rows. Folders of about the same number of rows are merged once there are
``FAN`` of them, so what a batch writes is in proportion to its rows (each is written again
once per level), and the number of folders grows with the logarithm of all rows. Batch n
reads the manifest of batch n-1 alone, and folders go only when neither of the two lists
them: a batch that is repeated finds its input unchanged and replaces its own output.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wardwatch.sources import files

FAN = 8


@dataclass
class Manifest:
    """Folders with their numbers of rows, and what else a batch leaves to the next."""

    folders: dict[str, int] = field(default_factory=dict)
    note: dict = field(default_factory=dict)


class Levels:
    def __init__(self, spark: SparkSession, path: str, fan: int = FAN):
        self.spark, self.path, self.fan = spark, path, fan

    def manifest(self, batch_id: int) -> Manifest:
        """What batch ``batch_id`` has left; nothing before the first."""
        if batch_id < 0:
            return Manifest()
        return Manifest(**json.loads(files.read_text(self.spark, self._manifest(batch_id))))

    def newest(self) -> Manifest:
        """The manifest of the last batch."""
        return self.manifest(max(self._batches(), default=-1))

    def read(self, manifest: Manifest) -> DataFrame | None:
        """All rows that a manifest lists, or None."""
        if not manifest.folders:
            return None
        return self.spark.read.parquet(*[f"{self.path}/{folder}" for folder in manifest.folders])

    def add(
        self,
        batch_id: int,
        rows: DataFrame,
        merge: Callable[[DataFrame], DataFrame],
        note: dict | None = None,
    ) -> Manifest:
        """Adds the rows of a batch; ``merge`` gives what stays of rows that are merged."""
        before = self.manifest(batch_id - 1)
        folders = dict(before.folders)
        self._store(folders, f"rows/{batch_id}-0", rows)
        step = 1
        while crowded := self._crowded(folders):
            merged = merge(self.read(Manifest(dict.fromkeys(crowded, 0))))
            for folder in crowded:
                del folders[folder]
            self._store(folders, f"rows/{batch_id}-{step}", merged)
            step += 1
        now = Manifest(folders, note or {})
        text = json.dumps({"folders": folders, "note": now.note})
        files.write_text(self.spark, self._manifest(batch_id), text)
        self._forget(batch_id, before, now)
        return now

    def _manifest(self, batch_id: int) -> str:
        return f"{self.path}/manifest/{batch_id}"

    def _batches(self) -> list[int]:
        names = files.names(self.spark, f"{self.path}/manifest")
        return [int(name) for name in names if name.isdigit()]

    def _store(self, folders: dict[str, int], folder: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        count = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}").count()
        if count:
            folders[folder] = count

    def _crowded(self, folders: dict[str, int]) -> list[str]:
        """Folders of the lowest level that has too many."""
        levels = {folder: int(math.log(rows, self.fan)) for folder, rows in folders.items()}
        full = [level for level, n in Counter(levels.values()).items() if n >= self.fan]
        return [folder for folder, level in levels.items() if full and level == min(full)]

    def _forget(self, batch_id: int, before: Manifest, now: Manifest) -> None:
        """Deletes folders that neither this batch nor the one before lists, and old manifests."""
        listed = {*before.folders, *now.folders}
        found = [f"rows/{name}" for name in files.names(self.spark, f"{self.path}/rows")]
        past = [f"manifest/{number}" for number in self._batches() if number < batch_id - 1]
        for name in (*[name for name in found if name not in listed], *past):
            files.remove(self.spark, f"{self.path}/{name}")
