"""Tables replaced in one step: every load is a folder of its own, and a view names the current one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import qualified


class VersionedTable:
    """A view `name` over version folders under `root`, which all executors must reach.

    A load writes a new folder and then points the view at it, one change in the catalog: readers see the old or the
    new rows and never an absent table. Readers that are still at work keep their version until it is expired. A failed load
    changes nothing. Two loads at once both end; the view shows the one that swapped last.
    """

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name = spark, qualified(name)
        self.folder = f"{root.rstrip('/')}/{self.name}"

    def _fs(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[str]:
        """Folders in the order of their loads; one being written, or left by a crash, counts as well."""
        fs, path = self._fs(self.folder)
        if not fs.exists(path):
            return []
        return sorted(f"{self.folder}/{s.getPath().getName()}" for s in fs.listStatus(path))

    def current(self) -> str | None:
        """The folder behind the view, None without one."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('version_folder')").first()
        return shown["value"]

    def replace(self, df: DataFrame) -> int:
        """Load `df` as the new version and return its number of rows, counted while they are written."""
        last = max((int(v.rsplit("/", 1)[1].split("-")[1]) for v in self.versions()), default=0)
        path = f"{self.folder}/v-{last + 1:09d}-{uuid.uuid4().hex[:12]}"
        seen = Observation(f"rows_{uuid.uuid4().hex}")
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        except Exception:
            self._delete(path)
            raise
        columns = ", ".join(f"`{c}`" for c in df.columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('version_folder' = '{path}') AS SELECT {columns} FROM parquet.`{path}`")
        return seen.get["rows"]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all versions but the current one and the newest `keep`; returns the deleted folders."""
        here, held = self.current(), self.versions()
        old = [v for v in (held[:-keep] if keep else held) if v != here]
        for path in old:
            self._delete(path)
        return old

    def _delete(self, path: str) -> None:
        fs, path = self._fs(path)
        fs.delete(path, True)
