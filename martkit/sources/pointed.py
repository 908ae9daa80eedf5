"""Tables whose partitions are replaced all at once.

Each write goes to a folder of its own; a pointer, one small file per commit,
names the folder that holds each partition now. Readers follow the newest
pointer, so they see all partitions of a run or none, and a run that stops
before its commit leaves them on the state before it. Only the partitions that
a reader or a run names are opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.project import q
from martkit.workspace import written


def _text(col: str) -> Column:
    return F.coalesce(q(col).cast("string"), F.lit("null"))


class PointedTable:
    """A table below ``path`` with the columns of ``schema``, replaced by partitions of ``by``.

    ``by`` are columns of the schema whose values, as text, name a partition.
    The pointer holds a name and a folder for each partition and passes the
    driver; rows never do. One writer at a time: of two runs that commit the
    same pointer number the second fails and leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, by: list[str]) -> None:
        self.spark, self.path, self.by = spark, path.rstrip("/"), by
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _newest(self) -> int:
        """Number of the newest pointer, 0 before the first commit."""
        fs, place = self._fs(f"{self.path}/pointers")
        if not fs.exists(place):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def partitions(self) -> dict[str, str]:
        """The folder, below the table's, of each partition that exists now."""
        number = self._newest()
        if not number:
            return {}
        rows = self.spark.read.text(f"{self.path}/pointers/{number:010}.json", wholetext=True).collect()
        return json.loads(rows[0][0])

    def read(self, only: Iterable[str] | None = None) -> DataFrame:
        """The rows of all partitions, or of those named (others that don't exist are none)."""
        now = self.partitions()
        folders = sorted({now[p] for p in (now if only is None else only) if p in now})
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        fields = T.StructType([*self.schema.fields, T.StructField("__part", T.StringType())])
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(fields).parquet(*paths).drop("__part")

    def replace(self, df: DataFrame, drop: Iterable[str] = ()) -> list[str]:
        """Put the rows in place of the partitions that they name, and take away those of ``drop`` that get no rows.

        Returns the names of the partitions written. Each partition gets its
        files in a folder of its own, so that it can be read and replaced alone.
        """
        number = self._newest()
        now = self.partitions() if number else {}
        generation = f"data/{uuid.uuid4().hex}"
        part = F.concat_ws("|", *[_text(c) for c in self.by])
        place = F.substring(F.md5(part.cast("binary")), 1, 20)
        rows = df.select(*[q(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], part.alias("__part"), place.alias("__folder"))
        (
            rows.hint("rebalance", "__folder").write.option("partitionOverwriteMode", "static")
            .partitionBy("__folder").parquet(f"{self.path}/{generation}")
        )
        made = self.spark.read.schema("__part string, __folder string").parquet(f"{self.path}/{generation}")
        new = {r["__part"]: f"{generation}/__folder={r['__folder']}" for r in made.distinct().collect()}
        kept = {p: f for p, f in now.items() if p not in set(drop)}
        self._commit(kept | new, number + 1)
        return sorted(new)

    def merge(self, delivered: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[str]:
        """Replace the partitions that the rows touch by ``how`` of their kept rows and the delivered ones; no other is read."""
        delivered = written(delivered)
        part = F.concat_ws("|", *[_text(c) for c in self.by])
        touched = [r[0] for r in delivered.select(part).distinct().collect()]
        return self.replace(how(self.read(touched), delivered), drop=touched) if touched else []

    def _commit(self, parts: dict[str, str], number: int) -> None:
        fs, target = self._fs(f"{self.path}/pointers/{number:010}.json")
        _, draft = self._fs(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        out.close()
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"another run has committed to {self.path}")

    def sweep(self) -> int:
        """Delete the folders that the newest pointer no longer names; returns how many.

        For when no reader follows an older pointer any more.
        """
        fs, data = self._fs(f"{self.path}/data")
        if not fs.exists(data):
            return 0
        live = set(self.partitions().values())
        gone = 0
        for generation in fs.listStatus(data):
            for folder in fs.listStatus(generation.getPath()):
                name = f"data/{generation.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and name not in live:
                    fs.delete(folder.getPath(), True)
                    gone += 1
        return gone
