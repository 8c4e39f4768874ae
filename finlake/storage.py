"""Files and published batches on any Hadoop file system.

``Files`` lists, moves and deletes paths through the session's Hadoop file
systems, so it reaches whatever Spark reaches.  ``BatchLog`` is an append-only
table of numbered batches in plain Parquet folders: a batch counts once its
mark, written last, is there.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


class Files:
    """Paths of the session's file systems, from the driver."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names of what a folder holds; none where there is no such folder."""
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def first_line(self, path: str) -> str | None:
        """First line of a file, None when it is empty; no more than a buffer beyond it is read."""
        p, fs = self._at(path)
        codec = self.jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self.conf).getCodec(p)
        stream = fs.open(p)
        try:
            stream = codec.createInputStream(stream) if codec else stream
            return self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()

    def delete(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.delete(p, True)

    def rename(self, path: str, target: str) -> None:
        """Rename a folder or file within its file system."""
        p, fs = self._at(path)
        t, _ = self._at(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(p, t):
            raise OSError(f"{path} was not renamed to {target}")

    def move(self, path: str, target: str) -> bool:
        """Move a file, between file systems if need be."""
        p, fs = self._at(path)
        t, to = self._at(target)
        to.mkdirs(t.getParent())
        return self.jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, t, True, self.conf)


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """One small JSON file, in a folder of its own."""
    spark.createDataFrame([(json.dumps(note, sort_keys=True),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_notes(spark: SparkSession, path: str, key: str) -> list[tuple[int, dict]]:
    """(number, note) of the notes in the folders ``<key>=<number>`` under ``path``, by number."""
    if not Files(spark).exists(path):
        return []
    found = spark.read.schema(f"value string, {key} long").text(path).collect()
    return sorted(((r[key], json.loads(r["value"])) for r in found), key=lambda x: x[0])


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


class BatchLog:
    """Numbered batches of rows whose columns may come to be more and wider.

    ``<root>/rows/form=<f>/batch=<n>`` holds the rows of a batch, a form being a
    schema; ``<root>/batches/batch=<n>`` is its mark: form, schema and facts.
    A batch written again replaces its mark, so what a failed attempt left is
    never read.  The marks that reach the driver are one small note a batch.
    ``schema`` is that of a log without batches.
    """

    def __init__(self, root: str, schema: StructType | None = None):
        self.root, self.schema = root.rstrip("/"), schema

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def batches(self) -> str:
        return f"{self.root}/batches"

    def write(self, df: DataFrame, batch: int, facts=None) -> None:
        """Write ``df`` as ``batch``; ``facts``, or what it returns after the write, is kept with the mark."""
        kept = df.schema.json()
        form = zlib.crc32(kept.encode())
        df.write.mode("overwrite").parquet(f"{self.rows}/form={form}/batch={batch}")
        facts = facts() if callable(facts) else facts
        write_note(df.sparkSession, f"{self.batches}/batch={batch}", {"form": form, "schema": kept, "facts": facts or {}})

    def marks(self, spark: SparkSession) -> list[tuple[int, dict]]:
        return read_notes(spark, self.batches, "batch")

    def last(self, spark: SparkSession) -> int:
        """Number of the newest batch, -1 when there is none."""
        return max((n for n, _ in self.marks(spark)), default=-1)

    def read(self, spark: SparkSession, after: int = -1, only=None, with_batch: bool = False) -> DataFrame:
        """Rows of the batches after ``after`` (or of ``only``), in the newest form.

        Columns that a batch doesn't have are null, and types that have come to
        be wider since are cast.
        """
        marks = self.marks(spark)
        if not marks:
            if self.schema is None:
                raise ValueError(f"{self.root} has no batch and no declared schema")
            return empty(spark, StructType([*self.schema.fields, *[StructField("batch", LongType())][:with_batch]]))
        fields = {}
        for _, mark in reversed(marks):
            for f in StructType.fromJson(json.loads(mark["schema"])).fields:
                fields.setdefault(f.name, f)
        forms: dict[int, tuple[StructType, list[int]]] = {}
        for n, mark in marks:
            if n > after if only is None else n in only:
                forms.setdefault(mark["form"], (StructType.fromJson(json.loads(mark["schema"])), []))[1].append(n)
        out = None
        for form, (schema, numbers) in forms.items():
            stored = StructType([*schema.fields, StructField("batch", LongType())])
            df = spark.read.schema(stored).parquet(f"{self.rows}/form={form}").where(F.col("batch").isin(numbers))
            have = {f.name: f for f in schema.fields}
            df = df.select(*[self._as(f, have.get(f.name)) for f in fields.values()], *["batch"][:with_batch])
            out = df if out is None else out.unionByName(df)
        if out is None:
            return empty(spark, StructType([*fields.values(), *[StructField("batch", LongType())][:with_batch]]))
        return out

    @staticmethod
    def _as(wanted: StructField, stored: StructField | None):
        if stored is None:
            return F.lit(None).cast(wanted.dataType).alias(wanted.name)
        if stored.dataType == wanted.dataType:
            return F.col(wanted.name)
        return F.col(wanted.name).try_cast(wanted.dataType).alias(wanted.name)
