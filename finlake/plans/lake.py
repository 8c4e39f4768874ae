"""A directory lake with layers (bronze / silver / gold / analytics) and published runs.

Tables are plain Parquet folders.  A run writes every table into a folder of
its own (``v=<version>-<token>``), never into one that was read, and ends by
writing one small manifest, ``runs/run=<n>``, that names the folder of every
table.  Readers take only what the newest manifest names, so a run that died at
any write leaves nothing that is read, and the next run, under the same or
another version, builds on the last published one.

* ``write_state`` / ``read_state``: a table as a whole.
* ``apply_snapshot``: a keyed target; also writes the change feed (insert /
  update / delete) against the state that the run builds on.
* ``write_parts`` / ``read_parts``: a table by the values of one column (a
  month); the manifest names a folder for every value, and a run writes only
  the values that it replaces.
* ``note``: facts of the run kept in the manifest.
* ``retain``: delete the folders that no kept manifest names.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from finlake.operators.cdc import snapshot_diff
from finlake.schemas import declared_schema
from finlake.storage import Files, empty, read_notes, write_note

KEPT_RUNS = 3
PARTS = "parts"


def in_values(column: str, values):
    """Whether ``column`` is one of ``values``; never NULL, and NULL is a value like any other."""
    hit = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return hit | F.col(column).isNull() if None in values else hit


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._run: dict | None = None       # manifest of the run that is under way

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # --- runs ------------------------------------------------------------------------
    def _manifests(self) -> list[tuple[int, dict]]:
        return read_notes(self.spark, f"{self.root}/runs", "run")

    def _manifest(self, version: int | None = None) -> dict:
        """The newest manifest (of ``version``), or that of the run under way."""
        if self._run is not None and version in (None, self._run["version"]):
            return self._run
        found = [m for _, m in self._manifests() if version is None or m["version"] == version]
        return found[-1] if found else {"version": None, "tables": {}, "notes": {}}

    @contextmanager
    def run(self, version: int) -> Iterator[Lake]:
        """A run that writes ``version``; what it wrote is published when the block ends without an error.

        It builds on the newest published run of a lower version.  Inside, its
        own tables are read as they are written.  A run within a run of the
        same version is part of it.
        """
        if self._run is not None:
            if self._run["version"] != version:
                raise ValueError(f"version {self._run['version']} is under way, not {version}")
            yield self
            return
        before = [m for _, m in self._manifests() if m["version"] < version]
        self._base = before[-1] if before else {"version": None, "tables": {}, "notes": {}}
        self._run = {"version": version, "token": uuid.uuid4().hex[:8], "notes": dict(self._base["notes"]),
                     "tables": {t: {k: v for k, v in e.items() if k != "changes"} for t, e in self._base["tables"].items()}}
        try:
            yield self
            self._publish()
        finally:
            self._run = None

    def _publish(self) -> None:
        runs = self._manifests()
        write_note(self.spark, f"{self.root}/runs/run={runs[-1][0] + 1 if runs else 0}", self._run)

    def _folder(self) -> str:
        if self._run is None:
            raise ValueError("tables are written within a run")
        return f"v={self._run['version']}-{self._run['token']}"

    def _entry(self, layer: str, table: str) -> dict:
        return self._run["tables"].setdefault(f"{layer}/{table}", {})

    def note(self, **facts) -> None:
        """Facts kept in the manifest of the run under way and of those that build on it."""
        self._folder()
        self._run["notes"].update(facts)

    def notes(self) -> dict:
        """Facts of the newest published run."""
        return self._manifest()["notes"]

    def latest_version(self) -> int | None:
        return self._manifest()["version"]

    def retain(self, runs: int = KEPT_RUNS) -> list[str]:
        """Keep the newest ``runs`` manifests and what they name; delete the rest and return its paths."""
        files, found = Files(self.spark), self._manifests()
        kept = [m for _, m in found[-runs:]]
        gone = [f"{self.root}/runs/run={n}" for n, _ in found[:-runs]]
        named = set()
        for m in kept:
            for name, entry in m["tables"].items():
                named |= {f"{self.root}/{name}/{kind}/{entry[kind]}" for kind in ("state", "changes") if kind in entry}
                named |= {f"{self.root}/{name}/{PARTS}/{f}" for f in entry.get(PARTS, {})}
        tables = {name for _, m in found for name in m["tables"]}
        for name in sorted(tables):
            for kind in ("state", "changes", PARTS):
                gone += [f"{self.root}/{name}/{kind}/{f}" for f in files.names(f"{self.root}/{name}/{kind}")
                         if f"{self.root}/{name}/{kind}/{f}" not in named]
        for path in gone:
            files.delete(path)
        return gone

    # --- whole tables ------------------------------------------------------------------
    def exists(self, layer: str, table: str) -> bool:
        return f"{layer}/{table}" in self._manifest()["tables"]

    def _read(self, layer: str, table: str, kind: str, manifest: dict) -> DataFrame:
        entry = manifest["tables"].get(f"{layer}/{table}", {})
        if kind not in entry:
            schema = declared_schema(layer, table)
            if schema is None:
                raise ValueError(f"{layer}.{table} has no {kind} in version {manifest['version']} and no declared schema")
            return empty(self.spark, StructType([*schema.fields, *[StructField("_op", StringType())][:kind == "changes"]]))
        schema = StructType.fromJson(json.loads(entry[f"{kind}_schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.path(layer, table)}/{kind}/{entry[kind]}")

    def _write(self, df: DataFrame, layer: str, table: str, kind: str) -> None:
        folder = self._folder()
        df.write.mode("overwrite").parquet(f"{self.path(layer, table)}/{kind}/{folder}")
        self._entry(layer, table).update({kind: folder, f"{kind}_schema": df.schema.json()})

    def write_state(self, df: DataFrame, layer: str, table: str) -> None:
        self._write(df, layer, table, "state")

    def read_state(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """The published table (of ``version``); one that was never written has no rows, where its columns are declared."""
        return self._read(layer, table, "state", self._manifest(version))

    def read_base(self, layer: str, table: str) -> DataFrame:
        """The table as the run under way found it."""
        return self._read(layer, table, "state", self._base)

    def read_changes(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """Change feed that the newest run (of ``version``) wrote."""
        return self._read(layer, table, "changes", self._manifest(version))

    def apply_snapshot(self, new: DataFrame, layer: str, table: str, keys, several: bool = False) -> bool:
        """Make ``new`` the state of ``table`` and record its changes; returns whether there was a state before.

        ``new`` is computed once and written; the changes are found between the
        two stored states.  A repeated key is an error, unless ``several`` rows
        of a key are meant to be there.
        """
        had = f"{layer}/{table}" in self._base["tables"] if self._run else False
        self.write_state(new, layer, table)
        cur = self.read_state(layer, table)
        old = self.read_base(layer, table) if had else cur.limit(0)
        for f in cur.schema.fields:       # columns that the state before didn't have
            if f.name not in old.columns:
                old = old.withColumn(f.name, F.lit(None).cast(f.dataType))
        # audit columns change with every extraction; they are no change of the row
        values = [c for c in cur.columns if c not in keys and not c.startswith("_")]
        changes = snapshot_diff(old, cur, keys, values, several=several).where(F.col("_op") != "same")
        self._write(changes, layer, table, "changes")
        return had

    # --- tables by the values of a column -------------------------------------------------
    def write_parts(self, df: DataFrame, layer: str, table: str, by: str, replace=None) -> list:
        """Write ``df``, one folder for every value of ``by``; returns the values written.

        With ``replace`` the values in it are replaced (those without rows
        disappear) and all others stay; without, the table is replaced.  The
        values, which reach the driver, are to be few, as months are.
        """
        folder = self._folder()
        p = f"{self.path(layer, table)}/{PARTS}/{folder}"
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(p)
        values = [_value(n) for n in Files(self.spark).names(p) if n.startswith(f"{by}=")]
        if replace is not None and not set(values) <= set(replace):
            raise ValueError(f"{layer}.{table}: rows of {sorted(map(str, set(values) - set(replace)))} are not to be replaced")
        entry = self._entry(layer, table)
        kept = {} if replace is None else {
            f: left for f, old in self._base["tables"].get(f"{layer}/{table}", {}).get(PARTS, {}).items()
            if (left := [v for v in old if v not in replace])}
        entry.update({PARTS: {**kept, **({folder: values} if values else {})}, "by": by, "parts_schema": df.schema.json()})
        return values

    def parts(self, layer: str, table: str) -> dict:
        """Value to folder of a table written by parts."""
        found = self._manifest()["tables"].get(f"{layer}/{table}", {}).get(PARTS, {})
        return {v: f for f, values in found.items() for v in values}

    def read_parts(self, layer: str, table: str, only=None, base: bool = False) -> DataFrame:
        """The published parts (``base``: those that the run under way found), of the values in ``only``.

        One scan; the folder and the value are partition columns, so the filter
        prunes what the manifest doesn't name.
        """
        entry = (self._base if base else self._manifest())["tables"].get(f"{layer}/{table}", {})
        if "parts_schema" not in entry:
            schema = declared_schema(layer, table)
            if schema is None:
                raise ValueError(f"{layer}.{table} was never written and has no declared schema")
            return empty(self.spark, schema)
        schema = StructType.fromJson(json.loads(entry["parts_schema"]))
        by, root = entry["by"], f"{self.path(layer, table)}/{PARTS}"
        live = {f: [v for v in vs if only is None or v in only] for f, vs in entry[PARTS].items()}
        live = {f: vs for f, vs in live.items() if vs}
        if not live:
            return empty(self.spark, schema)
        stored = StructType([*[StructField(f.name, f.dataType) for f in schema.fields], StructField("v", StringType())])
        df = self.spark.read.schema(stored).option("basePath", root).parquet(*[f"{root}/{f}" for f in live])
        named = None
        for folder, values in live.items():
            here = (F.col("v") == folder.partition("=")[2]) & in_values(by, values)
            named = here if named is None else named | here
        return df.where(named).select(*schema.fieldNames())

    # --- names in the session's catalog -----------------------------------------------------
    def describe(self, layer: str, table: str, comment: str, **props) -> None:
        """Store a table comment and properties next to the table (``_meta``)."""
        write_note(self.spark, f"{self.path(layer, table)}_meta/note=0", {"comment": comment, **{k: str(v) for k, v in props.items()}})

    def properties(self, layer: str, table: str) -> dict:
        notes = read_notes(self.spark, f"{self.path(layer, table)}_meta", "note")
        return notes[-1][1] if notes else {}

    def register(self, catalog_prefix: str = "") -> list[str]:
        """Name every published table in the session's catalog as ``<layer>.<table>``; returns the names.

        A table as a whole is an external table over the folder that the newest
        manifest names, one by parts a view over its live parts. Comment and
        properties are those of :meth:`describe`, with the version. Call it
        again after a run: names are replaced, files stay.
        """
        manifest, out = self._manifest(), []
        for full, entry in sorted(manifest["tables"].items()):
            layer, table = full.split("/")
            database, name = f"`{catalog_prefix}{layer}`", f"`{catalog_prefix}{layer}`.`{table}`"
            props = {**self.properties(layer, table), "version": str(manifest["version"])}
            comment = _text(props.pop("comment", f"{layer} {table}"))
            listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in sorted(props.items()))
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            if "state" in entry:
                columns = StructType.fromJson(json.loads(entry["state_schema"])).toDDL()
                place = _text(f"{self.path(layer, table)}/state/{entry['state']}")
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION {place} "
                               f"COMMENT {comment} TBLPROPERTIES ({listed})")
            elif PARTS in entry:
                fields = StructType.fromJson(json.loads(entry["parts_schema"])).fields
                cast = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
                live = [f"(v = {_text(folder.partition('=')[2])} AND ({_sql_in(entry['by'], values)}))"
                        for folder, values in entry[PARTS].items()]
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT {comment} TBLPROPERTIES ({listed}) AS SELECT {cast} "
                               f"FROM parquet.`{self.path(layer, table)}/{PARTS}` WHERE {' OR '.join(live) or 'false'}")
            else:
                continue
            out.append(f"{catalog_prefix}{layer}.{table}")
        return out


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_in(column: str, values) -> str:
    known = ", ".join(_text(v) for v in values if v is not None)
    tests = [f"CAST(`{column}` AS STRING) IN ({known})"] * bool(known) + [f"`{column}` IS NULL"] * (None in values)
    return " OR ".join(tests)


def _value(name: str) -> str | None:
    """The partition value of a folder ``column=value``."""
    value = re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), name.partition("=")[2])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value
