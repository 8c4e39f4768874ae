"""Delimited files whose columns change: layouts by header line, types that only widen.

A *layout* is the list of names in a file's header line.  Files of one layout
are read together, positionally and as text, and bound to the schema by name.
Columns of the declared schema have their declared type.  A column that no
schema declares is added when a layout first names it; its type follows from a
*summary* of all its values so far.  Summaries are counts and maxima, so those
of new files merge into what is kept and no old file is read again.  Layouts,
summaries and the schema they give are kept as numbered notes (:class:`Registry`).
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, _parse_datatype_string

from finlake.specs import RESCUED
from finlake.storage import Files, read_notes, write_note

HEADERS_AT_ONCE = 16        # files whose first lines are read at a time
LINE = "_line"              # a line that doesn't fit its header


def plain_path(path: str) -> str:
    """``path`` with the characters that Spark takes for patterns escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, str | None]:
    """First line of every file (None for an empty one); each is read up to that line only."""
    store = Files(spark)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return dict(zip(files, pool.map(store.first_line, files), strict=True))


def header_names(line: str, sep: str = ",", quote: str = '"') -> tuple[str, ...]:
    """Column names of a header line; a repeated name is an error that names it."""
    names = next(csv.reader([line.removeprefix("﻿")], delimiter=sep, quotechar=quote))
    names = tuple(n.strip() or f"_c{i}" for i, n in enumerate(names))
    seen = [n.lower() for n in names]
    repeated = sorted({n for n in names if seen.count(n.lower()) > 1})
    if repeated:
        raise ValueError(f"header repeats {', '.join(repeated)}: {line[:500]}")
    return names


# --- types from merged summaries --------------------------------------------------------

_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_DECIMAL = r"^[+-]?(0|[1-9][0-9]*)?(\.[0-9]+)?$"
_FLOAT = r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_FORMS = ("boolean", "whole", "decimal", "float", "date", "timestamp")


def _fits(kind: str, v: Column) -> Column:
    return {"boolean": F.lower(v).isin("true", "false"), "whole": v.rlike(_WHOLE),
            "decimal": v.rlike(_DECIMAL) & v.rlike("[0-9]"), "float": v.rlike(_FLOAT),
            "date": v.rlike(r"^\d{4}-\d{2}-\d{2}$") & v.try_cast("date").isNotNull(),
            "timestamp": v.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:") & v.try_cast("timestamp").isNotNull()
            | v.rlike(r"^\d{4}-\d{2}-\d{2}$") & v.try_cast("date").isNotNull()}[kind]


def summarise(raw: DataFrame, names: list[str]) -> dict[str, dict]:
    """Per column: values seen, values that each type can't hold, digits before and behind the point.

    One aggregate with a partial phase; a row of numbers reaches the driver.
    """
    if not names:
        return {}
    found = []
    for name in names:
        v = F.col(f"`{name}`")
        count = lambda c: F.count_if(c)
        found.append(F.struct(
            F.count(v).alias("values"),
            *[count(v.isNotNull() & ~_fits(k, v)).alias(k) for k in _FORMS],
            F.coalesce(F.max(F.length(F.regexp_extract(v, r"^[+-]?([0-9]*)", 1))), F.lit(0)).alias("before"),
            F.coalesce(F.max(F.length(F.regexp_extract(v, r"\.([0-9]*)$", 1))), F.lit(0)).alias("behind")))
    row = raw.agg(*[f.alias(f"s{i}") for i, f in enumerate(found)]).first()
    return {n: row[i].asDict() for i, n in enumerate(names)}


def merge(a: dict | None, b: dict) -> dict:
    """Summary of the values of both."""
    if not a:
        return dict(b)
    return {k: max(a[k], v) if k in ("before", "behind") else a[k] + v for k, v in b.items()}


def type_of(summary: dict) -> str:
    """The narrowest type that holds all values; text such as ``0012`` is no number."""
    s = summary
    if not s["values"]:
        return "string"
    if not s["boolean"]:
        return "boolean"
    if not s["whole"]:
        return "int" if s["before"] <= 9 else "bigint" if s["before"] <= 18 else \
            f"decimal({s['before']},0)" if s["before"] <= 38 else "string"
    if not s["decimal"] and s["before"] + s["behind"] <= 38:
        return f"decimal({s['before'] + s['behind']},{s['behind']})"
    if not s["float"]:
        return "double"
    if not s["date"]:
        return "date"
    return "string" if s["timestamp"] else "timestamp"


# --- the registry -----------------------------------------------------------------------

class Registry:
    """Layouts and the growing schema of one source, as notes ``<root>/v=<n>``.

    Columns are never dropped or renamed and types never narrow; a note is
    added only when something is new, and the newest one counts.
    """

    def __init__(self, spark: SparkSession, root: str, declared: StructType):
        self.spark, self.root, self.declared = spark, root, declared
        notes = read_notes(spark, root, "v")
        self.version, note = notes[-1] if notes else (0, {})
        self.layouts: list[list[str]] = note.get("layouts", [])
        self.summaries: dict[str, dict] = note.get("summaries", {})
        self.order: list[str] = note.get("columns", [])      # added columns, in the order they came

    def added(self) -> list[StructField]:
        return [StructField(n, data_type(type_of(self.summaries[n]))) for n in self.order]

    def schema(self) -> StructType:
        """Declared columns, then added ones."""
        return StructType([*self.declared.fields, *self.added()])

    def column(self, name: str) -> str | None:
        """The schema's column that a header's name means (case does not matter)."""
        return {n.lower(): n for n in [*self.declared.fieldNames(), *self.order]}.get(name.lower())

    def take(self, groups: dict[tuple[str, ...], DataFrame]) -> None:
        """Learn the layouts of new files and the values of their undeclared columns."""
        before = (self.layouts[:], self.order[:], self.schema().json())
        declared = {n.lower() for n in self.declared.fieldNames()}
        for names, raw in groups.items():
            if list(names) not in self.layouts:
                self.layouts.append(list(names))
            new = [n for n in names if n.lower() not in declared]
            for name, summary in summarise(raw, new).items():
                column = self.column(name) or name
                if column not in self.order:
                    self.order.append(column)
                self.summaries[column] = merge(self.summaries.get(column), summary)
        if before != (self.layouts, self.order, self.schema().json()):
            self.version += 1
            write_note(self.spark, f"{self.root}/v={self.version}",
                       {"layouts": self.layouts, "summaries": self.summaries, "columns": self.order})


def data_type(ddl: str) -> DataType:
    return _parse_datatype_string(f"x {ddl}").fields[0].dataType


# --- reading and binding ----------------------------------------------------------------

def read_layout(spark: SparkSession, files: list[str], names: tuple[str, ...], options: dict | None = None) -> DataFrame:
    """Files of one layout as text columns, with ``LINE`` where a line has more or fewer values."""
    r = spark.read.schema(StructType([StructField(n, StringType()) for n in (*names, LINE)]))
    r = r.options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, **(options or {}))
    return r.csv([plain_path(f) for f in files])


def bind(raw: DataFrame, names: tuple[str, ...], registry: Registry, path: Column) -> DataFrame:
    """``raw`` by name and type: the schema's columns and ``RESCUED``.

    A value that its column's type can't hold is null there and stays as raw
    text in ``RESCUED``, as does a line that doesn't fit the header.  A declared column that the
    header lacks is taken from a ``name=value`` folder of the file's path, or null.
    """
    have = {registry.column(n): n for n in names}
    out, lost = [], []
    for f in registry.schema().fields:
        if f.name in have:
            text = F.col(f"`{have[f.name]}`")
            value = text if isinstance(f.dataType, StringType) else text.try_cast(f.dataType)
            if not isinstance(f.dataType, StringType):
                lost.append((f.name, F.when(text.isNotNull() & value.isNull(), text)))
        else:
            part = F.regexp_extract(path, f"/{re.escape(f.name)}=([^/]+)/", 1)
            value = F.when(part != "", part).try_cast(f.dataType)
        out.append(value.alias(f.name))
    if LINE in raw.columns:
        lost.append((LINE, F.col(LINE)))
    rescued = F.lit(None).cast("string")
    if lost:
        pairs = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in lost]), F.array(*[c for _, c in lost]))
        kept = F.map_filter(pairs, lambda _, v: v.isNotNull())
        rescued = F.when(F.size(kept) > 0, F.to_json(kept))
    return raw.select(*out, rescued.alias(RESCUED), path.alias("_sourcefile"))
