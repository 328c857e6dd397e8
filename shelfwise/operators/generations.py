"""Tables that become visible together, behind one pointer.

A run writes its tables into a folder of its own. When all are whole, one record that names them replaces the pointer in one
rename: a reader sees all of the old ones or all of the new ones, whenever a run is killed. What no record names is
garbage: an aborted run deletes its own, `sweep` that of killed ones. One run at a time publishes to a place; a second that began on
the same record is turned away.

The pointer is a JSON text of a few lines, read and written on the driver through Hadoop's file systems; tables are Parquet that Spark writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

#: Fixed value: the version of the record that this code reads and writes.
SCHEMA_VERSION = 1
_POINTER = "pointer.json"


def _path(spark: SparkSession, at: str):  # type: ignore[no-untyped-def]
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)


def _files(spark: SparkSession, at: str):  # type: ignore[no-untyped-def]
    return _path(spark, at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, at: str) -> bool:
    return _files(spark, at).exists(_path(spark, at))


def removed(spark: SparkSession, at: str) -> bool:
    """Deletes a file or folder; whether there was one."""
    return _files(spark, at).delete(_path(spark, at), True)


def read_text(spark: SparkSession, at: str) -> str | None:
    """A small file's text, none if it isn't there."""
    if not exists(spark, at):
        return None
    stream = _files(spark, at).open(_path(spark, at))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, at: str, text: str) -> None:
    """Writes a small file beside and renames it over the old one, so that no reader sees half of it or none."""
    sc = spark.sparkContext
    jvm, beside = sc._jvm, f"{at}.{uuid.uuid4().hex}"
    out = _files(spark, at).create(_path(spark, beside), True)
    out.write(bytearray(text.encode()))
    out.close()
    options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    whole = _files(spark, at).makeQualified(_path(spark, at))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), sc._jsc.hadoopConfiguration()).rename(_path(spark, beside), whole, options)


@dataclass(frozen=True)
class Run:
    """A run that writes to `at`: its generation, the generation it began on, and how it was started."""

    at: str
    generation: str
    base: str | None
    mode: str = "deep"
    started: str = ""

    def path(self, name: str) -> str:
        return f"{self.at}/generation={quote(self.generation, safe='')}/{quote(name, safe='')}"


def active(spark: SparkSession, at: str) -> dict | None:
    """The record of what is published at `at`, none before the first; a version that this code doesn't know is an error."""
    text = read_text(spark, f"{at}/{_POINTER}")
    if not text:
        return None
    record = json.loads(text)
    if record.get("schema") != SCHEMA_VERSION:
        raise ValueError(f"{at} has a record of an unsupported version {record.get('schema')}: run a full export")
    return record


def begin(spark: SparkSession, at: str, mode: str = "deep", started: str = "", generation: str | None = None) -> Run:
    record = active(spark, at)
    return Run(at, generation or uuid.uuid4().hex, record and record["generation"], mode, started)


def stage(run: Run, name: str, rows: DataFrame) -> DataFrame:
    """Writes one table of the run and reads it back; a retry replaces it. Nobody else sees it yet."""
    rows.write.mode("overwrite").parquet(run.path(name))
    return rows.sparkSession.read.schema(rows.schema).parquet(run.path(name))


def promote(spark: SparkSession, run: Run, names: list[str], completed: str = "", info: Mapping[str, object] | None = None, keep: Mapping[str, str] | None = None) -> dict:
    """K4: publishes the run's tables, and tables of the record before that `keep` names with their paths.

    A fast run inherits the time of the last deep one, a deep run sets it. Folders that the new record doesn't name go after it is written; that
    they can't be deleted is no failure, as the record stands."""
    missing = [n for n in names if not exists(spark, f"{run.path(n)}/_SUCCESS")]
    if missing:
        raise ValueError(f"not written whole: {', '.join(missing)}")
    before = active(spark, run.at)
    if (before and before["generation"]) != run.base:
        raise ValueError(f"another run was published at {run.at} meanwhile")
    deep = completed if run.mode == "deep" else (before or {}).get("last_deep")
    tables = {**(keep or {}), **{n: run.path(n) for n in names}}
    record = {"schema": SCHEMA_VERSION, "generation": run.generation, "mode": run.mode, "started": run.started, "completed": completed, "last_deep": deep, "tables": tables, "info": dict(info or {})}
    replace_text(spark, f"{run.at}/{_POINTER}", json.dumps(record, sort_keys=True))
    for path in set((before or {}).get("tables", {}).values()) - set(tables.values()):
        try:
            removed(spark, path)
        except Exception:  # noqa: BLE001, S110 - the record is durable: a folder that stays is swept later
            pass
    return record


def abort(spark: SparkSession, run: Run) -> bool:
    """K5: deletes the run's folder unless the record names it; what is published stays as it is. Whether anything was deleted."""
    record = active(spark, run.at)
    if record and record["generation"] == run.generation:
        return False
    return removed(spark, f"{run.at}/generation={quote(run.generation, safe='')}")


def sweep(spark: SparkSession, at: str) -> list[str]:
    """Deletes what killed runs left: generations that the record names no table of. Not while another run writes."""
    record = active(spark, at)
    named = {part for path in (record or {}).get("tables", {}).values() for part in path.split("/") if part.startswith("generation=")}
    found = [s.getPath().getName() for s in _files(spark, at).listStatus(_path(spark, at))] if exists(spark, at) else []
    gone = sorted(n for n in found if n.startswith("generation=") and n not in named)
    for name in gone:
        removed(spark, f"{at}/{name}")
    return gone


def publish(spark: SparkSession, at: str, outputs: Mapping[str, DataFrame | Callable[[Mapping[str, DataFrame]], DataFrame]], info: Mapping[str, object] | None = None, mode: str = "deep", started: str = "", completed: str = "", check: Callable[[Run], None] | None = None, generation: str | None = None) -> dict:
    """K8: writes all outputs and publishes them beside the tables of other names, all or none: whatever fails, both old ones stay.

    An output may be a function of the tables staged before it, which reads what they hold rather than making it again. `check` looks at the staged tables before they count and raises if they may not."""
    run = begin(spark, at, mode, started, generation)
    try:
        staged: dict[str, DataFrame] = {}
        for name, rows in outputs.items():
            staged[name] = stage(run, name, rows(staged) if callable(rows) else rows)
        if check:
            check(run)
        before = active(spark, at) or {}
        return promote(spark, run, list(outputs), completed, {**before.get("info", {}), **(info or {})}, before.get("tables"))
    except BaseException:
        abort(spark, run)
        raise


def table(spark: SparkSession, at: str, name: str, schema: str | None = None) -> DataFrame:
    """A published table; one that the record doesn't name is empty if a schema is given, else an error."""
    path = ((active(spark, at) or {}).get("tables") or {}).get(name)
    if path is None and schema is None:
        raise ValueError(f"{at} has no table {name}")
    return spark.createDataFrame([], schema) if path is None else (spark.read.schema(schema) if schema else spark.read).parquet(path)
