"""Landing and canonical tables: reading with defaults, loading reference data."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.time import Clock
from sieveline.sources.schemas import DEFAULTS, NOW, SCHEMAS

LAYERS = ("raw", "canonical")


def conform(df: DataFrame, table: str, clock: Clock) -> DataFrame:
    """Give rows of one kind of extract the table's columns and types.

    A column the extract leaves out takes its default; a column that is there
    keeps its NULLs.  Columns the table does not know are dropped, so the scan
    reads only what a job uses.
    """
    present = {name.lower(): name for name in df.columns}
    defaults = DEFAULTS.get(table, {})
    columns = []
    for field in SCHEMAS[table].fields:
        if field.name in present:
            col = F.col(present[field.name])
        elif defaults.get(field.name) is NOW:
            col = clock.now
        else:
            col = F.lit(defaults.get(field.name))
        columns.append(col.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def data_files(spark: SparkSession, path: str, missing_ok: bool = False) -> list[str]:
    """Every data file under a folder; names that start with `.` or `_` are none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if missing_ok and not fs.exists(root):
        return []
    found, folders = [], [root]
    while folders:
        for item in fs.listStatus(folders.pop()):
            if item.getPath().getName().startswith((".", "_")):
                continue
            if item.isDirectory():
                folders.append(item.getPath())
            else:
                found.append(item.getPath().toString())
    return sorted(found)


def _kind(fmt: str, path: str) -> str | None:
    """What a file says about its columns in its footer or first line; None if it cannot be opened here."""
    from pyarrow import fs

    scheme = urlsplit(path).scheme
    try:
        if scheme in ("", "file"):
            system, place = fs.LocalFileSystem(), urlsplit(path)._replace(scheme="", netloc="").geturl() if scheme else path
        else:
            system, place = fs.FileSystem.from_uri(quote(path, safe=":/@"))
        if fmt == "csv":
            with system.open_input_stream(place) as stream:
                head = b""
                while b"\n" not in head and (more := stream.read(1 << 14)):
                    head += more
                return head.split(b"\n")[0].decode("utf-8", "replace").strip()
        with system.open_input_file(place) as file:
            if fmt == "orc":
                from pyarrow import orc

                return orc.ORCFile(file).schema.to_string()
            from pyarrow import parquet

            found = parquet.read_metadata(file)
            columns = [str(found.schema.column(i)) for i in range(len(found.schema))]
            return "\n".join([*columns, (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()])
    except Exception:  # whatever the worker's own file system cannot do, Spark's reader may
        return None


def _kinds(fmt: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = pa.array([_kind(fmt, file) for file in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), kinds], ["file", "kind"])

    return look


def file_kinds(spark: SparkSession, files: list[str], fmt: str) -> DataFrame:
    """(file, kind): files of equal kind have equal columns.  One job, whose tasks read footers and first lines only.

    JSON has neither: there the kind is the set of keys in a file's lines, found by one scan of all files.
    """
    if fmt == "json":
        lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.explode_outer(F.json_object_keys("value")).alias("key"))
        keys = lines.groupBy("file").agg(F.to_json(F.sort_array(F.collect_set("key"))).alias("kind"))
        return keys.select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"), "kind")
    listed = spark.createDataFrame([(file,) for file in files], "file string")
    slots = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    return listed.repartition(slots).mapInArrow(_kinds(fmt), "file string, kind string")


def _same(path: str) -> str:
    """A file's path without the ways in which Spark and Hadoop write the scheme of local ones."""
    return path.replace("file://", "file:").replace("file://", "file:")


def file_groups(
    spark: SparkSession, files: list[str], fmt: str, catalogue: str | None = None
) -> list[tuple[str | None, list[str]]]:
    """Files by kind; with a catalogue (a folder), files that are listed there are not looked at again."""
    known: dict[str, str] = {}
    if catalogue and data_files(spark, catalogue, missing_ok=True):
        known = {row.file: row.kind for row in spark.read.schema("file string, kind string").parquet(catalogue).collect()}
    new = [file for file in files if file not in known]
    if new:
        by_name = {_same(file): file for file in new}
        rows = [(by_name[_same(row.file)], row.kind) for row in file_kinds(spark, new, fmt).collect() if _same(row.file) in by_name]
        known |= dict(rows)
        if catalogue:
            spark.createDataFrame([row for row in rows if row[1] is not None], "file string, kind string").coalesce(1).write.mode("append").parquet(catalogue)
    groups: dict[str, list[str]] = defaultdict(list)
    for file in files:
        kind = known.get(file)
        groups[f"?{file}" if kind is None else f"={kind}"].append(file)
    return [(key[1:] if key[0] == "=" else None, same) for key, same in groups.items()]


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    clock: Clock,
    layer: str = "raw",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    catalogue: str | None = None,
) -> DataFrame:
    """Read one table of a layer from `root/layer/table` (parquet, orc, csv or json).

    Extracts in one folder may have different columns.  Files are read in groups
    of equal columns and types, so a default fills a column only where the file
    itself lacks it, and what a file states, NULL included, stays.  The groups come from one job over the files'
    footers or first lines (for json, their keys; see `file_kinds`), and the schema of a group from one of its files.
    `catalogue` names a folder that remembers files already looked at.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")

    def reader():
        new = spark.read.format(fmt).options(**(options or {}))
        if fmt == "csv":
            new = new.option("header", "true").option("escape", '"')
        if fmt == "json":
            new = new.option("primitivesAsString", "true")
        return new

    files = data_files(spark, f"{root}/{layer}/{table}")
    if not files:
        return spark.createDataFrame([], SCHEMAS[table])
    if any(name.lower() == "multiline" and str(value).lower() == "true" for name, value in (options or {}).items()):
        groups = [(None, [file]) for file in files]  # lines say nothing there
    else:
        groups = file_groups(spark, files, fmt, catalogue)
    parts = []
    for kind, same in groups:
        if fmt == "json" and kind is not None:
            schema = T.StructType([T.StructField(key, T.StringType()) for key in json.loads(kind)])
        else:
            schema = reader().load(same[0]).schema
        if len(schema):
            parts.append(conform(reader().schema(schema).load(same), table, clock))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SCHEMAS[table])


def one_per_key(rows: DataFrame, keys: list[str], newest: str | None = None) -> DataFrame:
    """One row of each key: of equal ones the newest, then the greatest by content, wherever they lie."""
    order = ([newest] if newest in rows.columns else []) + [c for c in rows.columns if c not in keys and c != newest]
    if not order:
        return rows.distinct()
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("best"))
    return best.select(*[F.col(c) if c in keys else F.col("best")[c].alias(c) for c in rows.columns])


def add_new_keys(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert rows whose key is not there yet; rows with a known key are skipped.

    Facilities are known by their `mfl_code`.
    """
    fresh = one_per_key(incoming, keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert_patients(canonical: DataFrame, changes: DataFrame, clock: Clock) -> DataFrame:
    """Replace canonical patients by key and stamp `updated_at` on the changed rows."""
    latest = one_per_key(changes, ["patient_id"], newest="updated_at").withColumn("updated_at", clock.now)
    untouched = canonical.join(latest.select("patient_id"), "patient_id", "left_anti")
    return untouched.select(*canonical.columns).unionByName(latest.select(*canonical.columns))
