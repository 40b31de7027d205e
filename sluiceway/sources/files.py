"""File sources: recursive scans, the raw zone, feedback counts."""

from __future__ import annotations

import re

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluiceway.schemas import RAW_RECORD
from sluiceway.sources.envelope import to_raw_envelope

JSON_LINES = "*.{jsonl,json}"


def _scan(spark: SparkSession, fmt: str, path: str, glob: str, schema: T.StructType | None = None, **options) -> DataFrame | None:
    """All files below a path whose name fits; None when there are none."""
    reader = spark.read.format(fmt).options(recursiveFileLookup="true", pathGlobFilter=glob, **options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return None
        raise
    # With a given schema an empty listing is no error; look at the file list.
    return df if schema is None or df.inputFiles() else None


def _union(frames: list[DataFrame | None], path: str) -> DataFrame:
    found = [f for f in frames if f is not None]
    if not found:
        raise FileNotFoundError(f"no data files under {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def scan_batch(
    spark: SparkSession, path: str, name: str = "*", id_col: str = "id", csv_schema: T.StructType | None = None
) -> DataFrame:
    """Envelopes of all Parquet and CSV rows below a path; `name` narrows the file names.

    One scan per format. Files of one format may differ in columns. CSV types are inferred unless
    given, which costs a pass over the files.
    """
    parquet = _scan(spark, "parquet", path, f"{name}.parquet", mergeSchema="true")
    csv_types = {} if csv_schema is not None else {"inferSchema": "true"}
    csv = _scan(spark, "csv", path, f"{name}.csv", csv_schema, header="true", **csv_types)
    return _union([f if f is None else to_raw_envelope(f, id_col) for f in (parquet, csv)], path)


def load_raw(
    spark: SparkSession,
    path: str,
    json_schema: T.StructType | None = None,
    exclude: tuple[str, ...] = (),
) -> DataFrame:
    """All JSON-lines and Parquet rows below a path as one table, matched by column name.

    Every file counts, whatever its folder; those below folders named in `exclude` are left out. JSON types are inferred unless a schema is given; the raw
    zone's own files are read with `RAW_RECORD` (see `load_raw_records`).
    """
    frames = [
        _scan(spark, "json", path, JSON_LINES, json_schema),
        _scan(spark, "parquet", path, "*.parquet", mergeSchema="true"),
    ]
    return _union([f if f is None else _outside(f, exclude, path) for f in frames], path)


def load_raw_records(spark: SparkSession, path: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """The envelopes of the raw zone; a nested payload object is read as its JSON text."""
    return load_raw(spark, path, RAW_RECORD, exclude)


def _outside(df: DataFrame, folders: tuple[str, ...], root: str) -> DataFrame:
    """Rows of files in none of the folders; only what lies below the scanned root counts.

    File names are complete and escaped, the root may be neither: it is looked for as a part of the name.
    """
    if not folders:
        return df
    base = "/" + re.sub(r"^\w+:/*|^(\./)+", "", root).strip("/") + "/"
    full = F.regexp_replace("_metadata.file_path", r"^\w+:/+", "/")
    full = F.coalesce(F.try_url_decode(F.regexp_replace(full, r"\+", "%2B")), full)
    at = F.locate(base, full)
    file = F.when(at > 0, F.substr(full, at + F.lit(len(base) - 1))).otherwise(full)
    for folder in folders:
        df = df.where(~file.contains(f"/{folder}/"))
    return df


def feedback_count(spark: SparkSession, path: str) -> DataFrame:
    """One row, `feedback_rows`: lines of the JSON files directly in a folder; 0 when there is none."""
    try:
        lines = spark.read.option("pathGlobFilter", JSON_LINES).text(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return lines.agg(F.count(F.lit(1)).alias("feedback_rows"))
