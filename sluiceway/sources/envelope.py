"""The raw envelope around rows of any source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.functions.columns import quoted, row_json
from sluiceway.schemas import RAW_RECORD, SCHEMA_VERSION


def envelope(df: DataFrame, id_: Column, source: Column, payload: Column, timestamp: Column | None = None) -> DataFrame:
    """RAW_RECORD rows; a null id becomes a random one, a missing time is now."""
    columns = {
        "id": F.coalesce(id_.cast("string"), F.expr("uuid()")),
        "source": source,
        "timestamp": timestamp if timestamp is not None else F.current_timestamp(),
        "payload": payload,
        "schema_version": F.lit(SCHEMA_VERSION),
    }
    return df.select(*[columns[f.name].alias(f.name) for f in RAW_RECORD.fields])


def to_raw_envelope(df: DataFrame, id_col: str = "id", source: Column | None = None) -> DataFrame:
    """Envelope of table rows: the whole row is the payload, the file it was read from the source.

    Give `source` for a table which was not read from files.
    """
    id_ = quoted(id_col) if id_col in df.columns else F.lit(None)
    from_ = source if source is not None else F.col("_metadata.file_path")
    return envelope(df, id_, from_, row_json(df.columns))
