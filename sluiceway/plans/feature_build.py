"""Raw zone to train, validation and test features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluiceway.operators.clean import flatten_payload, validate
from sluiceway.operators.features import FeatureTransformer, engineer
from sluiceway.operators.split import with_split
from sluiceway.schemas import RAW_RECORD
from sluiceway.session import to_scratch_table
from sluiceway.sources.files import load_raw

SPLITS = ("train", "val", "test")


def prepare(raw: DataFrame, keep_envelope: bool = False, payload_schema: T.StructType | None = None) -> DataFrame:
    """Flatten, validate and engineer raw rows.

    Flattening comes first: text inside a payload gets its features, and rows can be compared. The
    envelope's own columns differ between ingests of the same row, so they take part in the
    deduplication only on request. A given payload schema saves the pass that infers it.
    """
    flat = raw
    if "payload" in raw.columns:
        if not keep_envelope:
            raw = raw.select("payload", *[c for c in raw.columns if c not in RAW_RECORD.names])
        flat = flatten_payload(raw, schema=payload_schema)
    return engineer(validate(flat))


def build_features(
    spark: SparkSession,
    raw_path: str,
    features_path: str,
    transformer: FeatureTransformer | None = None,
    id_col: str | None = None,
    train: float = 0.8,
    val: float = 0.1,
    seed: int = 42,
    json_schema: T.StructType | None = RAW_RECORD,
    payload_schema: T.StructType | None = None,
) -> dict[str, str]:
    """The whole feature job; returns the path of each split.

    The prepared rows are written once to the shared folder, because the split search, the fit and the
    output all read them. The output is one table partitioned by split, so a reader of one split
    opens only its files.
    """
    transformer = transformer or FeatureTransformer()
    prepared = to_scratch_table(prepare(load_raw(spark, raw_path, json_schema), payload_schema=payload_schema), "prepared")
    labelled = with_split(prepared, id_col=id_col, train=train, val=val, seed=seed)
    transformer.fit(labelled.where(F.col("split") == "train"))
    made = transformer.transform(labelled)
    made.write.mode("overwrite").partitionBy("split").parquet(features_path)
    filled = {r.split for r in labelled.select("split").distinct().collect()}
    for name in set(SPLITS) - filled:  # an empty split has a folder too
        made.where(F.col("split") == name).drop("split").write.mode("overwrite").parquet(f"{features_path}/split={name}")
    return {name: f"{features_path}/split={name}" for name in SPLITS}
