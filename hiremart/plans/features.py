"""All-integer feature matrix plus lookup indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import feature_type_code
from ..functions.text import UNKNOWN
from ..operators.materialize import broadcast_if_small, materialize
from ..operators.numbering import dense_index


def industry_lookup(long: DataFrame) -> DataFrame:
    """Distinct (industry_id, industry_name) of the requirement tables."""
    return long.select("industry_id", "industry_name").distinct()


def location_features(by_location: DataFrame, lookup: DataFrame) -> DataFrame:
    """J3 + T18: industry-by-location counts as 'location' features.

    The lookup is joined on the industry *name*; a name has one id (the id
    is a function of the name), so the join never duplicates rows.
    """
    lk = broadcast_if_small(materialize(lookup.select(F.col("industry_name").alias("_lk_name"), F.col("industry_id").alias("_lk_id"))))
    j = by_location.join(lk, by_location["industry_name"] == lk["_lk_name"], "left")
    return j.select(
        F.coalesce(F.col("_lk_id"), F.lit(UNKNOWN)).alias("industry_id"),
        F.coalesce(F.col("industry_name"), F.lit(UNKNOWN)).alias("industry_name"),
        F.lit("location").alias("feature_type"),
        F.coalesce(F.col("location_name"), F.lit(UNKNOWN)).alias("feature_value"),
        F.coalesce(F.col("total_jobs"), F.lit(0)).cast("long").alias("total_jobs"),
    )


def merged_features(long: DataFrame, by_location: DataFrame) -> DataFrame:
    """U1 + U2: requirement features and location features, rows kept as-is."""
    cols = ["industry_id", "industry_name", "feature_type", "feature_value", "total_jobs"]
    return long.select(*cols).unionByName(location_features(by_location, industry_lookup(long)).select(*cols))


def industry_index(merged: DataFrame) -> DataFrame:
    """industry_idx 1..n over sorted distinct industry ids."""
    return dense_index(merged.select("industry_id").distinct(), ["industry_id"], "industry_idx").select(
        "industry_idx", "industry_id"
    )


def feature_value_index(merged: DataFrame) -> DataFrame:
    """feature_value_idx 1..n over sorted distinct (feature_type, feature_value)."""
    d = merged.select("feature_type", "feature_value").distinct()
    return dense_index(d, ["feature_type", "feature_value"], "feature_value_idx").select(
        "feature_value_idx", "feature_type", "feature_value"
    )


def feature_matrix(merged: DataFrame, ind_index: DataFrame, fv_index: DataFrame) -> DataFrame:
    """J4 + J5 + T17 + T18: four BIGINT columns per merged feature row.

    Unmatched industry -> -1; unmatched (type, value), including a NULL
    value (plain equality never matches NULL) -> 0.  Both indexes are
    unique on their keys, so no row is duplicated.  The industry index is
    small (one row per industry) and broadcast after a size check; the
    value index grows with the vocabulary and joins by shuffle when large.
    Callers pass computed indexes (written tables or materialized frames).
    """
    ii = broadcast_if_small(ind_index)
    fv = broadcast_if_small(fv_index.withColumnRenamed("feature_type", "_fv_type").withColumnRenamed("feature_value", "_fv_value"))
    j = merged.join(ii, "industry_id", "left")
    j = j.join(fv, (j["feature_type"] == fv["_fv_type"]) & (j["feature_value"] == fv["_fv_value"]), "left")
    return j.select(
        F.coalesce(F.col("industry_idx"), F.lit(-1)).cast("long").alias("industry_idx"),
        feature_type_code(F.col("feature_type")).alias("feature_type_idx"),
        F.coalesce(F.col("feature_value_idx"), F.lit(0)).cast("long").alias("feature_value_idx"),
        F.coalesce(F.col("total_jobs"), F.lit(0)).cast("long").alias("feature_count"),
    )


#: Feature values of one sparse row, at most.
ROW_WIDTH = 4096


def summed_features(matrix: DataFrame) -> DataFrame:
    """U2, summing: rows of the matrix that fall on one (industry, type, value) cell become one, counts added.

    Off by default, as names that share a slug keep their rows in the reference."""
    return matrix.groupBy("industry_idx", "feature_type_idx", "feature_value_idx").agg(F.sum("feature_count").cast("long").alias("feature_count"))


def sparse_rows(matrix: DataFrame, width: int = ROW_WIDTH) -> DataFrame:
    """The summed matrix as sparse rows: for each industry and block of ``width`` value indexes
    one row with its cells, sorted by (value, type), as an array of structs.

    A block bounds the array: a value index has one type, but for index 0 (no match), which has one cell a type."""
    cell = F.struct("feature_value_idx", "feature_type_idx", "feature_count")
    blocks = summed_features(matrix).withColumn("block", F.expr(f"feature_value_idx div {width}"))
    return blocks.groupBy("industry_idx", "block").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
