"""Staged claims layout: tables that the cohort queries join without a shuffle.

Claims (with their code arrays) are bucketed and sorted by person and
partitioned by service month; index dates are bucketed by person in the same
number of buckets.  The lookback join and the per-person aggregate then run
bucket by bucket, and month filters prune folders.

A bucket is read by one task, so people with more than ``hot_rows`` claims are
kept apart in a plain table: their few index rows are joined to it by the
planner's own choice of join, and their aggregate has a partial phase.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlens import schemas as S
from cohortlens.operators import features as fe
from cohortlens.session import shared_folder

MONTH = "service_month"


@dataclass
class Layout:
    """Names of the bucketed tables, and the folder of the hot people's claims."""

    spark: SparkSession
    folder: str
    buckets: int
    claims: str
    hot: str
    schema: StructType
    index: str | None = None

    def months(self, name_or_path: str, start, end) -> DataFrame:
        """Claims of the months from ``start`` to ``end`` (dates), by folder."""
        df = self.spark.table(name_or_path) if "/" not in name_or_path else self.spark.read.schema(self.schema).parquet(name_or_path)
        if start is not None:
            df = df.where(F.col(MONTH) >= F.lit(f"{start:%Y-%m}"))
        if end is not None:
            df = df.where(F.col(MONTH) <= F.lit(f"{end:%Y-%m}"))
        return df


def _bucketed(df: DataFrame, name: str, path: str, buckets: int, sort: Sequence[str], partition: str | None = None) -> str:
    writer = df.repartition(buckets, S.PERSON).write.bucketBy(buckets, S.PERSON).sortBy(*sort).option("path", path)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)
    return name


def stage_claims(claims: DataFrame, buckets: int = 64, hot_rows: int = 1_000_000, folder: str | None = None) -> Layout:
    """Write the claims once as a layout below ``folder`` (default: a new one of the shared store)."""
    spark = claims.sparkSession
    tag = uuid.uuid4().hex[:12]
    folder = folder or f"{shared_folder(spark).rstrip('/')}/layout-{tag}"
    claims = claims.where(F.col(S.PERSON).isNotNull()).withColumn(MONTH, F.date_format(S.DATE, "yyyy-MM"))
    claims.write.partitionBy(MONTH).parquet(f"{folder}/all")  # read twice below: for the counts and for the tables
    every = spark.read.schema(claims.schema).parquet(f"{folder}/all")
    hot = every.groupBy(S.PERSON).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(S.PERSON)
    _bucketed(every.join(hot, S.PERSON, "left_anti"), f"claims_{tag}", f"{folder}/claims", buckets, [S.PERSON, S.DATE], MONTH)
    every.join(hot, S.PERSON, "left_semi").write.partitionBy(MONTH).parquet(f"{folder}/hot")
    return Layout(spark, folder, buckets, f"claims_{tag}", f"{folder}/hot", claims.schema)


def stage_index(layout: Layout, index_dates: DataFrame) -> Layout:
    """Write the index dates in the claims' buckets."""
    layout.index = _bucketed(index_dates, layout.claims.replace("claims", "index"), f"{layout.folder}/index", layout.buckets, [S.PERSON])
    return layout


def staged_window(layout: Layout, days: int) -> tuple[DataFrame, DataFrame]:
    """J6 over the layout: (window of the bucketed claims, window of the hot people's claims).

    The months read follow from the staged index dates (one aggregate, one row)."""
    index = layout.spark.table(layout.index)
    first, last = index.agg(F.date_sub(F.min(S.INDEX_DATE), days), F.max(S.INDEX_DATE)).first()
    return tuple(fe.lookback(index, layout.months(t, first, last).drop(MONTH), days) for t in (layout.claims, layout.hot))


def staged_features(layout: Layout, demographics: DataFrame | None, days: int, icd_codes: Sequence[str] = (),
                    hcpcs_codes: Sequence[str] = (), pairs: Sequence[tuple[str, str]] = (),
                    types: Sequence[str] = tuple(S.CLAIM_TYPES)) -> DataFrame:
    """Q6 over the layout: one join and one aggregate per bucket, no exchange of claims."""
    aggs = fe.feature_aggregates(days, icd_codes, hcpcs_codes, pairs, types)
    usual, hot = (w.groupBy(*fe.KEYS).agg(*aggs) for w in staged_window(layout, days))
    index = layout.spark.table(layout.index)
    out = index.join(usual, fe.KEYS, "left")
    names = [c for c in usual.columns if c not in fe.KEYS]
    of_hot = hot.select(*[F.col(k).alias(f"_{k}") for k in fe.KEYS], *[F.col(c).alias(f"_{c}") for c in names])
    out = out.join(of_hot, F.col(S.PERSON) == F.col(f"_{S.PERSON}"), "left")
    out = out.select(*fe.KEYS, *[F.coalesce(c, f"_{c}", F.lit(0.0 if "_amt_" in c else 0)).alias(c) for c in names])
    return out if demographics is None else out.join(demographics, S.PERSON, "left")
