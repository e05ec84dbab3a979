"""The driver's Parquet tables re-expressed in the claims layout.

Role mapping (fixed, documented in the README):

* person = customer (``c_custkey``); claim = order (``o_orderkey``);
  service date = ``o_orderdate`` as a date; payment = ``o_totalprice``.
* file type = order status: F inpatient, O outpatient, P carrier.
* primary diagnosis = the order priority's number, zero-padded to three
  characters like an ICD code ('1-URGENT' -> '001').
* diagnosis code slots = the distinct part brands of the order's lines;
  procedure code slots = the distinct part types of the order's lines;
  the claim's procedure code = the smallest part type, 'Unknown' when the
  order has no lines (C3).
* beneficiary = customer: sex = market segment, state = nation key,
  coverage = account balance (covered when >= 1).
* the diagnosis description lookup = nation (code = nation key zero-padded
  to three characters, description = nation name).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.cleaning import impute_code

STATUS_TO_TYPE = {"F": "inpatient", "O": "outpatient", "P": "carrier"}

# Declared schemas of the driver tables (fixed values), so a scan needs no
# footer read for schema inference.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table (declared schema)."""
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _file_type(col: str) -> F.Column:
    expr = F.when(F.lit(False), F.lit(None))
    for k, v in STATUS_TO_TYPE.items():
        expr = expr.when(F.col(col) == k, F.lit(v))
    return expr


def _ts(d: str | dt.date) -> F.Column:
    return F.lit(str(d)).cast("timestamp_ntz")


def claims(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None,
           codes: bool = False, proc: bool = False, types: list[str] | None = None) -> DataFrame:
    """Orders as claims, optionally restricted to service dates [start, end]
    (inclusive, pushed to the Parquet scan on the raw timestamp column) and
    to file ``types`` (pushed as a filter on the raw status column),
    optionally with the code-slot arrays (``codes``) or the claim's
    procedure code (``proc``)."""
    o = table(spark, sf_dir, "orders")
    if types:
        statuses = [k for k, v in STATUS_TO_TYPE.items() if v in types]
        o = o.filter(F.col("o_orderstatus").isin(*statuses))
    if start:
        o = o.filter(F.col("o_orderdate") >= _ts(start))
    if end:
        end_excl = dt.date.fromisoformat(end) + dt.timedelta(days=1)
        o = o.filter(F.col("o_orderdate") < _ts(end_excl))
    out = o.select(
        F.col("o_custkey").alias(S.PERSON),
        F.col("o_orderkey").alias(S.CLAIM),
        F.to_date("o_orderdate").alias(S.DATE),
        F.col("o_totalprice").alias(S.AMOUNT),
        _file_type("o_orderstatus").alias(S.FILE_TYPE),
        F.lpad(F.substring_index("o_orderpriority", "-", 1), 3, "0").alias(S.DX),
    )
    if codes or proc:
        oc = order_codes(spark, sf_dir)
        out = out.join(oc, out[S.CLAIM] == oc["l_orderkey"], "left").drop("l_orderkey")
        if proc:
            out = out.withColumn(S.PROC, impute_code(F.array_min(S.HCPCS)))
        if not codes:
            out = out.drop(S.ICD, S.HCPCS)
    return out


def order_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code slots per order: distinct brands and distinct types of its lines.

    lineitem x part is a shuffle join on the part key (part grows with the
    scale factor, so it is not forced to broadcast; AQE broadcasts it when
    its measured size allows).  The per-order sets are bounded by the lines
    of one order.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_set("p_brand")).alias(S.ICD),
                 F.array_sort(F.collect_set("p_type")).alias(S.HCPCS)))


def attach_codes(spark: SparkSession, sf_dir: str, claims: DataFrame) -> DataFrame:
    """Code-slot arrays for the given claims (NULL where an order has no lines):
    claims to line items to parts by left joins, then one row per claim again.
    ``claims`` is evaluated once, and the line items are the streamed side of
    a join AQE can split."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("_ok"), F.col("l_partkey").alias("_pk"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_p"), "p_brand", "p_type")
    lines = claims.join(li, F.col(S.CLAIM) == F.col("_ok"), "left").join(p, F.col("_pk") == F.col("_p"), "left")

    def codes(c):
        return F.when(F.count("_p") > 0, F.array_sort(F.collect_set(c)))

    return lines.groupBy(*claims.columns).agg(codes("p_brand").alias(S.ICD), codes("p_type").alias(S.HCPCS))


def orders_with_brand(spark: SparkSession, sf_dir: str, brand: str) -> DataFrame:
    """Order keys having a line of a part with ``brand`` (the brand filter is
    pushed into the part scan; the part keys of one brand are a small side)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").filter(F.col("p_brand") == brand).select("p_partkey")
    hits = li.join(p, li.l_partkey == p.p_partkey, "left_semi").select(F.col("l_orderkey").alias(S.CLAIM))
    return hits.distinct()  # one row a task for an order with very many lines


def beneficiaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as beneficiaries (person, sex, state, coverage, balance)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias(S.PERSON),
        F.col("c_mktsegment").alias("sex"),
        F.col("c_nationkey").cast("string").alias("state"),
        F.col("c_acctbal").alias("coverage"),
    )


def dx_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation as the diagnosis description file: (code, description)."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("code"),
                    F.col("n_name").alias("description"))
