"""SQL fragments (DuckDB dialect) mirroring the driver-table role mapping, used
by the oracle queries that check the Spark plans."""

from __future__ import annotations

import datetime as dt


def _ts_range(start: str | None, end: str | None) -> str:
    conds = []
    if start:
        conds.append(f"o_orderdate >= TIMESTAMP '{start}'")
    if end:
        end_excl = dt.date.fromisoformat(end) + dt.timedelta(days=1)
        conds.append(f"o_orderdate < TIMESTAMP '{end_excl}'")
    return ("WHERE " + " AND ".join(conds)) if conds else ""


FILE_TYPE_SQL = ("CASE o_orderstatus WHEN 'F' THEN 'inpatient' WHEN 'O' THEN 'outpatient' "
                 "WHEN 'P' THEN 'carrier' END")

ORDER_CODES_SQL = """
SELECT l_orderkey,
       list_sort(list_distinct(list(p_brand))) AS icd_codes,
       list_sort(list_distinct(list(p_type))) AS hcpcs_codes,
       min(p_type) AS min_type
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_orderkey"""


def claims_sql(start: str | None = None, end: str | None = None, codes: bool = False,
               proc: bool = False) -> str:
    base = f"""
SELECT o_custkey AS person_id, o_orderkey AS claim_id, CAST(o_orderdate AS DATE) AS claim_date,
       o_totalprice AS claim_amt, {FILE_TYPE_SQL} AS file_type,
       lpad(split_part(o_orderpriority, '-', 1), 3, '0') AS primary_dx
FROM orders {_ts_range(start, end)}"""
    if not (codes or proc):
        return base
    extra = []
    if codes:
        extra += ["oc.icd_codes", "oc.hcpcs_codes"]
    if proc:
        extra.append("coalesce(nullif(oc.min_type, 'None'), 'Unknown') AS prcdr_drg_cd")
    return f"""
SELECT b.*, {', '.join(extra)}
FROM ({base}) b LEFT JOIN ({ORDER_CODES_SQL}) oc ON b.claim_id = oc.l_orderkey"""


MONEY_SUM = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
