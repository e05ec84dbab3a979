"""Parameters of the driver-table study (fixed values, see README)."""

YEAR = 1998                 # study year (has ISO week 53, trap K5)
TOP_N = 100                 # top people by payment (reference default)
CASE_CODE = "Brand#7"       # case-defining diagnosis code
CLAIM_START = "1997-12-02"  # claim load window (C8), year-1 Dec 2 .. year end
CLAIM_END = "1998-12-31"
CONTROL_START = "1998-01-01"  # control index-date window (C8)
CONTROL_END = "1998-12-25"
LOOKBACK_DAYS = 180
SEED = 42
# Diagnosis codes for features: every part brand, Brand#1 .. Brand#25.
ICD_CODES = [f"Brand#{i}" for i in range(1, 26)]
# Procedure codes for features: the six part types.
HCPCS_CODES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
