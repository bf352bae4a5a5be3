"""Parameters of the registered queries.

The reference's own values are the function defaults; where the given
tables make a reference value select nothing (regions, discounts capped at
0.10, a catalogue priced 900-1000), the registered query uses the value
below instead and says why.
"""

REGION = "AMERICA"  # reference: 'West' (not a region of the given tables)
CATEGORY = "PROMO"  # reference: 'Technology'
YEAR = 1997  # reference: 2023 / 2017; the data span 1995-2001
MIN_SALES = 1000
TOP_K = 10
DUP_K = 5
RANK_K = 5
TIER_EDGES = (0.03, 0.06)  # reference: 0.20 / 0.40; discounts here run 0.00-0.10
CANNIBAL_MIN_DISCOUNT = 0.05  # reference: 0.2
CANNIBAL_MAX_IMPACT = 400000  # reference: 0
HOT_FACTOR = 1.5
YOY_LAG = 12
PARETO_LIMIT = 80
ELITE_DAYS, STANDARD_DAYS = 2, 5
ROLLING_ROWS = 3
PREMIUM_PRICE = 910  # reference: 5000; list prices here are 900-1000
CLEAN_REGION = "America"  # reference: 'West'
MIN_PAYMENT_COUNT = 100
AGE_LOW, AGE_HIGH, GENDER = 18, 30, "F"
SEED = 42
LOAD_TIME = "2025-01-01 00:00:00"  # fixed created_at so repeated loads compare equal
PREVIEW_ROWS = 5
MIN_NON_NULL = 10  # of the catalogue's 11 data columns
LOST_EVERY = 10  # customers left out of the load that must not verify
DAMAGED_EVERY = 199  # order keys whose lines are damaged in the copy that must not verify
ORACLE_DIR = "/root/testdata/sf0.01"  # where the correctness run finds the given tables
