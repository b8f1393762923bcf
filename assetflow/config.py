"""Fixed parameters of the analytics.

These are the values the computations are defined with. They are plain data so
tests and callers can override them per call.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values (must stay as stated for results to match) -------------
# nine numeric channels per reading
CHANNELS = [f"sensor{i}" for i in range(1, 10)]
# model inputs: age, the nine channels, current output (11 features)
FEATURES = ["age"] + CHANNELS + ["oil_output"]
# tumbling window length for the hourly aggregate
WINDOW = "1 hour"
# event-time watermark: rows later than this behind the max event time are dropped
WATERMARK = "6 hours"
# look-ahead labels: 72 rows ahead (row based, own value past the end), or 6 hours ahead
LEAD_ROWS = 72
HORIZON = "6 hours"
# pressure sweep on sensor1: 8 settings from -0.015, step 0.001 (last -0.008)
SWEEP_START = -0.015
SWEEP_STEP = 0.001
SWEEP_POINTS = 8
SWEEP_DECIMALS = 3
# boosted trees: learning rate 0.5, column sample 0.5, depth 5; 10 rounds (no count is
# given, and 10 is the boosting library's default round count)
GBT_PARAMS = {"maxDepth": 5, "stepSize": 0.5, "featureSubsetStrategy": "0.5", "maxIter": 10}
# L1 term of the boosted trees
GBT_ALPHA = 10.0
# hours per year used by the revenue formula
HOURS_PER_YEAR = 24 * 365
# ------------------------------------------------------------------------

# rows of WINDOW length that make up HORIZON
HORIZON_ROWS = 6
# explicit "today" for the feature view (the data ends on 2024-01-30)
AS_OF = _dt.date(2024, 2, 1)
# price per unit of output (the formulas carry a price, the code uses 1)
PRICE = 1.0
# deterministic 80/20 split: pmod(hour_index * SPLIT_PRIME + asset_id, 10) < 8 trains
SPLIT_PRIME = 7919
SPLIT_BUCKETS = 10
SPLIT_TRAIN_BUCKETS = 8
# ridge penalty added to the normal equations (features are collinear)
RIDGE = 1e-3
# ridge penalties tried as candidate runs for model selection
RIDGE_CANDIDATES = [1e-3, 1.0, 10.0]
# bounds for broadcasting a dimension-sized table (rows and bytes, both checked)
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# arrival slices of the history (version b = readings before cutoff b); half past
# the hour, so open hourly windows are re-emitted as updates
BATCH_CUTOFFS = ["2024-01-05 12:30:00", "2024-01-10 12:30:00", "2024-01-15 12:30:00",
                 "2024-01-20 12:30:00", "2024-01-25 12:30:00"]
# every so many assets one is retired in the typed feed's history, every other of these returns
RETIRED_EVERY = 50
# training rounds for the registry: models retrained with data before each date
RETRAIN_AS_OF = [_dt.date(2024, 1, 16), AS_OF]
