"""Fixed values of the baseline, the vote and the alert."""

Z_THRESHOLD = 1.4
Z_THRESHOLD_IF_MISSING = 1.5
VOTE_SHARE = 0.10
CONFIDENCE_DIVISOR = 5
ALERT_CONFIDENCE = 0.4
STD_FLOOR = 1e-12
MODEL_TYPE = "statistical_anomaly_detector"

# How many features are handled in one step.  The code generated for a step has
# to stay small, or the JVM does not compile it: measured, 7 to 8 features per
# step are fast, and 14 are slower than an array column.
SCORE_GROUP = 8
# Up to so many features are scored in such steps, more go through an array.
WIDE_SCORE = 64
# Up to so many features are fitted as separate aggregates, more by position.
WIDE_FIT = 16
