"""tidewatch — Spark-native analytics for labelled network-connection records.

Scans, profiles and validates connection logs; imputes, fences, derives,
encodes and scales features with fitted state kept as small tables; splits and
folds deterministically; trains and tunes boosted trees with Spark ML; scores
tables and streams; turns scores into threat levels and alerts; evaluates.
"""

__version__ = "0.1.0"
