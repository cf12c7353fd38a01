"""vidlake: video-statistics analytics expressed as Spark DataFrame operators.

Layers: bronze (raw text rows) -> silver (typed, cleaned, one row per video)
-> gold aggregates, analytic queries, ML features, posting-time
recommendations and batch model scoring.  Every operator takes and returns a
DataFrame; nothing is collected to the driver.
"""

__all__ = ["session", "schemas"]
