"""kwpulse: trending-keyword analytics as Spark DataFrame jobs.

Every public function takes and returns lazy DataFrames; nothing is collected
to the driver. Time is always an explicit ``as_of`` so results are repeatable.
"""

__all__ = ["session", "schemas"]
