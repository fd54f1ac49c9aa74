"""orderloom: retail order analytics on Spark DataFrames.

Raw order lines -> cleaned staging -> rule-based rejects -> star schema ->
reusable views -> KPI / window / OLAP / slice queries, plus snapshot
flattening and a Structured Streaming order-event path.
"""

from orderloom.session import build_session, configure, scratch_path

__all__ = ["build_session", "configure", "scratch_path"]
