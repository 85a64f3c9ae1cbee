"""corvid: Spark-native data jobs.

Ad-hoc SQL with a fixed result-shaping step, dimension filters, daily
activity and rate tables, text tokenizing and counting, JSON row encoding,
streaming word counts and stop-list filters, and table-based ML jobs.
Every job is a DataFrame / SQL / Structured Streaming plan.
"""

from corvid.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
