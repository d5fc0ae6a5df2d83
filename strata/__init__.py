"""strata: a Spark-native medallion (bronze / silver / gold) analytics library.

Paged JSON landing files become bronze tables (insert-once, with lineage),
silver tables (keep-latest dedupe, keyed upserts with per-column merge rules,
orphans quarantined) and gold metric views (daily, monthly, trailing-30-day,
pipeline status) with ready-made reports.  Everything is expressed with the
DataFrame API so Catalyst / AQE choose the physical plan.
"""

__all__ = ["session"]
