"""martlane: a PySpark-native real-time retail warehouse.

Client logs and database change records come in as tables or streams; they
are routed, cleaned, deduplicated per device and day, checked for coupon
fraud in sliding windows, joined order-to-line with a time bound, enriched
with the latest user profile, upserted into keyed tables and queried by the
dashboard.  Every operator is a ``DataFrame -> DataFrame`` function that the
batch entry points and the Structured Streaming runners share.
"""

from martlane.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
