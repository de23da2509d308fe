"""vigilo — remote patient-vitals analytics on Spark.

Batch: clean measurements by sensor and signal quality, join sensors and
patients, derive clinical flags, compute patient-day KPIs.
Stream: classify seven vitals against a threshold table, enrich with the
patient profile, keep an alert history and the latest state per patient.

Everything is DataFrame expressions; no Python UDFs, no driver-side loops.
"""

__all__ = ["session", "schemas"]
