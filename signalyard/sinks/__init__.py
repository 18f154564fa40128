"""Sinks: partitioned lake writes (SNK1-2), appends and keyed upserts
(SNK3-5), stream sinks (SNK6-7) and the envelope writer (SNK8)."""
