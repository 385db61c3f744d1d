"""Tables on shared storage: scans, sinks, upserts, exports."""
