"""Structured Streaming jobs (T1-T4): refreshed aggregates and change-stream
consumers.  Each job reads files with ``readStream``, keeps its read position
in its own checkpoint folder and does its work in ``foreachBatch`` with
batch-level idempotence, so a replayed micro-batch changes nothing."""
