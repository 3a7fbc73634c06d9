"""Streaming: intentionally empty.

The workload is batch only: no event-time windows, watermarks, state or late data (SURVEY §2.11).
Every operator takes complete tables. New source files are handled by re-running the batch job;
its model and result tables are overwritten (dynamic partition overwrite for partitioned tables).
"""
