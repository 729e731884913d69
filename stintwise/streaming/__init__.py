"""Incremental ingest with Structured Streaming.

The reference has no streaming operator; it refreshes by pulling new source
files and re-running the batch job.  ``season_stream`` is that refresh as a
file-source stream: each new season file is parsed once (same code as the
batch scan) and appended, with exactly-once bookkeeping in the checkpoint.
``career_stream`` adds each season to a mergeable state from which the career
relations are read without going over earlier seasons' facts.
"""

from stintwise.streaming.seasons import career_stream, read_career_state, season_stream

__all__ = ["season_stream", "career_stream", "read_career_state"]
