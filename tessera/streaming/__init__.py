"""Incremental (Structured Streaming) forms of the batch jobs.

The reference runs only batch jobs; the stateless steps (stand-in mapping,
guard, tokens, keyword sentiment) take a streaming frame unchanged, so these
helpers only wire a file source and a sink with a checkpoint in the shared
checkpoint folder.
"""

from tessera.streaming.jobs import incremental_clean, stream_files, streaming_sentiment_counts

__all__ = ["stream_files", "incremental_clean", "streaming_sentiment_counts"]
