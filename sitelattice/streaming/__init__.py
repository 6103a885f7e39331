"""Streaming. All inputs of this engine are finite files read to their end, so it has
no stream operators; the consolidation is a batch job over whole runs."""
