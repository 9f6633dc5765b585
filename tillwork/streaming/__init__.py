"""Operators on streams of files, with state that outlives a batch."""
