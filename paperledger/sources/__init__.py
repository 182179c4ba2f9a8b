"""Readers and writers. Readers run no job, but for a look at a CSV header or the published versions."""
