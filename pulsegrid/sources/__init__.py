"""Readers and writers at the edges of the jobs."""
