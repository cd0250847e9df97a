"""Composed work: the catalog of named queries, write jobs and the daily chain."""
