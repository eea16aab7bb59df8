"""Schemas, the tables on disk and the course of a batch."""
