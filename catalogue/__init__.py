"""Queries over the driver tables, each with an independent SQL answer where one exists."""

from catalogue import club, columns, ingest, relations

__all__ = ["club", "columns", "ingest", "relations"]
