"""Scans: encounter CSV, stacked lookup files, documents, database tables, test-table adapters."""

from .database import read_jdbc_table
from .documents import read_documents
from .encounters import ENCOUNTER_SCHEMA, read_encounters
from .lookups import lookup, parse_stacked_lookups, read_stacked_lines

__all__ = ["read_encounters", "ENCOUNTER_SCHEMA", "read_stacked_lines",
           "parse_stacked_lookups", "lookup", "read_documents", "read_jdbc_table"]
