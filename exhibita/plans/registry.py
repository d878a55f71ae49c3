"""Name -> query and name -> DuckDB oracle for the library's own operators."""

from __future__ import annotations

from . import filings, texts

QUERIES: dict = filings.QUERIES | texts.QUERIES
ORACLES: dict = filings.ORACLES | texts.ORACLES
