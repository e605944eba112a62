"""All queries of the library by name, and their SQL where SQL expresses them."""

from __future__ import annotations

from aerolake.plans import preparation, reference, reference_files, reference_more, reference_raw, reference_rows

assert reference_rows and reference_more and reference_raw and reference_files  # they register their queries in reference.QUERIES
FLAGSHIP = "A01_level2_hourly"
QUERIES = {**preparation.QUERIES, **reference.QUERIES}
SQL = {**preparation.SQL, **reference.SQL}
