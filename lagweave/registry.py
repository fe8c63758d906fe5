"""Queries of the library's own operators, with the SQL that they are held against."""

from __future__ import annotations

from .plans import differential, further, models, networks, relational

QUERIES: dict = {**relational.QUERIES, **networks.QUERIES, **models.QUERIES, **further.QUERIES, **differential.QUERIES}
SQL: dict[str, str] = {**relational.SQL, **networks.SQL, **models.SQL, **further.SQL, **differential.SQL}
