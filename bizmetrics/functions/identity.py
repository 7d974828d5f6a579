"""Pseudonymous keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonym_key(identifier: Column, salt: str) -> Column:
    """Lower-case hex SHA-256 of salt + identifier; NULL identifiers keep a NULL key.

    The salt is visible in query plans, so pass it from the job's secret store and keep plans private.
    """
    return F.sha2(F.concat(F.lit(salt), identifier.cast("string")), 256)
