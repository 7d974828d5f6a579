"""Source tables: what each report needs, and where it is read from."""

from bizmetrics.sources.calendar import calendar, calendar_of
from bizmetrics.sources.catalog import TABLES, Sources, Table

__all__ = ["TABLES", "Sources", "Table", "calendar", "calendar_of"]
