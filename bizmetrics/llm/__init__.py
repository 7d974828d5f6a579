"""Operators for preparing training data: token files, filters, scans, de-duplication and placement of documents."""
