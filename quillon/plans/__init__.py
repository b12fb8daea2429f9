"""Importing this package registers every query."""

from quillon.plans import answers, captures, changes, evaluation, frontier, ledger, loading, publishing, ranking, records, retrieval, review, serving, streams  # noqa: F401
