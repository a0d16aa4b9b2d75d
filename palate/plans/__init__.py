"""Registered queries over the sales tables, each beside the SQL that defines its answer."""

from palate.plans import checked, files, matrices, popularity, quality, recommend, similarity, streams  # noqa: F401
