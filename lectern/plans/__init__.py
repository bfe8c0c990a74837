"""Grain projections, searches, named queries, rankings and index lifecycle."""
