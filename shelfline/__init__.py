"""Catalogue and stock analytics as Spark DataFrame functions."""

from shelfline.plans.tuning import configure

__all__ = ["configure"]
