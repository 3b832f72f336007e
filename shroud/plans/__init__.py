"""Composite plans (X1 anonymize, X2 release_report) and the query catalogue."""

from shroud.plans.release import ReleaseConfig, anonymize, release_report  # noqa: F401
