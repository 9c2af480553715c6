"""Errors raised while a request is being planned, before any job runs."""

from __future__ import annotations


class TidemarkError(ValueError):
    """Base of every error this library raises on purpose."""


class ViewNotFound(TidemarkError):
    pass


class EntityNotFound(TidemarkError):
    pass


class FeatureNotFound(TidemarkError):
    pass


class ServiceNotFound(TidemarkError):
    pass


class SavedDatasetNotFound(TidemarkError):
    pass


class DuplicateName(TidemarkError):
    """Two definitions share a name that differs at most in letter case."""


class FeatureNameCollision(TidemarkError):
    """Two requested features would end up in the same output column."""


class MissingSpineColumns(TidemarkError):
    pass


class MissingRequestData(TidemarkError):
    pass


class SourceValidationError(TidemarkError):
    pass


class InferenceError(TidemarkError):
    pass


class TypeMismatch(TidemarkError):
    pass


class ValidationFailed(TidemarkError):
    """A dataset broke at least one expectation; ``report`` holds the failed rows."""

    def __init__(self, report):
        self.report = report
        names = ", ".join(f"{r['check_name']}({r['column_name']})" for r in report)
        super().__init__(f"validation failed: {names}")
