"""Errors raised by the jobs and operators."""


class StagemartError(Exception):
    """Base of every error this package raises on its own."""


class MissingMetadata(StagemartError):
    """No stage table is configured for the request."""


class RowCountMismatch(StagemartError):
    """A sink holds another number of rows than was sent to it."""


class UnsafeOverwrite(StagemartError):
    """The target of a write is also its source."""


class DigestMismatch(StagemartError):
    """A dataset does not hold the rows that its digests tell of."""


class DependencyCycle(StagemartError):
    """Scripts read each other's results in a circle."""
