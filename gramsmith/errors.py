"""Errors that a caller can act on."""


class CompositionError(Exception):
    """Base of the errors of this package."""


class InvalidInput(CompositionError):
    """Data or options that can't be used; the command line reports them."""


class BadUnit(InvalidInput):
    """A unit that an ingredient has no weight for."""


class InvalidMerge(InvalidInput):
    """A merge of columns that aren't there."""
