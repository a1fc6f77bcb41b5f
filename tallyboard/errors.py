"""Errors raised before or instead of producing a wrong scoreboard."""


class TallyError(RuntimeError):
    """Base class of every error this package raises on purpose."""


class SpecError(TallyError):
    """A report or publish rule is declared inconsistently."""


class WeekError(TallyError, ValueError):
    """A week id is malformed or names a week that does not exist."""


class LandingError(TallyError):
    """An expected file is not in the landing folder."""


class ContractError(TallyError):
    """A dataset does not honour the columns or values its report declares."""


class PublishError(TallyError):
    """Publishing would be unsafe or cannot be mapped to its target."""
