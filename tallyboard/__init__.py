"""Weekly scoreboards of activity against targets, as Spark jobs."""

from tallyboard.errors import (
    ContractError,
    LandingError,
    PublishError,
    SpecError,
    TallyError,
    WeekError,
)
from tallyboard.functions.weeks import WeekWindow, current_week, week_of
from tallyboard.plans.backfill import backfill
from tallyboard.plans.history import History, backfill_kept
from tallyboard.plans.many import RawInputs, scoreboards
from tallyboard.plans.run import RunOutcome, run
from tallyboard.plans.scoreboard import scoreboard
from tallyboard.spec import Feed, PublishRule, ReportBook, ReportSpec

__all__ = [
    "ContractError",
    "Feed",
    "History",
    "LandingError",
    "PublishError",
    "PublishRule",
    "RawInputs",
    "ReportBook",
    "ReportSpec",
    "RunOutcome",
    "SpecError",
    "TallyError",
    "WeekError",
    "WeekWindow",
    "backfill",
    "backfill_kept",
    "current_week",
    "run",
    "scoreboard",
    "scoreboards",
    "week_of",
]
