"""The scoreboard rules in plain Python, row by row, to compare plans with."""

import datetime as dt
from collections import Counter

from tallyboard import WeekWindow


def ratio(a, b):
    return None if not b else a / b


def indicators(unit, week, ytd, start, annual, kind):
    gap = None if start is None else ytd - start
    return (unit, week, ytd, start, ratio(ytd, start), gap, annual, ratio(ytd, annual), kind)


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def board(rows, targets, week, segments=(), excluded=None, cutoff="day"):
    """``rows`` are (moment, unit, segment); returns the rows in display order."""
    window = WeekWindow(week)
    monday = dt.datetime.combine(window.monday, dt.time())
    january = dt.datetime.combine(window.ytd_start, dt.time())
    sunday = monday + dt.timedelta(days=6)
    in_week, in_year = Counter(), Counter()
    for moment, unit, segment in rows:
        if unit is None or moment is None or (segments and segment not in segments):
            continue
        late = moment > sunday if cutoff == "midnight" else moment >= sunday + dt.timedelta(days=1)
        if late or moment < january:
            continue
        in_year[unit] += 1
        in_week[unit] += moment >= monday
    units = sorted({*in_year, *targets})
    lines = [
        (u, in_week[u], in_year[u], *targets.get(u, (None, None))) for u in units
    ]

    def summed(label, chosen, kind):
        return indicators(
            label,
            sum(c[1] for c in chosen),
            sum(c[2] for c in chosen),
            total(c[3] for c in chosen),
            total(c[4] for c in chosen),
            kind,
        )

    result = [indicators(*line, "unit") for line in lines]
    result.append(summed("All units", lines, "total"))
    if excluded in units:
        rest = [line for line in lines if line[0] != excluded]
        result.append(summed(f"All units except {excluded}", rest, "total_excl"))
    return result


def random_case(rng, first, last, size=400):
    """Rows around week and year boundaries, with missing values everywhere."""
    span = int((last - first).total_seconds() // 3600)
    rows = [
        (
            None if rng.random() < 0.03 else first + dt.timedelta(hours=rng.randrange(span)),
            rng.choice(["U1", "U1", "U1", "U2", "U3", "", None, f"U{rng.randrange(4, 9)}"]),
            rng.choice(["Retail", "Business", "Other", None]),
        )
        for _ in range(size)
    ]
    rows += [
        (dt.datetime(year, month, day, hour), "U2", "Retail")
        for year in range(first.year, last.year + 1)
        for month, day in ((1, 1), (1, 4), (12, 28), (12, 31))
        for hour in (0, 13)
        if first <= dt.datetime(year, month, day) <= last
    ]
    targets = {
        u: (rng.choice([None, 0.0, 12.5, 40.0]), rng.choice([None, 0.0, 100.0]))
        for u in ("U1", "U2", "U4", "U77")
    }
    return rows, targets
