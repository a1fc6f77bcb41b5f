"""SQL equivalents of the queries, for an independent engine.

Written from the rules of the scoreboard, not from the Spark plans: joins
instead of running sums, one scan per figure instead of a shared tally.
"""

from __future__ import annotations

# All characters a Unicode-aware strip removes.
SPACES = "||".join(
    f"chr({code})"
    for code in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203))
    + (8232, 8233, 8239, 8287, 12288)
)

WIDE = """
wide as (
  select o.*, c.c_mktsegment, c.c_name, n.n_name, r.r_name, cast(o.o_orderdate as date) as day
  from orders o join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  join region r on n.n_regionkey = r.r_regionkey)"""

DIRTY = f"""{WIDE},
dirty as (
  select o_orderkey, o_orderpriority,
    case when o_orderkey % 50 = 0 then 'not a date'
         when o_orderkey % 50 = 1 then null
         when o_orderkey % 3 = 0 then strftime(o_orderdate, '%d/%m/%Y')
         when o_orderkey % 3 = 1 then strftime(o_orderdate + to_hours(o_orderkey % 24), '%Y-%m-%d %H:%M:%S')
         else strftime(o_orderdate, '%Y-%m-%d') end as day_text,
    case when o_orderkey % 11 = 0 then null
         when o_orderkey % 7 = 0 then chr(9) || c_mktsegment || chr(160) || ' '
         else c_mktsegment end as segment_text,
    case when o_orderkey % 13 = 0 then null
         when o_orderkey % 17 = 0 then ' '
         when o_orderkey % 5 = 0 then chr(8195) || ' ' || n_name || ' '
         else n_name end as unit_text,
    case when o_orderkey % 40 = 0 then 'n/a' when o_orderkey % 40 = 1 then null
         when o_orderkey % 40 = 2 then ' ' when o_orderkey % 40 = 3 then '1.234'
         when o_orderkey % 7 = 0 then chr(160) || cast(cast(o_totalprice as decimal(18,2)) as varchar)
         else cast(cast(o_totalprice as decimal(18,2)) as varchar) end as amount_text,
    case when o_orderkey % 40 > 3 then cast(o_totalprice as decimal(18,2)) end as amount,
    o_orderkey % 40 in (0, 3) as amount_unreadable
  from wide),
cases as (
  select coalesce(try_strptime(day_text, '%Y-%m-%d'), try_strptime(day_text, '%Y-%m-%d %H:%M:%S'),
                  try_strptime(day_text, '%d/%m/%Y')) as moment,
    day_text, trim(segment_text, {SPACES}) as segment, trim(unit_text, {SPACES}) as unit_code,
    amount_text, amount, amount_unreadable
  from dirty)"""

NATION_TARGETS = """
targets as (
  select unit_code, cast(s as double) as target_start, cast(a as double) as target_annual from (
    select n_name as unit_code,
      case when n_nationkey = 3 then 0.0 when n_nationkey <> 4 then (30 + 5 * (n_nationkey % 5)) * 0.5 end as s,
      case when n_nationkey = 3 then 0.0 when n_nationkey <> 4 then (30 + 5 * (n_nationkey % 5)) end as a
    from nation where n_nationkey <> 5
    union all select 'NATION_99', 10.0, 20.0))"""

REGION_TARGETS = """
targets as (
  select r_name as unit_code, cast(100 + 10 * r_regionkey as double) as target_start,
    cast(200 + 20 * r_regionkey as double) as target_annual from region)"""

CUSTOMER_TARGETS = """
targets as (
  select c_name as unit_code, floor(c_acctbal * 4) / 4 as target_start,
    floor(c_acctbal * 4) / 4 * 16 as target_annual from customer)"""

EVENTS = """
happened as (
  select ts, event_type as segment, 'U' || cast(user_id % 10 as varchar) as unit_code from events),
event_targets as (
  select distinct unit_code, 100 + cast(unit_code[2:2] as double) as target_start,
    1000 + 10 * cast(unit_code[2:2] as double) as target_annual from happened)"""

DIRTY_TARGETS = f"""
delivered as (
  select case when c_custkey % 10 <> 0 then ' ' || c_name || ' ' end as unit_text,
    case c_custkey % 9 when 0 then 'n/a' when 1 then null when 2 then ' 12.5 ' when 3 then '7d'
      else cast(cast(floor(c_acctbal) as bigint) as varchar) end as start_text,
    case when c_custkey % 8 = 0 then cast('nan' as double) else floor(c_acctbal) * 2.0 end as annual
  from customer),
targets as (
  select trim(unit_text, {SPACES}) as unit_code, try_cast(trim(start_text) as double) as target_start,
    case when not isnan(annual) then annual end as target_annual
  from delivered where unit_text is not null)"""

YEAR_TO_WEEK = "day between date '1998-01-01' and date '1998-06-14'"
IN_WEEK = "day >= date '1998-06-08'"
KEPT = "c_mktsegment in ('BUILDING', 'MACHINERY')"

COUNTED = """count(*) filter (where {week}) as actual_week, count(*) as actual_ytd"""
SUMMED = """coalesce(sum(cast(o_totalprice as decimal(18,2))) filter (where {week}), 0) as actual_week,
  sum(cast(o_totalprice as decimal(18,2))) as actual_ytd"""

VOLUMES = """
vol as (
  select {unit} as unit_code, {measure}
  from {source} where {ytd} and {kept} and {unit} is not null group by {unit})"""

ALIGNED = """
j as (
  select coalesce(v.unit_code, t.unit_code) as unit_code,
    cast(coalesce(actual_week, 0) as {number}) as actual_week,
    cast(coalesce(actual_ytd, 0) as {number}) as actual_ytd, target_start, target_annual,
    v.unit_code is not null as has_activity, t.unit_code is not null as has_target
  from vol v full join {targets} t on v.unit_code = t.unit_code)"""

# Boards of several keys (reports or weeks) at once. `jk` holds aligned units,
# `seed` every key with its excluded unit.
BOARD = """
sums as (
  select s.key, 'All units' as unit_code, sum(actual_week) as actual_week, sum(actual_ytd) as actual_ytd,
    sum(target_start) as target_start, sum(target_annual) as target_annual, 'total' as row_type
  from seed s left join jk on jk.key = s.key group by s.key
  union all
  select s.key, 'All units except ' || s.excluded, sum(actual_week), sum(actual_ytd),
    sum(target_start), sum(target_annual), 'total_excl'
  from seed s left join jk on jk.key = s.key and jk.unit_code <> s.excluded
  where exists (select 1 from jk x where x.key = s.key and x.unit_code = s.excluded)
  group by s.key, s.excluded),
figures as (
  select key, unit_code, actual_week, actual_ytd, target_start, target_annual, 'unit' as row_type from jk
  union all
  select key, unit_code, coalesce(actual_week, 0), coalesce(actual_ytd, 0), target_start, target_annual,
    row_type from sums),
board as (
  select key, unit_code, cast(actual_week as {shown}) as actual_week, cast(actual_ytd as {shown}) as actual_ytd,
    target_start, cast(actual_ytd as double) / nullif(target_start, 0) as attainment,
    cast(actual_ytd as double) - target_start as gap, target_annual,
    cast(actual_ytd as double) / nullif(target_annual, 0) as annual_share, row_type
  from figures)"""

COLUMNS = (
    "unit_code, actual_week, actual_ytd, target_start, attainment, gap, "
    "target_annual, annual_share, row_type"
)


def volumes(
    unit="n_name", source="wide", ytd=YEAR_TO_WEEK, week=IN_WEEK, kept=KEPT, measure=COUNTED
) -> str:
    return VOLUMES.format(
        unit=unit, source=source, ytd=ytd, kept=kept, measure=measure.format(week=week)
    )


def aligned(number="bigint", targets="targets") -> str:
    return ALIGNED.format(number=number, targets=targets)


def single_board(*ctes: str, excluded="NATION_7", number="bigint", shown="bigint") -> str:
    """CTEs up to `board`, for one week and report."""
    parts = [
        *ctes,
        aligned(number) if not any("\nj as" in c for c in ctes) else None,
        "\njk as (select 1 as key, * from j)",
        f"\nseed as (select 1 as key, '{excluded}' as excluded)",
        BOARD.format(shown=shown),
    ]
    return "with " + ",".join(part for part in parts if part)


MONEY = dict(number="decimal(38,2)", shown="double")
NATIONS = (WIDE, NATION_TARGETS)
SCOREBOARD = single_board(*NATIONS, volumes())
CUSTOMERS = single_board(
    WIDE, CUSTOMER_TARGETS, volumes(unit="c_name", measure=SUMMED),
    excluded="Customer#000000007", **MONEY,
)
ALIGNED_NATIONS = "with " + ",".join((*NATIONS, volumes(), aligned()))

# ------------------------------------------------------------- events, D1
EVENTS_BEFORE = {"day": "ts < timestamp '2024-01-22'", "midnight": "ts <= timestamp '2024-01-21'"}


def events_board(cutoff: str) -> str:
    limit = EVENTS_BEFORE[cutoff]
    vol = volumes(
        unit="unit_code", source="happened", kept="segment in ('click', 'purchase')",
        ytd=f"ts >= timestamp '2024-01-01' and {limit}", week="ts >= timestamp '2024-01-15'",
    )
    body = single_board(EVENTS, vol, aligned(targets="event_targets"), excluded="U3")
    return f"select '{cutoff}' as cutoff, * from ({body} select {COLUMNS} from board)"


# ----------------------------------------------------------- many reports
# report -> (rows, kept, year to date, week, later, unit, given, unreadable, targets, excluded)
ORDER_DATES = (YEAR_TO_WEEK, IN_WEEK, "day > date '1998-06-14'")
EVENT_DATES = tuple(
    condition.replace("day", "cast(ts as date)")
    for condition in (YEAR_TO_WEEK, IN_WEEK, "day > date '1998-06-14'")
)
CASE_DATES = tuple(condition.replace("day", "cast(moment as date)") for condition in ORDER_DATES)
REPORTS = {
    "orders": ("wide", KEPT, ORDER_DATES, "n_name", "false", "targets", "NATION_7"),
    "everything": ("wide", "true", ORDER_DATES, "n_name", "false", "targets", None),
    "urgent": (
        "wide", f"{KEPT} and o_orderpriority in ('1-URGENT', '0-NEVER')", ORDER_DATES, "n_name",
        "false", "targets", "NATION_88",
    ),
    "events": (
        "happened", "segment in ('signup')", EVENT_DATES, "unit_code", "false", "event_targets", "U9",
    ),
    "cases": (
        "cases", "segment in ('BUILDING', 'MACHINERY', 'SPACECRAFT')", CASE_DATES, "unit_code",
        "moment is null and day_text is not null", "targets", "NATION_77",
    ),
}


def many(names: list[str]) -> str:
    """`activity`, `planned`, `seed` and `jk` for the named reports."""
    activity, planned, seed, counts = [], [], [], []
    for name in names:
        rows, kept, (ytd, week, later), unit, unreadable, targets, excluded = REPORTS[name]
        activity.append(
            f"select '{name}' as key, {unit} as unit_code, count(*) filter (where {week}) as actual_week, "
            f"count(*) as actual_ytd from {rows} where {kept} and {ytd} and {unit} is not null group by {unit}"
        )
        planned.append(
            f"select '{name}' as key, unit_code, target_start, target_annual from {targets}"
        )
        seed.append(
            f"select '{name}' as key, "
            + (f"'{excluded}'" if excluded else "cast(null as varchar)") + " as excluded"
        )
        counts.append(
            f"select '{name}' as key, count(*) as rows_read, count(*) filter (where {kept}) as rows_kept, "
            f"count(*) filter (where {kept} and {later}) as rows_later, "
            f"count(*) filter (where {unreadable}) as dates_unreadable from {rows}"
        )
    union = " union all ".join
    return "with " + ",".join(
        (
            DIRTY, NATION_TARGETS, EVENTS,
            f"\nactivity as ({union(activity)})",
            f"\nplanned as ({union(planned)})",
            f"\nseed as ({union(seed)})",
            f"\ncounters as ({union(counts)})",
            """
jk as (
  select coalesce(a.key, p.key) as key, coalesce(a.unit_code, p.unit_code) as unit_code,
    coalesce(actual_week, 0) as actual_week, coalesce(actual_ytd, 0) as actual_ytd,
    target_start, target_annual, p.key is null as untargeted
  from activity a full join planned p on a.key = p.key and a.unit_code = p.unit_code)""",
        )
    )


def expected_values(names: list[str]) -> str:
    """Requested values that no row of the unfiltered extract has."""
    requested = {
        "orders": ("wide", "c_mktsegment", "", ("BUILDING", "MACHINERY")),
        "urgent": ("wide", "o_orderpriority", "o_orderpriority=", ("1-URGENT", "0-NEVER")),
        "events": ("happened", "segment", "", ("signup",)),
        "cases": ("cases", "segment", "", ("BUILDING", "MACHINERY", "SPACECRAFT")),
    }
    found = []
    for name in names:
        if name not in requested:
            continue
        rows, column, prefix, values = requested[name]
        code = "unknown_filter_value" if prefix else "unknown_segment"
        listed = ", ".join(f"('{v}')" for v in values)
        found.append(
            f"select '{name}' as report, '{code}' as code, '{prefix}' || v as subject, 0 as n "
            f"from (values {listed}) as w(v) "
            f"where not exists (select 1 from {rows} where {column} = v)"
        )
    return " union all ".join(found)


ALL_REPORTS = list(REPORTS)

# ---------------------------------------------------------------- amounts
AMOUNTS = {"amounts": ("segment in ('BUILDING', 'MACHINERY')", "'NATION_7'"), "all amounts": ("true", "cast(null as varchar)")}


def of_amounts(select: str) -> str:
    """``select`` with {name}, {kept} and {excluded}, for both reports of amounts."""
    return " union all ".join(
        select.format(name=name, kept=kept, excluded=excluded) for name, (kept, excluded) in AMOUNTS.items()
    )


AMOUNT_ACTIVITY = """select '{name}' as key, unit_code,
    coalesce(sum(amount) filter (where moment >= timestamp '1998-06-08'), 0) as actual_week,
    coalesce(sum(amount), 0) as actual_ytd
  from cases where {kept} and unit_code is not null and moment >= timestamp '1998-01-01'
    and moment < timestamp '1998-06-15' group by unit_code"""
AMOUNT_COUNTERS = """select '{name}' as key, count(*) as rows_read, count(*) filter (where {kept}) as rows_kept,
    count(*) filter (where {kept} and moment >= timestamp '1998-06-15') as rows_later,
    count(*) filter (where moment is null and day_text is not null) as dates_unreadable,
    count(*) filter (where amount_unreadable) as amounts_unreadable,
    count(*) filter (where {kept} and amount_unreadable) as kept_unreadable from cases"""
AMOUNT_SEED = "select '{name}' as key, {excluded} as excluded"
AMOUNTS_UNTARGETED = """select '{name}' as key, unit_code, count(*) as n from cases
  where {kept} and moment >= timestamp '1998-01-01' and moment < timestamp '1998-06-15'
    and unit_code not in (select unit_code from targets) group by unit_code"""
AMOUNT_BOARDS = f"""with {DIRTY}, {NATION_TARGETS.strip()},
seed as ({of_amounts(AMOUNT_SEED)}),
activity as ({of_amounts(AMOUNT_ACTIVITY)}),
planned as (select s.key, t.* from seed s cross join targets t),
jk as (
  select coalesce(a.key, p.key) as key, coalesce(a.unit_code, p.unit_code) as unit_code,
    cast(coalesce(actual_week, 0) as decimal(38,2)) as actual_week,
    cast(coalesce(actual_ytd, 0) as decimal(38,2)) as actual_ytd, target_start, target_annual
  from activity a full join planned p on a.key = p.key and a.unit_code = p.unit_code),
counters as ({of_amounts(AMOUNT_COUNTERS)})"""

# --------------------------------------------------------------- backfill
def backfill(
    targets: str = NATION_TARGETS,
    unit: str = "n_name",
    kept: str = KEPT,
    excluded: str = "'NATION_7'",
    measure: str = "count(*)",
    number: str = "bigint",
    shown: str = "bigint",
) -> str:
    return f"""
with {WIDE.strip()}, {targets.strip()},
seed as (
  select strftime(monday, '%G-W%V') as key, monday, {excluded} as excluded from (
    select cast(unnest(generate_series(timestamp '1994-12-26', timestamp '2001-07-30',
                                       interval 7 day)) as date) as monday)),
daily as (
  select {unit} as unit_code, day, {measure} as n from wide where {kept} group by {unit}, day),
vol as (
  select s.key, d.unit_code, coalesce(sum(n) filter (where d.day >= s.monday), 0) as actual_week,
    sum(n) as actual_ytd
  from seed s join daily d
    on d.day between make_date(cast(year(s.monday) as int), 1, 1) and s.monday + 6
  group by s.key, d.unit_code),
planned as (select s.key, t.* from seed s cross join targets t),
jk as (
  select coalesce(v.key, t.key) as key, coalesce(v.unit_code, t.unit_code) as unit_code,
    cast(coalesce(actual_week, 0) as {number}) as actual_week,
    cast(coalesce(actual_ytd, 0) as {number}) as actual_ytd, target_start, target_annual
  from vol v full join planned t on v.key = t.key and v.unit_code = t.unit_code),
{BOARD.format(shown=shown).strip()}
select key as week, {COLUMNS} from board"""


BACKFILL = backfill()
BACKFILL_ALL = backfill(kept="true", excluded="cast(null as varchar)")
BACKFILL_SUM = backfill(
    REGION_TARGETS, "r_name", excluded="'ASIA'",
    measure="sum(cast(o_totalprice as decimal(18,2)))", **MONEY,
)

BACKFILL_URGENT = backfill(
    kept=f"{KEPT} and o_orderpriority in ('1-URGENT', '0-NEVER')", excluded="'NATION_88'"
)


def backfill_of_events(first: str, last: str, kept: str, excluded: str, until: str) -> str:
    """Mondays ``first`` to ``last``; ``until`` closes the week of ``s.monday``."""
    return f"""
with {EVENTS.strip()},
seed as (
  select strftime(monday, '%G-W%V') as key, monday, '{excluded}' as excluded from (
    select cast(unnest(generate_series(timestamp '{first}', timestamp '{last}',
                                       interval 7 day)) as date) as monday)),
vol as (
  select s.key, h.unit_code, count(*) filter (where h.ts >= s.monday) as actual_week,
    count(*) as actual_ytd
  from seed s join happened h
    on h.ts >= make_date(cast(year(s.monday) as int), 1, 1) and {until}
  where h.segment in ({kept}) group by s.key, h.unit_code),
planned as (select s.key, t.* from seed s cross join event_targets t),
jk as (
  select coalesce(v.key, t.key) as key, coalesce(v.unit_code, t.unit_code) as unit_code,
    coalesce(actual_week, 0) as actual_week, coalesce(actual_ytd, 0) as actual_ytd,
    target_start, target_annual
  from vol v full join planned t on v.key = t.key and v.unit_code = t.unit_code),
{BOARD.format(shown="bigint").strip()}
select key as week, {COLUMNS} from board"""


BACKFILL_EVENTS = backfill_of_events(
    "2023-12-25", "2024-02-05", "'click', 'purchase'", "U3", "h.ts <= s.monday + 6"
)
BACKFILL_SIGNUPS = backfill_of_events(
    "1994-12-26", "2001-07-30", "'signup'", "U9", "h.ts < s.monday + 7"
)


BACKFILL_REPORTS = f"""select 'orders' as report, * from ({BACKFILL})
      union all select 'everything' as report, * from ({BACKFILL_ALL})
      union all select 'urgent' as report, * from ({BACKFILL_URGENT})
      union all select 'events' as report, * from ({BACKFILL_SIGNUPS})"""


# ----------------------------------------------------------- presentation
def integer_text(value: str, form: str = "{:,}") -> str:
    rounded = f"cast(round_even({value}, 0) as bigint)"
    if form == "{:,}":
        return f"coalesce(replace(format('{{:,}}', {rounded}), ',', ' '), '—')"
    sign = f"case when {rounded} >= 0 then '+' else '' end"
    return f"coalesce({sign} || replace(format('{{:,}}', {rounded}), ',', ' '), '—')"


def gap_text(value: str) -> str:
    return integer_text(value, "signed")


def percent_text(value: str, decimals: int = 1) -> str:
    return f"coalesce(replace(format('{{:.{decimals}f}}', {value} * 100), '.', ',') || ' %', '—')"


GAP_CLASS = "case when gap is null then 'neutral' when gap >= 0 then 'up' else 'down' end"
GAP_ARROW = "case when gap is null then '' when gap >= 0 then '▲' else '▼' end"

ORACLE_SQL: dict[str, str] = {
    "scoreboard": f"{SCOREBOARD} select {COLUMNS} from board",
    "extract_clean": f"""with {DIRTY} select strftime(moment, '%Y-%m-%d %H:%M:%S') as activity_date,
      segment, unit_code, moment is null and day_text is not null as date_unreadable from cases""",
    "date_quality": f"""with {DIRTY} select count(day_text) as dates_given,
      count(*) filter (where moment is null and day_text is not null) as dates_unreadable,
      count(day_text) > 0 and count(moment) = 0 as all_unreadable from cases""",
    "targets_clean": f"with {DIRTY_TARGETS} select * from targets",
    "duplicate_targets": """select cast(cast(floor(c_acctbal) as bigint) as varchar) as unit_code,
      count(*) as target_rows from customer group by 1 having count(*) > 1""",
    "segment_filter": f"""with {DIRTY} select strftime(moment, '%Y-%m-%d %H:%M:%S') as activity_date,
      segment, unit_code from cases where segment in ('BUILDING', 'MACHINERY', 'SPACECRAFT')""",
    "retained_detail": f"""with {DIRTY} select strftime(moment, '%Y-%m-%d %H:%M:%S') as activity_date,
      segment, unit_code from cases where segment in ('BUILDING', 'MACHINERY', 'SPACECRAFT')
      and moment >= timestamp '1998-01-01' and moment < timestamp '1998-06-15'""",
    "volumes": "with " + ",".join((WIDE, volumes())) + " select * from vol",
    "target_alignment": f"{ALIGNED_NATIONS} select * from j",
    "units_without_target": f"""{ALIGNED_NATIONS} select unit_code, actual_ytd from j
      where has_activity and not has_target""",
    "units_without_activity": f"""{ALIGNED_NATIONS} select unit_code, target_start, target_annual
      from j where has_target and not has_activity""",
    "scoreboard_straddling": single_board(
        *NATIONS,
        volumes(
            kept="true", ytd="day between date '1997-01-01' and date '1998-01-04'",
            week="day >= date '1997-12-29'",
        ),
    )
    + f" select {COLUMNS} from board",
    "scoreboard_sum": single_board(*NATIONS, volumes(measure=SUMMED), **MONEY)
    + f" select {COLUMNS} from board",
    "scoreboard_filtered": single_board(
        *NATIONS,
        volumes(
            kept=f"{KEPT} and o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus in ('O', 'F')"
        ),
    )
    + f" select {COLUMNS} from board",
    "scoreboard_region": single_board(
        WIDE, REGION_TARGETS, volumes(unit="r_name"), excluded="ASIA"
    )
    + f" select {COLUMNS} from board",
    "scoreboard_customers": f"{CUSTOMERS} select {COLUMNS} from board",
    "events_cutoff": f"{events_board('day')} union all {events_board('midnight')}",
    "unit_rows": f"{SCOREBOARD} select {COLUMNS} from board where row_type = 'unit'",
    "total_rows": f"{SCOREBOARD} select {COLUMNS} from board where row_type <> 'unit'",
    "multi_report": f"""{many(["orders", "everything", "urgent", "events"])},
      {BOARD.format(shown="bigint")} select key as report, {COLUMNS} from board""",
    "warnings": f"""{many(ALL_REPORTS)},
      findings as (
        {expected_values(ALL_REPORTS)}
        union all select key, 'nothing_kept', '', 0 from counters where rows_kept = 0
        union all select key, 'later_rows', '1998-06-14', rows_later from counters where rows_later > 0
        union all select key, 'unit_without_target', unit_code, actual_ytd from jk where untargeted
        union all select s.key, 'excluded_unit_missing', excluded, 0 from seed s
          where excluded is not null and not exists (
            select 1 from jk where jk.key = s.key and jk.unit_code = s.excluded))
      select report, '1998-W24' as week, code, subject, cast(n as bigint) as n from findings""",
    "run_metrics": f"""{many(ALL_REPORTS)},
      shown as (
        select key, count(*) as unit_count, cast(sum(actual_ytd) as bigint) as actual_ytd,
          sum(target_start) as target_start from jk group by key)
      select c.key as report, '1998-W24' as week, rows_read, rows_kept, rows_later, dates_unreadable,
        cast(0 as bigint) as amounts_unreadable, coalesce(unit_count, 0) as unit_count, coalesce(actual_ytd, 0) as actual_ytd, target_start,
        cast(actual_ytd as double) / nullif(target_start, 0) as attainment
      from counters c left join shown s on c.key = s.key""",
    "scoreboard_amounts": f"""{AMOUNT_BOARDS}, {BOARD.format(shown="double").strip()}
      select key as report, {COLUMNS} from board""",
    "amount_warnings": f"""{AMOUNT_BOARDS},
      rows_without as ({of_amounts(AMOUNTS_UNTARGETED)})
      select key as report, '1998-W24' as week, code, subject, cast(n as bigint) as n from (
        select key, 'later_rows' as code, '1998-06-14' as subject, rows_later as n from counters where rows_later > 0
        union all select key, 'unreadable_amounts', 'Amount', kept_unreadable from counters where kept_unreadable > 0
        union all select key, 'nothing_kept', '', 0 from counters where rows_kept = 0
        union all select key, 'unit_without_target', unit_code, n from rows_without
        union all select 'amounts', 'unknown_segment', v, 0 from (values ('BUILDING'), ('MACHINERY')) as w(v)
          where v not in (select segment from cases where segment is not null)
        union all select s.key, 'excluded_unit_missing', excluded, 0 from seed s where excluded is not null
          and not exists (select 1 from jk where jk.key = s.key and jk.unit_code = s.excluded))""",
    "amount_metrics": f"""{AMOUNT_BOARDS},
      shown as (
        select key, count(*) as unit_count, sum(actual_ytd) as actual_ytd, sum(target_start) as target_start
        from jk group by key)
      select c.key as report, '1998-W24' as week, rows_read, rows_kept, rows_later, dates_unreadable,
        amounts_unreadable, unit_count, cast(actual_ytd as double) as actual_ytd, target_start,
        cast(actual_ytd as double) / nullif(target_start, 0) as attainment
      from counters c join shown s on c.key = s.key""",
    "rejected_values": f"""with {DIRTY}
      select segment, unit_code, 'Amount' as "column", amount_text as value, 'unreadable_amount' as reason
      from cases where amount_unreadable
      union all select segment, unit_code, 'Case date', day_text, 'unreadable_date'
      from cases where moment is null and day_text is not null""",
    "unknown_segments": f"""with {DIRTY}, wanted as (
        select v as segment from (values ('BUILDING'), ('MACHINERY'), ('SPACECRAFT')) as w(v)),
      present as (select distinct segment from cases where segment is not null)
      select coalesce(p.segment, w.segment) as segment,
        case when p.segment is null then 'unknown' when w.segment is null then 'ignored' else 'kept' end
          as status
      from present p full join wanted w on p.segment = w.segment""",
    "week_dimension": """with days as (
        select cast(o_orderdate as date) as day from orders
        union select cast(ts as date) from events),
      m as (select day, cast(date_trunc('week', day) as date) as monday from days)
      select strftime(day, '%Y-%m-%d') as day, strftime(day, '%G-W%V') as week,
        strftime(monday, '%Y-%m-%d') as monday, strftime(monday + 6, '%Y-%m-%d') as sunday,
        strftime(monday, '%Y') || '-01-01' as year_start,
        'S' || strftime(monday, '%V') || ' - du ' || strftime(monday, '%d/%m') || ' au '
          || strftime(monday + 6, '%d/%m/%Y') as label
      from m""",
    "week_parsing": """with ids as (
        select distinct cast(year(o_orderdate) as varchar)
          || case when o_orderkey % 10 = 9 then '-' else '-W' end
          || lpad(cast(o_orderkey % 100 as varchar), 2, '0') as week from orders),
      mondays as (
        select cast(unnest(generate_series(timestamp '1990-01-01', timestamp '2010-01-04',
                                           interval 7 day)) as date) as monday)
      select week, strftime(monday, '%Y-%m-%d') as monday
      from ids left join mondays on strftime(monday, '%G-W%V') = week""",
    "backfill_weeks": BACKFILL,
    "backfill_events": BACKFILL_EVENTS,
    "backfill_sum": BACKFILL_SUM,
    "backfill_reports": BACKFILL_REPORTS,
    "backfill_kept": BACKFILL_REPORTS,
    "block_scoreboard": f"""{SCOREBOARD} select unit_code as "Unit", actual_week as "Actual week",
      actual_ytd as "Actual year to date", target_start as "Start-of-year target",
      attainment as "Attainment", gap as "Gap", target_annual as "Annual target",
      annual_share as "Share of annual target" from board""",
    "block_targets": f"""with {DIRTY_TARGETS} select unit_code as "Unit",
      target_start as "Start-of-year target", target_annual as "Annual target" from targets""",
    "display_rows": f"""{CUSTOMERS} select unit_code, {integer_text("actual_week")} as actual_week,
      {integer_text("actual_ytd")} as actual_ytd, {integer_text("target_start")} as target_start,
      {percent_text("attainment")} as attainment, {gap_text("gap")} as gap,
      {GAP_CLASS} as gap_class, {GAP_ARROW} as gap_arrow,
      {integer_text("target_annual")} as target_annual, {percent_text("annual_share")} as annual_share,
      row_type <> 'unit' as is_total from board""",
    "kpi_cards": f"""{CUSTOMERS}
      select 1 as position, 'Actual year to date (revenue)' as label, {integer_text("actual_ytd")} as value,
        {integer_text("actual_week")} || ' this week' as detail, 'neutral' as tone
      from board where row_type = 'total'
      union all select 2, 'Overall attainment', {percent_text("attainment")},
        {GAP_ARROW} || ' ' || {gap_text("gap")} || ' vs target', {GAP_CLASS}
      from board where row_type = 'total'
      union all select 3, 'Start-of-year target', {integer_text("target_start")},
        'annual target ' || {integer_text("target_annual")}, 'neutral'
      from board where row_type = 'total'
      union all select 4, unit_code, {percent_text("attainment")},
        {integer_text("actual_ytd")} || ' year to date', {GAP_CLASS}
      from board where row_type = 'total_excl'""",
    "chart_series": f"""{CUSTOMERS} select unit_code, attainment,
      row_number() over (order by attainment desc, unit_code) as rank,
      {percent_text("attainment", 0)} as bar_label
      from board where row_type = 'unit' and attainment is not null""",
}
