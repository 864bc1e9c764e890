"""Column expressions shared by the plans. Nothing here reads a table or the clock
unless ``as_of`` is None."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse import rules

AsOf = datetime | str | None


def as_of_ts(as_of: AsOf) -> Column:
    """``as_of`` as a zone-less timestamp; the clock only when none is given."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_of_date(as_of: AsOf) -> Column:
    return as_of_ts(as_of).cast("date")


def lookback_start(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_of_date(as_of), days)


def parsed_ts(df: DataFrame, name: str) -> Column:
    """Timestamp column; text that does not parse becomes NULL."""
    dtype = df.schema[name].dataType.simpleString()
    if dtype == "timestamp_ntz":
        return F.col(name)
    return F.col(name).try_cast("timestamp_ntz")


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """A constant as SQL text."""
    if not isinstance(value, str):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def now_sql(as_of: AsOf) -> str:
    """``as_of_ts`` as SQL text."""
    return "localtimestamp()" if as_of is None else f"TIMESTAMP_NTZ {literal(str(as_of))}"


def ts_sql(df: DataFrame, name: str) -> str:
    """``parsed_ts`` as SQL text."""
    if df.schema[name].dataType.simpleString() == "timestamp_ntz":
        return quoted(name)
    return f"try_cast({quoted(name)} AS TIMESTAMP_NTZ)"


def on_or_after(ts: Column, day: Column) -> Column:
    """``date(ts) >= day`` written on the bare column, so a scan can push it down."""
    return ts >= day.cast("timestamp_ntz")


def keyed(value: Column, mapping: dict, default: object = None) -> Column:
    """Constant looked up by value. A map evaluates ``value`` once, a CASE once per arm."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL when whole is 0 or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole * F.lit(100.0), digits)).otherwise(F.lit(0.0))


# --- subscribers -------------------------------------------------------------

def has_access(product: str) -> Column:
    """Product access by plan; an unknown plan has none."""
    return F.coalesce(F.col("plan_type").isin(rules.PLAN_ACCESS[product]), F.lit(False))


def bundle_tier(plan: Column) -> Column:
    return keyed(plan, rules.TIER_OF_PLAN, "single_product")


def tier_label(plan: Column) -> Column:
    return keyed(bundle_tier(plan), rules.TIER_LABELS)


def mrr_of_tier(tier: Column) -> Column:
    named = {t: m for t, m in rules.MRR_OF_TIER.items() if t != "single_product"}
    return keyed(tier, named, rules.MRR_OF_TIER["single_product"])


def tenure_days(start: Column, end: Column, today: Column) -> Column:
    return F.datediff(F.coalesce(end, today), start)


def tenure_to_date(start: Column, today: Column) -> Column:
    """Days since the start, never negative; NULL start stays NULL."""
    days = F.datediff(today, start)
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0)))


def simple_risk(churned: Column, tenure: Column, plan: Column) -> Column:
    """The dashboard's bucket; the first that holds."""
    label = rules.RISK_BUCKETS
    return (F.when(churned, label["churned"]).when(tenure < rules.NEW_BELOW_DAYS, label["new"])
            .when(plan.isin(rules.BUNDLE_PLANS), label["bundle"]).otherwise(label["other"]))


def churn_risk_tier(days_idle: Column, tier: Column, products_engaged: Column) -> Column:
    """First rule that holds. A full bundle idle for longer than dormant meets none of the idle rules."""
    gone = (days_idle >= rules.HIGH_RISK_IDLE_DAYS) & tier.isin(rules.HIGH_RISK_TIERS)
    cooling = days_idle.between(*rules.DORMANT_DAYS) | ((products_engaged == 1) & tier.isin(rules.BUNDLE_TIERS))
    return (F.when(gone, rules.RISK_TIERS["high"]).when(cooling, rules.RISK_TIERS["medium"])
            .otherwise(rules.RISK_TIERS["low"]))


# --- events ------------------------------------------------------------------

def capped_dwell(seconds: Column) -> Column:
    """Cap at 30 minutes. ``least`` skips NULL, so a missing dwell is kept apart."""
    value = seconds.cast("double")
    return F.when(value.isNotNull(), F.least(value, F.lit(rules.DWELL_CAP_SEC)))


def clamped_ts(ts: Column, now: Column) -> Column:
    return F.when(ts > now, now).otherwise(ts)


def lag_us(event_ts: Column, arrival_ts: Column) -> Column:
    """Whole microseconds between two zone-less timestamps.

    Taken from their difference, which no time zone enters; ``timestampdiff``
    would read both in the session's zone and lose or gain a clock change.
    """
    seconds = (arrival_ts - event_ts).cast("interval second").cast("decimal(24,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def us_to_hours(us: Column) -> Column:
    return us / F.lit(3_600_000_000.0)


def lag_bucket(hours: Column) -> Column:
    """Right-closed bins; a lag of zero or less, or none, has no bucket."""
    out = F.when(~(hours > 0) | hours.isNull(), F.lit(None).cast("string"))
    for upper, label in rules.LAG_BUCKETS:
        out = out.otherwise(label) if upper is None else out.when(hours <= upper, label)
    return out


# --- quality -----------------------------------------------------------------

def score_label(score: Column) -> Column:
    return F.when(score >= rules.PASS_AT, "PASS").when(score >= rules.WARN_AT, "WARN").otherwise("FAIL")


def weighted(terms: list[tuple[Column, float]]) -> Column:
    return reduce(add, [value * F.lit(weight) for value, weight in terms])


def issue_list(*messages: Column) -> Column:
    """Array of the messages that are not NULL."""
    return F.array_compact(F.array(*messages))


def day(value: str) -> Column:
    return F.lit(date.fromisoformat(value))
