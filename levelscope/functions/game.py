"""Game-specific scalar expressions."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from levelscope.functions.payload import to_double

# Ad formats are matched as substrings of the lower-cased text.
INTERSTITIAL = "inter"
REWARDED = "reward|video"
SHOWN_ADS = "inter|reward|video"

# Keys of a turn payload that hold a balance.
BALANCE_KEYS = ("coin", "ticket")
BALANCE_PATTERN = "%booster%"
NOT_A_BALANCE = "use_booster_count"

BUCKETS = tuple(f"{low}-{low + 10}" for low in range(0, 100, 10))


def local_date(ts: Column, offset_hours: int) -> Column:
    return F.to_date(ts + F.make_dt_interval(hours=F.lit(offset_hours)))


def utc_literal(bound: datetime, like: str) -> Column:
    """A UTC bound as a literal of the timestamp type ``like``, so that it can be pushed down."""
    text = bound.isoformat(" ")
    return F.lit(text + " UTC" if like == "timestamp" else text).cast(like)


def game_level(text: Column, phase: Column) -> Column:
    """Level number in which a phase above one is the fractional part (level 4, phase 2 = 4.2).

    A level that already carries a fraction keeps it, except that every ``.1`` is removed from the
    text, as a first phase is the level itself.
    """
    from_phase = F.concat(
        to_double(text).try_cast("int").cast("string"), F.lit("."), phase.cast("string")
    )
    return to_double(
        F.when(F.instr(text, ".") > 1, F.replace(text, F.lit(".1"), F.lit("")))
        .when(phase > 1, from_phase)
        .otherwise(text)
    )


def first_phase(phase: Column) -> Column:
    return phase.isNull() | (phase <= 1)


def mode_after_cutoff(mode: Column, ts: Column, cutoff: Column, old: str, new: str) -> Column:
    """``old`` strictly after the cutoff becomes ``new``; everything else stays."""
    return F.when((mode == old) & (ts > cutoff), F.lit(new)).otherwise(mode)


def is_interstitial(ad_format: Column) -> Column:
    return ad_format.rlike(INTERSTITIAL)


def is_rewarded(ad_format: Column) -> Column:
    return ~ad_format.rlike(INTERSTITIAL) & ad_format.rlike(REWARDED)


def is_shown_ad(ad_format: Column) -> Column:
    return ad_format.rlike(SHOWN_ADS)


def is_balance(key: Column, amount: Column) -> Column:
    """Coin, ticket or any booster stock, not negative."""
    return (
        (key.isin(*BALANCE_KEYS) | key.like(BALANCE_PATTERN))
        & (key != NOT_A_BALANCE)
        & (amount >= 0)
    )


def balance_of(resources: Column, keys: tuple[str, ...] | None = None) -> Column:
    """Sum of a payload's balances, of all or of some ``keys``; NULL if it has no balance at all."""
    entries = F.map_entries(resources)
    held = F.filter(entries, lambda e: is_balance(e["key"], to_double(e["value"])))

    def add(total, entry):
        amount = to_double(entry["value"])
        if keys is None:
            return total + amount
        return total + F.when(entry["key"].isin(*keys), amount).otherwise(0.0)

    return F.when(F.size(held) > 0, F.aggregate(held, F.lit(0.0), add))


def completion_bucket(completion: Column) -> Column:
    """0 below 10, 1 below 20, ... 9 from 90 on: the number of bucket edges reached."""
    reached = [(completion >= edge).cast("int") for edge in range(10, 100, 10)]
    return reduce(Column.__add__, reached)


def per(amount: Column, users: Column) -> Column:
    """Plain double ratio; NULL where there is nothing to divide by."""
    return F.try_divide(amount.cast("double"), users.cast("double"))


def percent(part: Column, users: Column) -> Column:
    return per(part * F.lit(100.0), users)
