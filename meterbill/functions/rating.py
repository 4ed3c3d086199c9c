"""Rating arithmetic as native Columns (replaces row-at-a-time UDFs).

All costs are DECIMAL: inputs are cast to decimal first, multiplied
exactly, and the product is rounded once to DECIMAL(18,6).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions.money import as_money, as_price, dlit
from meterbill.schemas import DEFAULT_TARIFF, HOME_PREFIX, LOYALTY_TAG, MONEY, STUDENT_TAG, TariffRules

ONE = "1.00"
VOLUME = T.DecimalType(24, 6)


def event_hour(ts: Column) -> Column:
    return F.hour(ts)


def event_weekday(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1


def is_peak(hour: Column, rules: TariffRules = DEFAULT_TARIFF) -> Column:
    return F.coalesce((hour >= rules.peak_start_hour) & (hour < rules.peak_end_hour), F.lit(False))


def is_weekend(weekday: Column, rules: TariffRules = DEFAULT_TARIFF) -> Column:
    return F.coalesce(weekday.isin(*rules.weekend_days), F.lit(False))


def is_international(peer: Column) -> Column:
    return F.coalesce(~peer.startswith(HOME_PREFIX), F.lit(False))


def _factor(cond: Column, factor: str) -> Column:
    return F.when(cond, dlit(factor)).otherwise(dlit(ONE))


def voice_cost(duration: Column, price: Column, hour: Column, weekday: Column,
               peer: Column, rules: TariffRules = DEFAULT_TARIFF) -> Column:
    amount = (duration.cast(T.DecimalType(10, 0)) * as_price(price)
              * _factor(is_peak(hour, rules), rules.peak_factor)
              * _factor(is_weekend(weekday, rules), rules.weekend_factor)
              * _factor(is_international(peer), rules.international_factor))
    return as_money(F.coalesce(amount, F.lit(0)))


def data_cost(volume_mb: Column, price: Column) -> Column:
    """Volume to the byte (6 decimals of a MB). NULL where the volume or its
    price is too large for the money type: such a record cannot be priced."""
    amount = (volume_mb.try_cast(VOLUME) * as_price(price)).try_cast(MONEY)
    return F.when(volume_mb.isNull() | price.isNull(), as_money(F.lit(0))).otherwise(amount)


def is_priceable(record_type: Column, volume_mb: Column, price: Column) -> Column:
    return F.coalesce(record_type != "data", F.lit(True)) | data_cost(volume_mb, price).isNotNull()


def sms_cost(price: Column) -> Column:
    return as_money(F.coalesce(as_price(price), F.lit(0)))


def base_cost(record_type: Column, duration: Column, volume_mb: Column, price: Column,
              hour: Column, weekday: Column, peer: Column,
              rules: TariffRules = DEFAULT_TARIFF) -> Column:
    """Dispatch on record type; unknown types cost 0."""
    return (F.when(record_type == "voice", voice_cost(duration, price, hour, weekday, peer, rules))
            .when(record_type == "data", data_cost(volume_mb, price))
            .when(record_type == "sms", sms_cost(price))
            .otherwise(as_money(F.lit(0))))


def is_loyal_at_rating(activation_date: Column, as_of: dt.date,
                       rules: TariffRules = DEFAULT_TARIFF) -> Column:
    cutoff = as_of - dt.timedelta(days=rules.loyalty_days)
    return F.coalesce(activation_date <= F.lit(cutoff), F.lit(False))


def discounted_cost(cost: Column, activation_date: Column, is_student: Column,
                    as_of: dt.date, rules: TariffRules = DEFAULT_TARIFF) -> Column:
    """Loyalty then student, multiplicative."""
    loyal = is_loyal_at_rating(activation_date, as_of, rules)
    student = F.coalesce(is_student, F.lit(False))
    return as_money(cost * _factor(loyal, rules.loyalty_factor) * _factor(student, rules.student_factor))


def discount_tags(activation_date: Column, is_student: Column, as_of: dt.date,
                  rules: TariffRules = DEFAULT_TARIFF) -> Column:
    """Comma-joined tags, NULL when no discount applies."""
    loyal = is_loyal_at_rating(activation_date, as_of, rules)
    student = F.coalesce(is_student, F.lit(False))
    joined = F.concat_ws(",", F.when(loyal, F.lit(LOYALTY_TAG)), F.when(student, F.lit(STUDENT_TAG)))
    return F.when(joined != "", joined)


def register_sql_functions(spark, rules: TariffRules = DEFAULT_TARIFF) -> None:
    """The rating predicates for SQL callers (``functions/sql.py`` has the costs,
    the discounts and rating as a table function)."""
    from meterbill.functions.sql import register_predicates
    register_predicates(spark, rules)
