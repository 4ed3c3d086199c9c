"""The pricing rules as SQL functions.

Scalar functions with DECIMAL and STRUCT results and one table function, all
with SQL bodies: Catalyst inlines them, so a query that rates through SQL has
the plan of one that rates through DataFrames. They are temporary; register
them in each session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterbill.schemas import (DEFAULT_TARIFF, HOME_PREFIX, LOYALTY_TAG, MONEY, PRICE, RATED, RATED_CDR, STATUS_OK,
                               STUDENT_TAG, UNMATCHED, TariffRules)

_MONEY, _PRICE = MONEY.simpleString(), PRICE.simpleString()
_VOLUME = "decimal(24,6)"


def _function(spark: SparkSession, name: str, args: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")


def register_predicates(spark: SparkSession, rules: TariffRules = DEFAULT_TARIFF) -> None:
    """``is_peak_hour(h)``, ``is_weekend_day(wd)``, ``is_international(peer)``:
    true or false, false for null."""
    days = ", ".join(str(d) for d in rules.weekend_days)
    _function(spark, "is_peak_hour", "h INT", "BOOLEAN",
              f"coalesce(h >= {rules.peak_start_hour} AND h < {rules.peak_end_hour}, false)")
    _function(spark, "is_weekend_day", "wd INT", "BOOLEAN", f"coalesce(wd IN ({days}), false)")
    _function(spark, "is_international", "p STRING", "BOOLEAN", f"coalesce(NOT startswith(p, '{HOME_PREFIX}'), false)")


def register_pricing(spark: SparkSession, rules: TariffRules = DEFAULT_TARIFF) -> None:
    """``voice_cost(duration_sec, unit_price, hour, weekday, peer_id)``,
    ``data_cost(data_volume_mb, unit_price)``, ``sms_cost(unit_price)``: exact
    DECIMAL costs, 0 where an input is null (a volume too large for money gives
    NULL); ``base_cost(...)`` picks one by record type, 0 for unknown types;
    ``apply_discounts(base_cost, activation_date, is_student, as_of)``: a STRUCT
    of the final cost and the comma-joined discounts (NULL for none)."""
    register_predicates(spark, rules)
    _function(spark, "voice_cost", "duration_sec INT, unit_price DOUBLE, h INT, wd INT, peer_id STRING", _MONEY,
              f"CAST(coalesce(CAST(duration_sec AS DECIMAL(10,0)) * CAST(unit_price AS {_PRICE})"
              f" * CASE WHEN is_peak_hour(h) THEN {rules.peak_factor}BD ELSE 1.00BD END"
              f" * CASE WHEN is_weekend_day(wd) THEN {rules.weekend_factor}BD ELSE 1.00BD END"
              f" * CASE WHEN is_international(peer_id) THEN {rules.international_factor}BD ELSE 1.00BD END, 0) AS {_MONEY})")
    _function(spark, "data_cost", "data_volume_mb DOUBLE, unit_price DOUBLE", _MONEY,
              f"CASE WHEN data_volume_mb IS NULL OR unit_price IS NULL THEN CAST(0 AS {_MONEY})"
              f" ELSE try_cast(try_cast(data_volume_mb AS {_VOLUME}) * CAST(unit_price AS {_PRICE}) AS {_MONEY}) END")
    _function(spark, "sms_cost", "unit_price DOUBLE", _MONEY,
              f"CAST(coalesce(CAST(unit_price AS {_PRICE}), 0) AS {_MONEY})")
    _function(spark, "base_cost", "record_type STRING, duration_sec INT, data_volume_mb DOUBLE, unit_price DOUBLE,"
              " event_time TIMESTAMP, peer_id STRING", _MONEY,
              "CASE record_type WHEN 'voice' THEN voice_cost(duration_sec, unit_price, hour(event_time),"
              " dayofweek(event_time) - 1, peer_id)"
              " WHEN 'data' THEN data_cost(data_volume_mb, unit_price) WHEN 'sms' THEN sms_cost(unit_price)"
              f" ELSE CAST(0 AS {_MONEY}) END")
    loyal = f"coalesce(activation_date <= date_sub(as_of, {rules.loyalty_days}), false)"
    student = "coalesce(is_student, false)"
    _function(spark, "apply_discounts", f"base_cost {_MONEY}, activation_date DATE, is_student BOOLEAN, as_of DATE",
              f"STRUCT<final_cost: {_MONEY}, discounts: STRING>",
              f"named_struct('final_cost', CAST(base_cost"
              f" * CASE WHEN {loyal} THEN {rules.loyalty_factor}BD ELSE 1.00BD END"
              f" * CASE WHEN {student} THEN {rules.student_factor}BD ELSE 1.00BD END AS {_MONEY}),"
              f" 'discounts', nullif(concat_ws(',', CASE WHEN {loyal} THEN '{LOYALTY_TAG}' END,"
              f" CASE WHEN {student} THEN '{STUDENT_TAG}' END), ''))")


def register_rating(spark: SparkSession, normalized: DataFrame, customers: DataFrame, rates: DataFrame, rated: DataFrame,
                    rules: TariffRules = DEFAULT_TARIFF) -> None:
    """The table function ``rate(as_of)``: the rows that rating would add to
    ``rated``. The four inputs become temporary views (``rating_cdr``,
    ``rating_customers``, ``rating_prices``, ``rating_done``)."""
    register_pricing(spark, rules)
    for name, df in (("cdr", normalized), ("customers", customers), ("prices", rates), ("done", rated)):
        df.createOrReplaceTempView(f"rating_{name}")
    computed = {"unit_price": f"CAST(unit_price AS {_PRICE})", "base_cost": "base", "final_cost": "discounted.final_cost",
                "discount_applied": "discounted.discounts", "record_hash": "record_hash", "msisdn": "msisdn",
                "rating_status": f"CASE WHEN matched THEN '{RATED}' ELSE '{UNMATCHED}' END"}
    always = ("record_hash", "msisdn", "rating_status")
    columns = ", ".join(f"{computed[f.name]} AS {f.name}" if f.name in always else
                        f"CASE WHEN matched THEN {computed.get(f.name, f.name)} END AS {f.name}" for f in RATED_CDR.fields)
    returns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RATED_CDR.fields)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION rate(as_of DATE) RETURNS TABLE({returns}) RETURN
        SELECT {columns} FROM (
          SELECT *, customer_id IS NOT NULL AND unit_price IS NOT NULL AND base IS NOT NULL AS matched,
                 apply_discounts(base, activation_date, is_student, rate.as_of) AS discounted
          FROM (
            SELECT n.*, c.customer_id, c.rate_plan_id, c.activation_date, c.is_student, p.unit_price,
                   base_cost(n.record_type, n.duration_sec, n.data_volume_mb, p.unit_price, n.timestamp, n.peer_id) AS base
            FROM rating_cdr n
            LEFT ANTI JOIN rating_done d ON d.record_hash = n.record_hash
            LEFT JOIN rating_customers c ON c.customer_id = n.msisdn AND c.status = 'active'
            LEFT JOIN rating_prices p ON p.rate_plan_id = c.rate_plan_id AND p.service_type = n.record_type
            WHERE n.status = '{STATUS_OK}'))""")
