"""Validation rules as Catalyst expressions.

Each rule is an ordered list of (failure condition, message) pairs: the first
condition that holds gives the field's single error message.  Two forms are
built from the same lists:

* ``field_validity`` / ``row_is_valid`` — plain booleans (no strings built),
  used on the hot path that keeps valid rows and for the report counters;
* ``error_list`` — ARRAY<STRING> of all failing rules in rule order, used only
  where messages are needed (quarantine, report).

Messages start with the field name, which is the data-quality error category.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ACCOUNT_PATTERN, CURRENCY_PATTERN, UUID_PATTERN, Rules
from .parsing import (
    ISO_TIMESTAMP_PATTERN,
    NAN_PATTERN,
    clean_number_text,
    parse_double,
    parse_timestamp,
    python_float_text,
)

Rule = list[tuple[Column, Column]]
_MIN_POSITIVE = 5e-324  # smallest positive double


def as_of(rules: Rules) -> Column:
    """The "now" of the future-timestamp rule as naive UTC.

    Without a fixed one it is ``current_timestamp()``, which Spark fixes per query
    and, in a stream, per micro-batch; the session's time zone plays no part.
    """
    if rules.as_of is not None:
        return F.lit(rules.as_of).cast("timestamp_ntz")
    seconds = (F.unix_micros(F.current_timestamp()) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def _blank(c: Column) -> Column:
    # The reference tests truthiness: NULL and "" are both "missing".
    return c.isNull() | (c == "")


def _msg(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def transaction_id_rule(c: Column) -> Rule:
    return [
        (_blank(c), F.lit("transaction_id is missing or null")),
        (~c.rlike(UUID_PATTERN), _msg("transaction_id is not a valid UUID: ", c)),
    ]


def amount_rule(c: Column, rules: Rules) -> Rule:
    v = parse_double(c)
    return [
        (c.isNull(), F.lit("amount is missing or null")),
        (v.isNull() | c.rlike(NAN_PATTERN), _msg("amount is not a valid number: ", c)),
        (v <= 0, _msg("amount must be positive, got ", python_float_text(v))),
        (v >= float(rules.max_amount), _msg(f"amount exceeds maximum ({rules.max_amount:,}): ", python_float_text(v))),
    ]


def account_id_rule(c: Column) -> Rule:
    return [
        (_blank(c), F.lit("account_id is missing or null")),
        (~c.rlike(ACCOUNT_PATTERN), _msg("account_id does not match ACC_XXXXX pattern: ", c)),
    ]


def timestamp_rule(c: Column, now: Column) -> Rule:
    ts = F.when(c.rlike(ISO_TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))
    return [
        (_blank(c), F.lit("timestamp is missing or null")),
        (ts.isNull(), _msg("timestamp is not valid ISO format: ", c)),
        (ts > now, _msg("timestamp is in the future: ", c)),
    ]


def transaction_type_rule(c: Column, rules: Rules) -> Rule:
    return [
        (_blank(c), F.lit("transaction_type is missing or null")),
        (~c.isin(*rules.transaction_types), _msg("transaction_type is invalid: ", c)),
    ]


def currency_rule(c: Column) -> Rule:
    return [
        (_blank(c), F.lit("currency is missing or null")),
        (~c.rlike(CURRENCY_PATTERN), _msg("currency is not a valid 3-letter code: ", c)),
    ]


def all_rules(rules: Rules) -> list[Rule]:
    """The six field rules in the reference's order."""
    return [
        transaction_id_rule(F.col("transaction_id")),
        amount_rule(F.col("amount"), rules),
        account_id_rule(F.col("account_id")),
        timestamp_rule(F.col("timestamp"), as_of(rules)),
        transaction_type_rule(F.col("transaction_type"), rules),
        currency_rule(F.col("currency")),
    ]


def _message(rule: Rule) -> Column:
    first_cond, first_msg = rule[0]
    out = F.when(first_cond, first_msg)
    for cond, msg in rule[1:]:
        out = out.when(cond, msg)
    return out


def field_validity(rules: Rules) -> dict[str, Column]:
    """Per field, a boolean that is true exactly when the field's rule passes.

    Written so each input column is referenced exactly once (NULL and "" fail the
    pattern tests by themselves).  The optimizer pushes this predicate below
    computed source projections (a JSON payload parse, a view) and inlines the
    projection at every reference, so one reference means one evaluation.
    """
    number = clean_number_text(F.col("amount")).try_cast("double")
    # 0 < v < max as one BETWEEN (evaluated once); NaN and +-inf fall outside.
    below_max = math.nextafter(float(rules.max_amount), 0.0)
    return {
        "transaction_id": F.coalesce(F.col("transaction_id").rlike(UUID_PATTERN), F.lit(False)),
        "amount": F.coalesce(number.between(_MIN_POSITIVE, below_max), F.lit(False)),
        "account_id": F.coalesce(F.col("account_id").rlike(ACCOUNT_PATTERN), F.lit(False)),
        "timestamp": F.coalesce(parse_timestamp(F.col("timestamp")) <= as_of(rules), F.lit(False)),
        "transaction_type": F.coalesce(F.col("transaction_type").isin(*rules.transaction_types), F.lit(False)),
        "currency": F.coalesce(F.col("currency").rlike(CURRENCY_PATTERN), F.lit(False)),
    }


def row_is_valid(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, field_validity(rules).values())


def error_list(rules: Rules) -> Column:
    """ARRAY<STRING> of all failing rules in rule order (no short-circuit)."""
    checks = F.array(*[_message(r) for r in all_rules(rules)])
    return F.filter(checks, lambda e: e.isNotNull())
