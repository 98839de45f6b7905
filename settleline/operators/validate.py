"""Batch validation as a Spark job: error column, valid/quarantine split, quality report.

Every rule is a Catalyst expression (``functions.rules``); the whole check is
one projection, so validation costs one columnar scan and no shuffle.  The
report is a single global aggregate (partial per task, one tiny final merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import VALIDATED_FIELDS, Rules
from ..functions.rules import error_list, field_validity, row_is_valid
from ..schema import LANDING_FIELDS
from ..sources.landing import CORRUPT


def with_errors(landing: DataFrame, rules: Rules) -> DataFrame:
    """Landing rows plus ``is_valid`` and ``errors`` ARRAY<STRING> (rule order).

    Messages are only built for invalid rows; ``is_valid`` is a plain boolean.
    """
    ok = row_is_valid(rules)
    empty = F.array().cast("array<string>")
    return landing.select(
        "*",
        ok.alias("is_valid"),
        F.when(ok, empty).otherwise(error_list(rules)).alias("errors"),
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    """Valid rows of a checked frame (only the boolean is evaluated)."""
    return checked.filter(F.col("is_valid")).drop("errors", "is_valid")


def valid_landing(landing: DataFrame, rules: Rules) -> DataFrame:
    """Valid rows straight from landing: one boolean filter, no message strings."""
    return landing.filter(row_is_valid(rules))


def quarantine(checked: DataFrame) -> DataFrame:
    """Invalid rows as {record: <landing struct>, errors: [...]}; with ``raw_text``, the text of
    records that were no JSON, where the landing rows came with it (``landing.CORRUPT``)."""
    record = F.struct(*[F.col(c) for c in (*LANDING_FIELDS, "is_flagged")])
    raw = [F.col(CORRUPT).alias("raw_text")] if CORRUPT in checked.columns else []
    return checked.filter(~F.col("is_valid")).select(record.alias("record"), "errors", *raw)


def report_columns(rules: Rules) -> list[Column]:
    """Aggregate expressions of the quality report over landing rows (usable in
    ``agg`` or ``observe``).  A row has at most one error per field, so each
    category count is the number of rows failing that field's rule; no message
    text is built."""
    ok = row_is_valid(rules)
    cols = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("invalid"),
    ]
    valid = field_validity(rules)
    cols += [F.count_if(~valid[f]).alias(f"errors_{f}") for f in VALIDATED_FIELDS]
    return cols


def _valid_rate(valid: Column, total: Column) -> Column:
    # round(valid / max(total, 1) * 100, 2) on exact decimals.
    q = (valid * F.lit(100)).cast("decimal(22,0)") / F.greatest(total, F.lit(1)).cast("decimal(20,0)")
    return F.round(q, 2).cast("decimal(5,2)")


def _breakdown_map(counters: dict[str, Column]) -> Column:
    entries = F.array(*[F.struct(F.lit(f).alias("k"), c.alias("v")) for f, c in counters.items()])
    nonzero = F.filter(entries, lambda e: e["v"] > 0)
    return F.map_from_entries(nonzero)


def report(landing: DataFrame, rules: Rules) -> DataFrame:
    """One row: total, valid, invalid, valid_rate, error_breakdown MAP<STRING,BIGINT>.

    A global aggregate always yields one row, so an empty batch reports 0 / 0.00;
    each task pre-aggregates, only one row per task reaches the final merge.
    """
    agg = landing.agg(*report_columns(rules))
    counters = {f: F.col(f"errors_{f}") for f in VALIDATED_FIELDS}
    return agg.select(
        "total",
        "valid",
        "invalid",
        _valid_rate(F.col("valid"), F.col("total")).alias("valid_rate"),
        _breakdown_map(counters).alias("error_breakdown"),
    )


def report_from_metrics(metrics: dict) -> dict:
    """Python dict of the report from ``observe`` metrics (no extra Spark job)."""
    total = int(metrics.get("total", 0) or 0)
    valid = int(metrics.get("valid", 0) or 0)
    breakdown = {}
    for f in VALIDATED_FIELDS:
        n = int(metrics.get(f"errors_{f}", 0) or 0)
        if n:
            breakdown[f] = n
    return {
        "total": total,
        "valid": valid,
        "invalid": int(metrics.get("invalid", 0) or 0),
        "valid_rate": round(valid / max(total, 1) * 100, 2),
        "error_breakdown": breakdown,
    }


def error_breakdown(landing: DataFrame, rules: Rules) -> DataFrame:
    """Long form: (category, error_count) for every category that occurred.

    One global partial aggregate of six boolean counters, then an unpivot of
    the single result row: no per-error rows are ever shuffled.
    """
    counters = landing.agg(*report_columns(rules)[3:])
    pairs = F.array(*[
        F.struct(F.lit(f).alias("category"), F.col(f"errors_{f}").alias("error_count"))
        for f in VALIDATED_FIELDS
    ])
    return (
        counters.select(F.explode(pairs).alias("p"))
        .select("p.category", "p.error_count")
        .filter(F.col("error_count") > 0)
    )
