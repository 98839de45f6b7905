"""Business rules and thresholds, as one frozen value passed to every operator."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

# --- Fixed values: these must equal the reference's for identical results. ---
# Allowed transaction types, in the order the reference lists them.
TRANSACTION_TYPES = (
    "WAGER_PLACEMENT",
    "WAGER_SETTLEMENT",
    "REFUND",
    "ACCOUNT_DEPOSIT",
    "ACCOUNT_WITHDRAWAL",
    "FEE_CHARGE",
)
# Field patterns (anchored at the very end, ASCII digits only).
UUID_PATTERN = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
ACCOUNT_PATTERN = r"^ACC_[0-9]{5}\z"
CURRENCY_PATTERN = r"^[A-Z]{3}\z"
# Validation field order; the first word of every error message is the field name.
VALIDATED_FIELDS = ("transaction_id", "amount", "account_id", "timestamp", "transaction_type", "currency")
# Alert type names.
HIGH_FREQUENCY = "HIGH_FREQUENCY"
HIGH_DAILY_AMOUNT = "HIGH_DAILY_AMOUNT"
RAPID_SUCCESSION = "RAPID_SUCCESSION"
# --- end of fixed values ---


@dataclass(frozen=True)
class Rules:
    """Thresholds with the reference's values as defaults.

    ``as_of`` is the "now" of the future-timestamp rule, an ISO string read as
    naive UTC.  ``None`` means the wall clock (UTC) of the running query: one value
    per batch query, and a new one for each micro-batch of a stream.  Entry points
    that run several queries over one batch freeze it first (``frozen``).
    """

    transaction_types: tuple[str, ...] = TRANSACTION_TYPES
    max_amount: int = 100_000            # amount must be < this
    suspicious_amount: int = 5_000       # amount > this is suspicious
    night_hours: tuple[int, int] = (1, 5)  # inclusive hour range that is suspicious
    small_below: int = 100               # amount < this -> small
    medium_upto: int = 1_000             # amount <= this -> medium, else large
    burst_window_sec: int = 3_600        # HIGH_FREQUENCY trailing window (inclusive)
    burst_min_exclusive: int = 10        # trailing count must exceed this
    daily_amount_limit: int = 50_000     # account-day sum must exceed this
    rapid_gap_sec: int = 30              # gap to previous must be below this
    as_of: str | None = None
    dedupe: bool = True                  # drop redelivered transaction_ids before aggregating
    # Width of the time buckets that split one account's rows across tasks
    # (row-level LAG/LEAD windows); must be > 0.  One minute caps a window
    # partition even for an account holding a third of all rows; the
    # per-bucket neighbour table stays bounded by minutes of activity.
    # Histogram windows use whole days.
    pattern_bucket_sec: int = 60
    # Bucket width of the per-second histogram windows (at least the look-back).
    histogram_bucket_sec: int = 86_400

    def with_(self, **kw) -> "Rules":
        return replace(self, **kw)

    def frozen(self) -> "Rules":
        """The same rules with a fixed "now": the current time if none is set."""
        if self.as_of is not None:
            return self
        return self.with_(as_of=datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" "))


DEFAULT_RULES = Rules()
