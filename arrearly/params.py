"""Run parameters and the fixed business values of the collections rules.

Every rule that the warehouse query evaluated against ``current_date()`` takes
``Params.as_of`` instead, so a run is reproducible and back-datable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. These must equal the production rule set for results to match;
# they are listed verbatim and in their original order.
# ---------------------------------------------------------------------------

# Collection queue campaigns (10).
QUEUE_CAMPAIGNS: tuple[str, ...] = (
    "PROD_Pre-Collections",
    "Special_Pre-Collections",
    "PROD_Hard Collections",
    "Special Campaign_Hard Collections",
    "PROD_Soft Collections_Daily",
    "Special Campaign_Soft Collections",
    "SIP_Prod_Reminder",
    "Collection HaRD PTPr",
    "Collection Hard BROKEN PTP",
    "Collections_Soft PTPr",
)

# Campaigns whose unconnected calls count as "no contact" (53).
CONTACT_CAMPAIGNS: tuple[str, ...] = (
    "WCL MARCH 3",
    "WCL FINAL SPIN 2",
    "WCL PART 2 2072022",
    "SIP_Pre-Collections",
    "Testing_Collections",
    "PROD_Pre-Collections",
    "Collections_Soft PTPr",
    "OB WCL July 18 Spin 2",
    "OB WCL July 18 Spin 3",
    "OB WCL July 26 spin 3",
    "OB WCL Spin 1 July 18",
    "PROD_Hard Collections",
    "WCL 2 - Feb 21 Spin 2",
    "Special_HaRD_Collection",
    "WCL 2 - 1st Spin Feb 24",
    "WCL 3rd Attempt 1302022",
    "WCL FEB 18 to 20 Spin 2",
    "WCL - 1st Attempt 222022",
    "WCL - 1st Attempt 282022",
    "WCL - 1st attempt 212022",
    "WCL 2 - FEB 22 - 3RD SPIN",
    "WCL 2 Feb 24 to 27 SPIN 3",
    "Collection Hard BROKEN PTP",
    "PROD_Soft Collections_Daily",
    "Collections_Possible Fraud.2",
    "FEB 16 - SPIN 1 - WCL Skill 2",
    "Special Campaign_WCL_Collection",
    "Special Campaign_Pre Collections",
    "Collections-Daily Outbound_Manual",
    "Collections_Special_Pre-Col_May30",
    "Collections_normalization special",
    "Special Campaign_Hard Collections",
    "Special Campaign_Soft Collections",
    "Tonik Agentless -Collection",
    "WCL 2 - FEB 22 - SPIN 3",
    "WCL - 1st Attempt 1302022",
    "WCL - 2nd Attempt 1302022",
    "WCL Skill 2 - Feb 11 - 1st Spin",
    "WCL 2 Spin 3 2192022",
    "WCL 2nd attempt 212022",
    "WCL 2 - 2nd SPIN Feb 24",
    "WCL - 3rd attempt 282022",
    "FEB 16 - WCL 2 - 3rd Spin",
    "WCL 2 - 1ST SPIN - FEB 22",
    "WCL 2 - 3rd SPIN - FEB 23",
    "WCL 2 - FEB 17 - 2nd Spin",
    "WCL 2 - FEB 18 - 1ST SPIN",
    "WCL SKill 2 - feb 10 - 3rd spin",
    "WCL Skill 2 - 2nd Spin - Feb 23",
    "WCL 2nd Attempt -222022",
    "WCL 2 - FEB 24 - 3rd SPIN",
    "WCL SKILL 2 - FEB 10 2022 - 2nd SPIN",
    "Collection HaRD PTPr",
)

# Wrap-up disposition patterns, matched against upper(coalesce(wrapup, 'NA')).
# Each entry is (kind, text): "contains" = LIKE '%text%', "prefix" = LIKE 'text%'.
# Any-party contact (APC), in rule order.
APC_PATTERNS: tuple[tuple[str, str], ...] = (
    ("contains", "COLLECTION"),
    ("contains", "DELAY"),
    ("contains", "DUE"),
    ("prefix", "PAYMENT"),
    ("contains", "WRAP"),
    ("contains", "HANG"),
    ("contains", "PROMISE"),
    ("contains", "PTP REMINDER"),
    ("contains", "UNSUCCESSFUL"),
    ("contains", "CALL"),
    ("contains", "PROMISE TO PAY"),
    ("contains", "DROP CALL"),
    ("contains", "PAID"),
    ("contains", "DEAD AIR"),
    ("contains", "3RD PARTY"),
)
# Right-party contact (RPC), in rule order.
RPC_PATTERNS: tuple[tuple[str, str], ...] = (
    ("contains", "COLLECTION"),
    ("contains", "DELAY"),
    ("contains", "DUE"),
    ("contains", "HANG"),
    ("prefix", "PAYMENT"),
    ("contains", "PROMISE"),
    ("contains", "PTP REMINDER"),
    ("contains", "CALL BACK"),
    ("contains", "PROMISE TO PAY"),
    ("contains", "DROP CALL"),
    ("contains", "PAID"),
)
# Third-party contact (TPC), in rule order.
TPC_PATTERNS: tuple[tuple[str, str], ...] = (
    ("contains", "3RD PARTY"),
    ("contains", "UNSUCCESSFUL"),
    ("contains", "DEAD AIR"),
)

# Text searched (lower-cased) in sub-disposition / wrap-up for a refusal.
REFUSAL_TEXT = "refuse"
# Installment status that keeps a loan in Segment A/B (see the inverted rule).
PARTIAL_PAYMENT_STATUS = "PARTIALPAYMENT"
# Sentinel used for a missing payment date before the window test.
NO_PAYMENT_SENTINEL = "3000-01-01"
# Output labels, in priority order.
SEGMENT_LABELS: tuple[str, ...] = ("Segment A", "Segment B", "Segment C")
NO_SEGMENT_LABEL = "NA"

# Product classes: (loanType, ...) -> name. The conditions live in
# functions.columns.product_class; these are the output names.
PRODUCT_SIL = "SIL"
PRODUCT_SIL_ONLINE = "SIL-Online"
PRODUCT_QL_FLEX = "QL FLEX"
PRODUCT_QL_BO = "QL BO"

# Run date of the deterministic test fixtures; real runs pass their own.
FIXTURE_AS_OF = dt.date(2024, 2, 10)


@dataclass(frozen=True)
class Params:
    """Everything a run depends on besides the five input tables."""

    as_of: dt.date
    # DPD bands, (low, high]: a loan is in a band when low < dpd <= high.
    band_a: tuple[int, int | None] = (20, 60)
    band_b: tuple[int, int | None] = (60, 90)
    band_c: tuple[int, int | None] = (90, None)
    # Trailing windows in days, inclusive on both ends after truncation to day.
    kept_promise_days: int = 60
    paid_days: int = 60
    unconnected_days: int = 30
    # Inclusive DPD ranges of the bucket-flow rules.
    bucket_entry_dpd: tuple[int, int] = (61, 90)
    early_dpd: tuple[int, int] = (1, 20)
    # Segment A needs more than this many call x early-DPD-day matches.
    min_early_attempts: int = 10
    queue_campaigns: tuple[str, ...] = QUEUE_CAMPAIGNS
    contact_campaigns: tuple[str, ...] = CONTACT_CAMPAIGNS

    @staticmethod
    def of(as_of: str | dt.date, **kw) -> "Params":
        if isinstance(as_of, str):
            as_of = dt.date.fromisoformat(as_of)
        return Params(as_of=as_of, **kw)

    @property
    def as_of_iso(self) -> str:
        return self.as_of.isoformat()
