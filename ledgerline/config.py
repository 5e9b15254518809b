"""Business constants.

Fixed values that must equal the source system's rules for the marts to agree
(recency/frequency/monetary thresholds, window lengths and bucket count):
  vip:           recency <= 30 days, orders >= 5, spend >= 500
  new_customer:  recency <= 30 days, orders <= 2
  churn_risk:    recency > 45 days,  orders <= 3
  inactivity:    > 90 days inactive, > 45 days at_risk, else active
  spend windows: last 30 days, previous 30 days (31..60)
  CLV groups:    5 buckets by lifetime value, 1 = high_clv, 5 = low_clv
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    vip_max_recency: int = 30
    vip_min_orders: int = 5
    vip_min_spend: float = 500.0
    new_max_recency: int = 30
    new_max_orders: int = 2
    churn_min_recency: int = 45
    churn_max_orders: int = 3
    inactive_after_days: int = 90
    at_risk_after_days: int = 45
    window_days: int = 30
    clv_buckets: int = 5


DEFAULT_THRESHOLDS = Thresholds()


# Output labels and type names that must equal the source
# system's, in the order the rules assign them.
UNKNOWN_LABEL = "unknown"
LOYALTY_LABEL, NON_LOYALTY_LABEL = "loyalty", "non_loyalty"
WEEKEND_LABEL, WEEKDAY_LABEL = "weekend", "weekday"
HIGH_CLV, MEDIUM_CLV, LOW_CLV = "high_clv", "medium_clv", "low_clv"
VIP, NEW_CUSTOMER, CHURN_RISK, STANDARD = "vip", "new_customer", "churn_risk", "standard"
INACTIVE, AT_RISK, ACTIVE = "inactive", "at_risk", "active"
DAILY, WEEKLY, MONTHLY = "daily", "weekly", "monthly"
LOYALTY_METRIC, LOCATION_METRIC, DISCOUNT_METRIC = "loyalty_program_impact", "location_performance", "discount_effectiveness"
DISCOUNTED, NON_DISCOUNTED = "discounted_orders", "non_discounted_orders"

# Fixed "as of" date used by the registered queries so results are reproducible:
# the last order date present in every testdata scale.
TESTDATA_AS_OF = _dt.date(2001, 8, 1)
