"""Column roles.

The operators never hard-code column names: a ``Roles`` value says which
column plays the id, the target, tenure, monthly/total charges and so on, plus
the domain maps (risk scores) and bin edges.  ``Roles()`` describes the
canonical telecom customer table; ``CUSTOMER_360_ROLES`` describes the table
derived from the TPC-H-like test data (see ``sources.tables.customer_360``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Sequence

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed project's for equal results.
# Risk score maps (unmapped values fall back to 2):
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}
PAYMENT_RISK = {"Electronic check": 3, "Mailed check": 2,
                "Bank transfer (automatic)": 1, "Credit card (automatic)": 1}
# Bin edges and labels (right-closed intervals, like pandas.cut):
TENURE_BINS = (0, 12, 24, 36, 48, 72)
TENURE_LABELS = ("New", "Short", "Medium", "Long", "Loyal")
CHARGES_BINS = (0, 35, 65, 89, 120)
CHARGES_LABELS = ("Low", "Medium", "High", "Premium")
# Keyword sets that pick the service columns by (lower-cased) name:
SERVICE_KEYWORDS = ("service", "streaming", "online", "device", "tech", "multiple")
PREMIUM_KEYWORDS = ("streaming", "tech", "device", "online")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Roles:
    id: str = "customerID"
    target: str = "Churn"
    positive: str = "Yes"
    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    contract: str = "Contract"
    payment: str = "PaymentMethod"
    internet: str = "InternetService"
    phone: str = "PhoneService"
    multiple_lines: str = "MultipleLines"
    senior: str = "SeniorCitizen"
    partner: str = "Partner"
    dependents: str = "Dependents"
    yes: str = "Yes"
    no: str = "No"
    contract_risk: dict = field(default_factory=lambda: dict(CONTRACT_RISK))
    payment_risk: dict = field(default_factory=lambda: dict(PAYMENT_RISK))
    risk_default: int = 2
    tenure_bins: Sequence[float] = TENURE_BINS
    tenure_labels: Sequence[str] = TENURE_LABELS
    charges_bins: Sequence[float] = CHARGES_BINS
    charges_labels: Sequence[str] = CHARGES_LABELS
    service_keywords: Sequence[str] = SERVICE_KEYWORDS
    premium_keywords: Sequence[str] = PREMIUM_KEYWORDS

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)

    def present(self, df, *names: str) -> bool:
        cols = set(df.columns)
        return all(getattr(self, n) in cols for n in names)


# Roles of the derived customer_360 table.  Contract = market segment (three
# segments mapped, two fall to the default), payment = priority of the last
# order (four mapped, one default).  Charges bins follow the data's quartiles.
CUSTOMER_360_ROLES = Roles(
    id="customer_id", target="churn", positive="Yes",
    tenure="tenure", monthly="monthly_charges", total="total_charges",
    contract="contract", payment="payment",
    internet="svc_online_urgent", phone="partner", multiple_lines="dependents",
    senior="senior", partner="partner", dependents="dependents",
    contract_risk={"AUTOMOBILE": 3, "BUILDING": 2, "FURNITURE": 1},
    payment_risk={"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1, "4-NOT SPECIFIED": 1},
    tenure_bins=(0, 12, 24, 36, 48, 72),
    charges_bins=(0, 30000, 38000, 48000, 120000),
)
