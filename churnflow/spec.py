"""Declarative description of one dataset: roles, allowed values and ranges of its columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the operators need to know about a table.

    ``categories`` maps every categorical column, the target included, to its allowed values;
    ``domains`` and ``minimums`` constrain numerical columns. ``blank_allowed`` columns may hold
    whitespace-only cells, which feature preparation turns into missing values.
    """

    columns: tuple[str, ...]
    id_column: str
    target: str
    positive: str
    negative: str
    numericals: tuple[str, ...]
    categories: Mapping[str, tuple[str, ...]]
    blank_allowed: frozenset[str] = frozenset()
    domains: Mapping[str, tuple[float, ...]] = field(default_factory=dict)
    minimums: Mapping[str, float] = field(default_factory=dict)
    integers: frozenset[str] = frozenset()
    optional_in_request: frozenset[str] = frozenset()
    trim_categories: bool = False

    @property
    def categoricals(self) -> tuple[str, ...]:
        """Categorical feature columns: every categorical column but the target."""
        return tuple(c for c in self.categories if c != self.target)

    @property
    def feature_width(self) -> int:
        """Number of prepared columns when every allowed category occurs."""
        return len(self.numericals) + sum(len(self.categories[c]) for c in self.categoricals)


# The column names, category values and limits of the telecom subscriber table.
_YES_NO = ("Yes", "No")
_INTERNET_ADD_ON = ("Yes", "No", "No internet service")
_TELECOM_COLUMNS = (
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
)
_TELECOM_CATEGORIES = {
    "gender": ("Male", "Female"),
    "Partner": _YES_NO,
    "Dependents": _YES_NO,
    "PhoneService": _YES_NO,
    "MultipleLines": ("Yes", "No", "No phone service"),
    "InternetService": ("DSL", "Fiber optic", "No"),
    "OnlineSecurity": _INTERNET_ADD_ON,
    "OnlineBackup": _INTERNET_ADD_ON,
    "DeviceProtection": _INTERNET_ADD_ON,
    "TechSupport": _INTERNET_ADD_ON,
    "StreamingTV": _INTERNET_ADD_ON,
    "StreamingMovies": _INTERNET_ADD_ON,
    "Contract": ("Month-to-month", "One year", "Two year"),
    "PaperlessBilling": _YES_NO,
    "PaymentMethod": (
        "Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)",
    ),
    "Churn": _YES_NO,
}


def telecom_spec(**overrides) -> DatasetSpec:
    """The 21-column telecom subscriber table; keyword arguments replace single fields."""
    fields = dict(
        columns=_TELECOM_COLUMNS,
        id_column="customerID",
        target="Churn",
        positive="Yes",
        negative="No",
        numericals=("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"),
        categories=_TELECOM_CATEGORIES,
        blank_allowed=frozenset({"TotalCharges"}),
        domains={"SeniorCitizen": (0.0, 1.0)},
        minimums={"tenure": 0.0, "MonthlyCharges": 0.0, "TotalCharges": 0.0},
        integers=frozenset({"SeniorCitizen", "tenure"}),
        optional_in_request=frozenset({"TotalCharges"}),
    )
    return DatasetSpec(**(fields | overrides))
