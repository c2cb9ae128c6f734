"""What each reader role may see of a layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewrack import domain
from tidewrack.operators.pii import apply_policy

# layer -> PII policy or explicit columns; a layer not listed is denied
GRANTS: dict[str, dict[str, dict]] = {
    "administrator": {
        "raw": {}, "bronze": {}, "silver": {}, "quarantine": {}, "gold": {"datasets": domain.GOLD_DATASETS},
    },
    "data_engineer": {
        "raw": {}, "bronze": {}, "silver": {}, "quarantine": {}, "gold": {"datasets": domain.GOLD_DATASETS},
    },
    "data_analyst": {"silver": {"policy": "analyst"}, "gold": {"datasets": domain.GOLD_DATASETS}},
    "finance_analyst": {
        "gold": {
            "datasets": ("country_performance",),
            "columns": ("country", "transactions", "volume"),
        }
    },
    "security_analyst": {"quarantine": {}, "gold": {"datasets": ("fraud_summary",)}},
    "auditor": {"gold": {"datasets": domain.GOLD_DATASETS}},
}


class AccessDenied(PermissionError):
    """The persona has no grant on the layer or dataset."""


def view_for(persona: str, layer: str, frame: DataFrame, dataset: str | None = None) -> DataFrame:
    """The frame as the persona sees it, or ``AccessDenied``."""
    grant = GRANTS.get(persona, {}).get(layer)
    if grant is None:
        raise AccessDenied(f"{persona} may not read {layer}")
    if "datasets" in grant and dataset not in grant["datasets"]:
        raise AccessDenied(f"{persona} may not read {layer}.{dataset}")
    if "columns" in grant:
        frame = frame.select(*grant["columns"])
    return apply_policy(frame, grant["policy"]) if "policy" in grant else frame
