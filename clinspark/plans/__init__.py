"""Registered queries over the driver's tables and their oracles."""

from importlib import import_module

CATALOGS = ["extraction", "cohort", "severity", "epochs", "comorbidity", "summary"]


def load_all() -> None:
    """Import every catalogue, which registers its queries."""
    for name in CATALOGS:
        import_module(f"clinspark.plans.{name}")
