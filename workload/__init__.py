"""Queries over the driver tables, each beside its SQL check."""
from importlib import import_module

MODULES = ("q_clean", "q_facts", "q_measures", "q_windows", "q_writes", "q_incremental", "q_quality", "q_sources", "q_streams", "q_star", "q_refresh")


def load_all() -> None:
    for m in MODULES:
        import_module(f"workload.{m}")
