"""Reading ``DataFrame.observe`` metrics safely."""

from __future__ import annotations

from pyspark.sql import Observation


def observed(obs: Observation) -> dict | None:
    """The metrics of an observation, or None when the action never ran the
    observed node (AQE can replace a subtree it has proven empty, and the
    metrics then never arrive).  Callers fall back to an explicit aggregate."""
    try:
        row = obs.get
    except Exception:  # noqa: BLE001 - no metrics were collected
        return None
    metrics = row.asDict() if hasattr(row, "asDict") else dict(row)
    return metrics or None
