"""Reading a lane id, ``[-]edge_laneIndex``.

A leading ``-`` marks the opposite direction of the same road; lanes inside a
junction start with ``:``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_ID_MODES = ("fixed2", "last_underscore")


def signed_edge(lane: Column, mode: str = "fixed2") -> Column:
    """The lane id without its lane index, the direction sign still on it.

    ``fixed2`` takes off the last two characters, which is right for one-digit lane
    indexes only; ``last_underscore`` takes off the last ``_`` and what follows.
    """
    _check(mode)
    if mode == "fixed2":
        return F.left(lane, F.length(lane) - 2)
    return F.regexp_replace(lane, "_[^_]*$", "")


def edge_id(lane: Column, mode: str = "fixed2") -> Column:
    """The road a lane belongs to, the same for both directions.

    ``fixed2`` keeps what stands between the leading ``-`` and the next one;
    ``last_underscore`` drops exactly the leading ``-``.
    """
    edge = signed_edge(lane, mode)
    unsigned = F.substr(edge, F.lit(2))
    if mode == "fixed2":
        unsigned = F.substring_index(unsigned, "-", 1)
    return F.when(F.startswith(edge, F.lit("-")), unsigned).otherwise(edge)


def direction(lane: Column, mode: str = "fixed2") -> Column:
    """0 for the opposite direction, 1 otherwise (also for NULL)."""
    return F.when(F.startswith(signed_edge(lane, mode), F.lit("-")), 0).otherwise(1)


def lane_index(lane: Column) -> Column:
    return F.substring_index(lane, "_", -1)


def junction_edge(lane: Column) -> Column:
    """Edge of a lane inside a junction: ``:18_1`` for ``:18_1_0``."""
    return F.substring_index(lane, "_", 2)


def _check(mode: str) -> None:
    if mode not in EDGE_ID_MODES:
        raise ValueError(f"edge_id_mode must be one of {EDGE_ID_MODES}, not {mode!r}")
