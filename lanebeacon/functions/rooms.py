"""Reducing free-text locations and booked rooms to room names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, str]]

# Room tags inside location texts, and the names reported for them.
PLACEHOLDER = "change_me"
UNKNOWN = "unknown"
AUDITORIUMS: Rules = (("aud1", "Aud1"), ("aud2", "Aud2"))
LECTURE_ROOMS: Rules = (("aud1", "Aud 1"), ("aud2", "Aud 2"), ("aud3", "Aud 3"), ("aud4", "Aud 4"))


def room_name(text: Column, rules: Rules) -> Column:
    """Name of the first rule whose tag occurs in ``text``, whatever its case; else NULL."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(F.contains(lowered, F.lit(tag)), label) for tag, label in rules])


def without_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))
