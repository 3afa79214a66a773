"""Codes and their labels."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.functions.numeric import bucket

# Payment codes as the dashboard shows them.
PAYMENT_LABELS = {
    0: "Non renseigné",
    1: "Carte bancaire",
    2: "Espèces",
    3: "Gratuit",
    4: "Litige",
    5: "Inconnu",
    6: "Annulé",
}
PAYMENT_OTHER = "Autre"

# Distance bands in miles.
DISTANCE_BOUNDS = [1, 5, 15]
DISTANCE_LABELS = ["short", "medium", "long", "very_long"]


def decode(code: Column, labels: Mapping[int, str], default: str) -> Column:
    """Label of a code; unknown and NULL codes take ``default``."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(lookup, code), F.lit(default))


def payment_label(code: Column) -> Column:
    return decode(code.cast("int"), PAYMENT_LABELS, PAYMENT_OTHER)


def distance_category(miles: Column) -> Column:
    return bucket(miles, DISTANCE_BOUNDS, DISTANCE_LABELS)
