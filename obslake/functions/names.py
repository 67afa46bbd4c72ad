"""Place-name normalisation.

Display form: ``initcap(trim(x))`` (words split on whitespace only, so
``clermont-FERRAND`` becomes ``Clermont-ferrand``).  Lookup form:
``upper(trim(x))``; the display form of a name and the raw name give the same
lookup key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_name(raw: Column) -> Column:
    return F.initcap(F.trim(raw))


def lookup_key(name: Column) -> Column:
    return F.upper(F.trim(name))
