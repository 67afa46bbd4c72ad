"""Nested field access by path: ``"data.iaqi.co.v"``, ``"weather[0].id"``.

Array positions go through ``F.get`` (null when out of range or when the
array is null) instead of ``arr[i]``, which raises under ANSI mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"([A-Za-z_][A-Za-z0-9_]*)(?:\[(\d+)\])?")


def at(root: Column, path: str) -> Column:
    col = root
    for part in path.split("."):
        m = _STEP.fullmatch(part)
        if m is None:
            raise ValueError(f"bad path step {part!r} in {path!r}")
        col = col.getField(m.group(1))
        if m.group(2) is not None:
            col = F.get(col, int(m.group(2)))
    return col
