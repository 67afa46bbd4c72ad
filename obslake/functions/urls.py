"""URL building: percent-encoding with the semantics of Python's
``urllib.parse.quote`` (safe ``/``) and secret redaction."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters whose values are API secrets and must never
# be landed in the raw table.
SECRET_PARAMS = ("token", "appid", "apikey", "api_key", "key")


def percent_encode(text: Column, keep_slash: bool = True) -> Column:
    """``url_encode`` (form encoding) turned into path-style encoding.

    Form encoding differs from ``quote`` on four characters: space (``+`` vs
    ``%20``), ``*`` (kept vs ``%2A``), ``~`` (``%7E`` vs kept) and ``/``.
    A literal ``+`` is already ``%2B`` after ``url_encode``, so replacing
    ``+`` afterwards is safe.
    """
    out = F.url_encode(text)
    out = F.replace(out, F.lit("+"), F.lit("%20"))
    out = F.replace(out, F.lit("*"), F.lit("%2A"))
    out = F.replace(out, F.lit("%7E"), F.lit("~"))
    if keep_slash:
        out = F.replace(out, F.lit("%2F"), F.lit("/"))
    return out


_SECRET = r"([?&](?:{})=)[^&#\s]*"


def redact_secrets(text: Column, params: tuple[str, ...] = SECRET_PARAMS) -> Column:
    """Replace the value of every secret query parameter with ``***``, in a
    URL or in a text that quotes one."""
    return F.regexp_replace(text, _SECRET.format("|".join(params)), "$1***")


def redact_text(text: str, params: tuple[str, ...] = SECRET_PARAMS) -> str:
    """:func:`redact_secrets` for one text of the driver."""
    return re.sub(_SECRET.format("|".join(params)), r"\1***", text)


def fill_template(template: str, **parts: Column) -> Column:
    """``format_string`` over a template with ``{name}`` placeholders."""
    fmt = template.replace("%", "%%")
    args = []
    for name in _placeholders(template):
        fmt = fmt.replace("{" + name + "}", "%s", 1)
        args.append(parts[name])
    return F.format_string(fmt, *args)


def _placeholders(template: str) -> list[str]:
    out, i = [], 0
    while True:
        start = template.find("{", i)
        if start < 0:
            return out
        end = template.index("}", start)
        out.append(template[start + 1:end])
        i = end + 1
