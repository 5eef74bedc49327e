"""Text expressions: URLs, hashed keys, label clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, _col

# Fixed value: the text that stands for NULL inside a hashed key.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(cols: list[ColumnOrName], nulls_as_empty: bool = False) -> Column:
    """md5 over the '-'-joined text of the columns, with NULL kept distinct from ''."""
    stand_in = F.lit("" if nulls_as_empty else NULL_KEY_TOKEN)
    parts = [F.coalesce(_col(c).cast("string"), stand_in) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# scheme (or none), host, path: the host ends at the first slash or question mark
_HOST = r"^(?:android-app://|https?://)?([^/?]*)"
_PATH = r"^(?:https?://)?[^/?]*(?:/([^?]*))?"


def url_host(c: ColumnOrName) -> Column:
    """Host part. Works for scheme-less and app links, which ``parse_url`` rejects."""
    return F.regexp_extract(_col(c), _HOST, 1)


def url_path(c: ColumnOrName) -> Column:
    """Text between the slash after the host and the question mark; '' without one."""
    return F.regexp_extract(_col(c), _PATH, 1)


def url_parameter(c: ColumnOrName, name: str) -> Column:
    """Value after ``name=`` up to '&'; blank or absent gives NULL."""
    return F.nullif(F.regexp_extract(_col(c), re.escape(name) + "=([^&]*)", 1), F.lit(""))


def normalise_label(c: ColumnOrName) -> Column:
    """Upper case, other than A-Z 0-9 to blank, blanks collapsed, trimmed; NULL gives ''."""
    kept = F.regexp_replace(F.upper(F.coalesce(_col(c), F.lit(""))), "[^A-Z0-9 ]+", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))
