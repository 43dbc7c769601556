"""Query-string parameters of URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_query_param(url: Column, key: str) -> Column:
    """Value of ``key`` in the URL's query string, percent-decoded.

    Taken by pattern, so URLs that strict parsers refuse (``|``, ``{``, a bad
    ``%``) keep their parameters; a value that does not decode stays as it is.
    The fragment is not part of the query.  An empty value (``?utm_source=``)
    is returned as NULL.
    """
    value = F.regexp_extract(F.regexp_replace(url, "#.*$", ""), f"[?&]{re.escape(key)}=([^&]*)", 1)
    decoded = F.when(value.contains("%"), F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value))
    return F.when(value != "", F.coalesce(decoded, value))
