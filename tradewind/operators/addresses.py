"""Address documents to columns, each document parsed once.

``json_tuple`` is a generator, so the optimizer keeps it as one parse. A struct from
``from_json`` would be split into one pruned parse per field that is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import null_if_empty

# fixed values: column -> key of an address document
FIELDS = {
    "city": "city",
    "province": "province",
    "province_code": "provinceCode",
    "country": "country",
    "country_code": "countryCodeV2",
    "postal_code": "zip",
}
NO_ADDRESS = "|||"


def parse_addresses(df: DataFrame, text: str, prefix: str = "", fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """Add one column per address part; empty text becomes NULL."""
    names = [prefix + name for name in fields]
    parsed = df.select("*", F.json_tuple(F.col(text), *[FIELDS[name] for name in fields]).alias(*names))
    return parsed.withColumns({name: null_if_empty(F.col(name)) for name in names})


def address_key(prefix: str = "") -> Column:
    """Lower-case ``city|province|country|zip``, the lookup key of a geography."""
    parts = [F.coalesce(F.col(prefix + name), F.lit("")) for name in ("city", "province", "country", "postal_code")]
    return F.lower(F.concat_ws("|", *parts))


def address_digest(prefix: str = "") -> Column:
    """SHA-256 over the six normalised parts."""
    lower = ("city", "province", "country")
    parts = [
        F.trim((F.lower if name in lower else F.upper)(F.coalesce(F.col(prefix + name), F.lit("")))) for name in FIELDS
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)
