"""Time of version-1 UUIDs, and version-5 UUIDs, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 100-ns ticks from 1582-10-15 to 1970-01-01 (fixed value).
GREGORIAN_TICKS = 122_192_928_000_000_000
#: The URL namespace of version-5 UUIDs, RFC 4122 (fixed value).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
_UUID = "^([0-9a-fA-F]{8})-([0-9a-fA-F]{4})-([0-9a-fA-F]{4})-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def uuid1_micros(name: Column) -> Column:
    """Microseconds since 1970 of the UUID that ``name`` starts with, whatever its version; null without one."""
    part = lambda i: F.conv(F.regexp_extract(name, _UUID, i), 16, 10).cast("long")
    ticks = part(3).bitwiseAND(F.lit(0x0FFF)) * F.lit(1 << 48) + part(2) * F.lit(1 << 32) + part(1)
    since = ticks - F.lit(GREGORIAN_TICKS)
    return F.when(name.rlike(_UUID), F.call_function("div", since - F.pmod(since, F.lit(10)), F.lit(10)))


def uuid5_hex(name: Column) -> Column:
    """Version-5 UUID of ``name`` in the URL namespace, as 32 hex digits."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))
