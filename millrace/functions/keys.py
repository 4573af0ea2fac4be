"""Document keys: escaped parts joined by a colon, hashed when too long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes; a longer key becomes ``h`` and its SHA-256.
LONGEST_KEY = 512


def escape_part(part: Column) -> Column:
    """Letters, digits and ``-_.~`` stay; every other UTF-8 byte becomes ``%HH``."""
    encoded = F.url_encode(part.cast("string"))
    return F.replace(F.replace(F.replace(encoded, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def doc_key(parts: Sequence[Column], longest: int = LONGEST_KEY) -> Column:
    """Key of a document; null if any part is (a row that cannot be addressed)."""
    joined = F.concat(*[x for i, p in enumerate(parts) for x in ([F.lit(":")] if i else []) + [escape_part(p)]])
    return F.when(F.octet_length(joined) > longest, F.concat(F.lit("h"), F.sha2(joined.cast("binary"), 256))).otherwise(joined)
