"""Hash keys for hubs, links, satellites and marts (KEY-2, KEY-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: namespace of the name-based UUID keys of the order warehouse.
ORDER_NAMESPACE = "d4dc5ac0-49c6-49c9-b5f4-5fdc183e9c7a"

NULL_MARK = "\\N"


def joined(*cols, sep: str = "|") -> Column:
    """Text of all parts with a separator; a null part keeps its place.

    Different parts give different texts: a backslash or separator inside a
    part is escaped, and so is a single text that begins like the null mark.
    With ``sep=""`` parts are put together as they are.
    """
    texts = [_col(c).cast("string") for c in cols]
    if len(texts) == 1:
        clash = F.when(texts[0].startswith("\\"), F.concat(F.lit("\\"), texts[0])).otherwise(texts[0])
        return F.coalesce(clash, F.lit(NULL_MARK))
    if sep:
        texts = [F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep)) for t in texts]
    return F.concat_ws(sep, *[F.coalesce(t, F.lit(NULL_MARK)) for t in texts])


def hash_key(*cols, algorithm: str = "xxhash64") -> Column:
    """Hash of the business key's text, so that equal keys of different integer
    widths agree: 64-bit by default, or ``md5`` text."""
    if algorithm == "xxhash64":
        return F.xxhash64(joined(*cols))
    if algorithm == "md5":
        return F.md5(F.encode(joined(*cols), "UTF-8"))
    raise ValueError(f"unknown algorithm {algorithm!r}")


def uuid5_key(*cols, namespace: str = ORDER_NAMESPACE, sep: str = "|") -> Column:
    """Name-based UUID (version 5, RFC 4122), equal to ``uuid.uuid5``."""
    name = F.encode(joined(*cols, sep=sep), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name))
    # The variant is the top two bits of the 17th digit, set to binary 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
