"""Key expressions: name-based UUIDs and 64-bit link hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The DNS namespace of RFC 4122 and the separator between key parts.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
PART_SEPARATOR = "#$#"


def uuid5(text: Column) -> Column:
    """Version-5 UUID of a text in the DNS namespace, computed inside the JVM.

    The name is hashed with SHA-1 after the namespace bytes; then the version and
    variant digits are written over digits 13 and 17.
    """
    return uuid_of(name_digest(text))


def name_digest(text: Column) -> Column:
    """What ``uuid_of`` makes a UUID of."""
    return F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(text.cast("string"), "UTF-8")))


def uuid_of(digest: Column) -> Column:
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def with_keys(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """Add a UUID for each text.

    The digests are a step of their own: an aggregation right below would else work out a digest again for each part of the UUID.
    """
    return (df.withColumns({f"_digest_{name}": name_digest(text) for name, text in texts.items()})
            .withColumns({name: uuid_of(F.col(f"_digest_{name}")) for name in texts}))


def joined_key(*parts: Column) -> Column:
    """UUID of several parts put together with the fixed separator."""
    return uuid5(key_text(*parts))


def key_text(*parts: Column) -> Column:
    """The text that ``joined_key`` hashes."""
    if len(parts) == 1:
        return parts[0].cast("string")
    return F.concat_ws(PART_SEPARATOR, *[F.coalesce(part.cast("string"), F.lit("None")) for part in parts])


def link_hash(*parts: Column) -> Column:
    """64-bit key of a link between hubs."""
    return F.xxhash64(*parts)
