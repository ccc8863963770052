"""Masking of names, phones, card and identity numbers.

Each function takes a column (or its name) and gives a STRING column. They are
built from native expressions only, so they stay inside whole-stage codegen.
NULL stays NULL: no condition holds, and the fallback is the value itself.

Two edge cases are settled here. Replacing an empty piece of text changes
nothing, so names of one character stay as they are. Characters outside the
basic plane count as one character when a piece is cut out.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name tiers, as upper bounds in UTF-8 bytes.
SHORT_NAME_BYTES = 9
MIDDLE_NAME_BYTES = 12
LONG_NAME_BYTES = 24

# Fixed values of HMAC: the block of SHA-256 in bytes, and what is XORed to the key.
HASH_BLOCK = 64
INNER_PAD, OUTER_PAD = 0x36, 0x5C


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _star_out(value: Column, start: int, size: int, stars: int) -> Column:
    """Put stars wherever the piece at ``start`` occurs in the value."""
    return F.replace(value, value.substr(start, size), F.lit("*" * stars))


def mask_name(column: Column | str) -> Column:
    """Star the middle of a name; how much depends on its size in bytes.

    The third tier writes as many stars as the name has characters, so the
    value grows by two. Names above the last tier are left as they are.
    """
    name = _text(column)
    size, chars = F.octet_length(name), F.length(name)
    middle = F.substr(name, F.lit(2), chars - 2)
    return (
        F.when(size <= SHORT_NAME_BYTES, _star_out(name, 2, 1, 1))
        .when(size <= MIDDLE_NAME_BYTES, _star_out(name, 2, 2, 2))
        .when(size <= LONG_NAME_BYTES, F.replace(name, middle, F.repeat(F.lit("*"), chars)))
        .otherwise(name)
    )


def mask_phone(column: Column | str) -> Column:
    """Write four stars over characters 4-7 and over every repeat of them."""
    phone = _text(column)
    return F.when(F.length(phone) >= 4, _star_out(phone, 4, 4, 4)).otherwise(phone)


def mask_phone_short(column: Column | str) -> Column:
    """Star the fourth character, in phones of at most four characters only."""
    phone = _text(column)
    return F.when(F.length(phone) <= 4, _star_out(phone, 4, 4, 1)).otherwise(phone)


def hash_token(column: Column | str, salt: str | None = None) -> Column:
    """SHA-256 in lower-case hex; the empty string is left alone."""
    token = _text(column)
    salted = F.concat(F.lit(salt), token) if salt else token
    return F.when(F.length(token) > 0, F.sha2(salted, 256)).otherwise(token)


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """The inner and the outer block that HMAC-SHA256 puts before what it hashes."""
    block = hashlib.sha256(key).digest() if len(key) > HASH_BLOCK else key
    block = block.ljust(HASH_BLOCK, b"\0")
    return bytes(x ^ INNER_PAD for x in block), bytes(x ^ OUTER_PAD for x in block)


def keyed_token(column: Column | str, inner: Column, outer: Column, key_id: str) -> Column:
    """HMAC-SHA256 in lower-case hex behind the key's id and a colon; the empty string is left alone.

    ``inner`` and ``outer`` are the pads of the key, as binary columns.
    """
    token = _text(column)
    first = F.unhex(F.sha2(F.concat(inner, token.cast("binary")), 256))
    digest = F.sha2(F.concat(outer, first), 256)
    return F.when(F.length(token) > 0, F.concat(F.lit(f"{key_id}:"), digest)).otherwise(token)


def mask_name_strict(column: Column | str) -> Column:
    """First and last character with stars between, whatever the length."""
    name = _text(column)
    chars = F.length(name)
    inner = F.repeat(F.lit("*"), chars - 2)
    return (
        F.when(chars > 2, F.concat(name.substr(1, 1), inner, F.right(name, F.lit(1))))
        .when(chars == 2, F.concat(name.substr(1, 1), F.lit("*")))
        .when(chars == 1, F.lit("*"))
        .otherwise(name)
    )
