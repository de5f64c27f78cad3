"""Token ids: unbounded integers kept as canonical decimal text.

An id may be 256 bits wide, which no numeric SQL type holds, so parsing and ordering
work on the digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitrank.functions.binding import bound

# Up to 15 hex digits fit a 64-bit integer. Longer text is taken in steps of 7 digits, the
# most significant first, into a number of base-10**9 limbs, the least significant first:
# every step multiplies the limbs by 16**7 and adds. Limb * 16**7 + carry stays below 2**63.
_HEX_TO_DECIMAL = r"""
hex -> CASE WHEN length(hex) <= 15 THEN conv(hex, 16, 10) ELSE
    ltrim('0', array_join(transform(reverse(aggregate(
        transform(
            sequence(1, length(hex) + pmod(-length(hex), 7), 7),
            i -> cast(conv(substr(lpad(hex, length(hex) + pmod(-length(hex), 7), '0'), i, 7), 16, 10) AS bigint)),
        cast(array() AS array<bigint>),
        (limbs, step) -> aggregate(
            limbs,
            named_struct('done', cast(array() AS array<bigint>), 'carry', step),
            (acc, limb) -> named_struct(
                'done', array_append(acc.done, (limb * 268435456L + acc.carry) % 1000000000L),
                'carry', (limb * 268435456L + acc.carry) div 1000000000L),
            acc -> CASE WHEN acc.carry > 0 THEN array_append(acc.done, acc.carry) ELSE acc.done END)
    )), limb -> lpad(cast(limb AS string), 9, '0')), ''))
END
"""


def hex_to_decimal(digits: Column) -> Column:
    """Hex digits of any length as decimal text without leading zeros."""
    return bound(F.regexp_replace(digits, "^0+(?=.)", ""), _HEX_TO_DECIMAL)


def parse_token_id(raw: Column) -> Column:
    """Canonical decimal text of a raw token id, or NULL.

    ``0x`` and hex digits are read as base 16, optional sign and digits as base 10; blanks
    around the number do not count. Everything else, the empty text included, is NULL.
    Digits outside ASCII and ``_`` between digits are not accepted.
    """
    return bound(raw, _PARSE)


# The accepted spellings of an id. White space is what Python strips; \\z, as $ also
# matches before a final line terminator.
_SPACE = r"[\t-\r\x1C-\x1F\x85\p{Z}]*"
_HEX_FORM = rf"^0x0*([0-9a-fA-F]+){_SPACE}\z"
_DECIMAL_FORM = rf"^{_SPACE}(?:\+|(-?))0*([0-9]+){_SPACE}\z"

_PARSE = rf"""
raw -> CASE
    WHEN raw RLIKE r'{_HEX_FORM}'
        THEN transform(array(regexp_extract(raw, r'{_HEX_FORM}', 1)), {_HEX_TO_DECIMAL})[0]
    WHEN raw RLIKE r'{_DECIMAL_FORM}'
        THEN regexp_replace(regexp_replace(raw, r'{_DECIMAL_FORM}', '$1$2'), '^-0$', '0')
END
"""


def numeric_order(token: Column) -> tuple[Column, Column]:
    """Two sort keys that put canonical ids in numeric order, whatever their width."""
    negative = token.startswith("-")
    return (
        F.when(negative, -F.length(token)).otherwise(F.length(token)),
        F.when(negative, F.translate(token, "0123456789", "9876543210")).otherwise(token),
    )
