"""JSON values with the truthiness and text forms that Python gives them.

Values come as VARIANT, which keeps apart what plain text does not: the number 0 from
the text "0", an explicit null from an absent key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitrank.functions.binding import applied, bound

# Scientific text of a DOUBLE is split into leading digit, further digits and exponent of
# ten; the point is then placed for the exponent. Other text is already in fixed notation.
_FLOAT_TEXT = r"""
number -> transform(array(split(cast(number AS string), '[.E]')), part -> CASE
    WHEN size(part) = 3 THEN transform(array(named_struct(
            'sign', CASE WHEN startswith(part[0], '-') THEN '-' ELSE '' END,
            'digits', ltrim('-', part[0]) || rtrim('0', part[1]),
            'power', cast(part[2] AS int))),
        n -> n.sign || CASE
            WHEN n.power < -4 OR n.power >= 16 THEN
                left(n.digits, 1)
                || CASE WHEN length(n.digits) > 1 THEN '.' || substr(n.digits, 2) ELSE '' END
                || format_string('e%+03d', n.power)
            WHEN n.power < 0 THEN '0.' || repeat('0', -n.power - 1) || n.digits
            WHEN length(n.digits) <= n.power + 1 THEN rpad(n.digits, n.power + 1, '0') || '.0'
            ELSE left(n.digits, n.power + 1) || '.' || substr(n.digits, n.power + 2)
        END)[0]
    WHEN endswith(part[0], 'Infinity') THEN replace(part[0], 'Infinity', 'inf')
    ELSE concat_ws('.', part)
END)[0]
"""

# A variant drops a zero fraction, so a whole number too wide for 64 bits and a decimal
# look alike: both are DECIMAL. Only the wide ones are taken as whole.
_TEXT = rf"""
value -> transform(array(named_struct(
        'kind', regexp_extract(schema_of_variant(value), '^[A-Z]+', 0),
        'text', cast(value AS string))),
    v -> CASE v.kind
        WHEN 'STRING' THEN nullif(v.text, '')
        WHEN 'BIGINT' THEN nullif(v.text, '0')
        WHEN 'BOOLEAN' THEN CASE WHEN v.text = 'true' THEN 'True' END
        WHEN 'ARRAY' THEN nullif(v.text, '[]')
        WHEN 'OBJECT' THEN nullif(v.text, '{{}}')
        ELSE CASE
            WHEN v.kind = 'DECIMAL' AND v.text RLIKE r'^-?\d{{19,}}\z' THEN v.text
            WHEN cast(v.text AS double) <> 0
                THEN transform(array(cast(v.text AS double)), {_FLOAT_TEXT})[0]
        END
    END)[0]
"""


def variant_at(value: Column, path: str) -> Column:
    """The variant at ``path``; NULL where the path is absent or crosses a non-object."""
    return F.try_variant_get(value, path, "variant")


def python_float_text(number: Column) -> Column:
    """Text of a DOUBLE as Python writes it: fixed notation from 1e-4 up to 1e16.

    The digits are the JVM's; before JDK 19 it may write a 17th where 16 would do.
    """
    return bound(number, _FLOAT_TEXT)


def stringify_or_null(value: Column) -> Column:
    """Text of a truthy variant; NULL for NULL, null, false, zero, "", [] and {}.

    Booleans read ``True``; numbers written with a point or an exponent take the float
    form, whole numbers keep their digits; arrays and objects become compact JSON.
    """
    return bound(value, _TEXT)


# A VARIANT holds no more digits of a whole number, and gives a DOUBLE beyond them.
_VARIANT_DIGITS = 38


def has_wide_number(body: Column) -> Column:
    """Whether JSON text may hold a whole number that a VARIANT rounds."""
    return body.rlike(rf"\d{{{_VARIANT_DIGITS + 1}}}")


def exact_text_or_null(value: Column, text: Column) -> Column:
    """``stringify_or_null`` with all digits of whole numbers; ``text`` is the value as text, taken from
    the JSON itself, or NULL where ``has_wide_number`` denies."""
    # A string of as many digits reads the same.
    wide = text.rlike(rf"\A-?\d{{{_VARIANT_DIGITS + 1},}}\z")
    return F.when(wide, text).otherwise(stringify_or_null(value))


def is_truthy(value: Column) -> Column:
    return stringify_or_null(value).isNotNull()


def first_truthy(*candidates: Column) -> Column:
    """Text of the first truthy variant, else the empty text."""
    texts = F.array_compact(applied(F.array(*candidates), _TEXT))
    return F.coalesce(F.try_element_at(texts, F.lit(1)), F.lit(""))
