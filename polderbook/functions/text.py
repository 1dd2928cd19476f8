"""SQL text for string clean-up and lax value parsing, without Python UDFs."""

from __future__ import annotations

# Every code point with the Unicode White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# The words read as booleans.
TRUE_WORDS = ("1", "true", "t", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "f", "no", "n", "off")

_NUMBER = r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+(\.0*)?\s*$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]00:00(:00(\.0+)?)?(Z|[+-]00:?00)?)?$"


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPACES = "'" + "".join(f"\\u{c:04x}" for c in WHITE_SPACE) + "'"


def strip(col: str) -> str:
    """Remove leading and trailing white space of any kind."""
    return f"btrim({col}, {_SPACES})"


def in_list(col: str, values: tuple[str, ...]) -> str:
    """Membership as one call, which keeps the generated code short."""
    return f"find_in_set({col}, {quoted(','.join(values))}) > 0"


def text_to_double(col: str) -> str:
    return f"CASE WHEN {col} RLIKE {quoted(_NUMBER)} THEN try_cast(trim({col}) AS DOUBLE) END"


def text_to_int(col: str) -> str:
    whole = f"split_part(trim({col}), '.', 1)"
    return f"CASE WHEN {col} RLIKE {quoted(_WHOLE_NUMBER)} THEN try_cast({whole} AS INT) END"


def text_to_bool(col: str) -> str:
    yes, no = in_list(f"lower({col})", TRUE_WORDS), in_list(f"lower({col})", FALSE_WORDS)
    return f"CASE WHEN {yes} THEN true WHEN {no} THEN false END"


def text_to_date(col: str) -> str:
    """ISO dates, also when written as a midnight timestamp."""
    return f"CASE WHEN {col} RLIKE {quoted(_DAY)} THEN try_cast(left({col}, 10) AS DATE) END"
