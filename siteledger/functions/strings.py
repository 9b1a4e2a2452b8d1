"""String helpers shared by the extraction functions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# Named references of HTML 4 and ``&apos;``.
NAMED_ENTITIES = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}

# Names need their semicolon, numbers do not.
_ENTITY = r"&(?:[a-zA-Z][a-zA-Z0-9]{1,9};|#[0-9]++;?|#[xX][0-9a-fA-F]++;?)"


def python_strip(col: Column) -> Column:
    """Remove all Unicode white space on both ends (``trim`` only takes blanks)."""
    # The lookbehind keeps a long run inside the text from being tried at each of its characters.
    return F.regexp_replace(col, r"(?U)^\s++|(?<!\s)\s++\z", "")


def clean_text(col: Column) -> Column:
    """Drop line feeds, both quotes and backslashes, then strip."""
    return python_strip(F.translate(col, "\n\"'\\", ""))


def sorted_csv(col: Column) -> Column:
    """An array of strings as one comma-joined string in a fixed order."""
    return F.concat_ws(",", F.array_sort(col))


def _numeric_char(entity: Column) -> Column:
    """Character of a numeric reference, leading zeros or not; NULL when there is none."""
    digits = F.regexp_replace(entity, "^&#[xX]?0*|;$", "")
    is_hex = F.lower(entity).startswith("&#x")
    code = F.when(is_hex, digits).otherwise(F.hex(digits.try_cast("bigint")))
    padded = F.when(F.length(code) <= 8, F.lpad(code, 8, "0"))
    number = F.conv(padded, 16, 10).try_cast("bigint")
    known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(known, F.decode(F.unhex(padded), "UTF-32"))


def decode_entities(col: Column) -> Column:
    """Decode named and numeric character references in one pass; unknown ones stay."""
    pairs = "\n".join(f"{entity}={char}" for entity, char in NAMED_ENTITIES.items())
    names = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("="))

    def char(entity: Column) -> Column:
        known = F.when(F.substring(entity, 1, 2) == F.lit("&#"), _numeric_char(entity)).otherwise(F.try_element_at(names, entity))
        return F.coalesce(known, entity)

    def decode(text: Column) -> Column:
        # The texts between references, each with the reference after it.
        between, found = F.split(text, _ENTITY, -1), F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
        joined = F.zip_with(between, found, lambda t, e: F.concat(t, F.coalesce(char(e), F.lit(""))))
        return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)

    return let(col, decode)


def company_names(col: Column) -> Column:
    """Legal form of two or three capital letters followed by one word."""
    # Fixed value: the letters of the Russian legal forms.
    pattern = r"(?U)\b[ОПАЗНК]{2,3}\b\s+\b\w+\b"
    return F.array_distinct(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)))
