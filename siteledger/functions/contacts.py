"""E-mails, phone numbers and tax ids (INN) of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# What counts as an e-mail and as a phone number in text.
EMAIL = r"[a-zA-Z0-9\.\-_]+@[a-zA-Z0-9_\-]+\.[a-zA-Z]+\.?[a-zA-Z]*\.?[a-zA-Z]*"
PHONE = r"\+?[78]{1}[\s\(-]{0,2}[0-9]{3,4}[\s\)]?[\s-]?[0-9-\s]{0,4}[0-9-\s]{0,5}"

# Weights of the INN check digits.
INN10_WEIGHTS = [2, 4, 10, 3, 5, 9, 4, 6, 8]
INN12_WEIGHTS_11 = [7, 2, 4, 10, 3, 5, 9, 4, 6, 8]
INN12_WEIGHTS_12 = [3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8]

# Ten or twelve digits between word boundaries; the first digit is looked for before what surrounds it.
_INN_IN_TEXT = r"(?U)[0-9](?<!\w[0-9])[0-9]{9}(?:[0-9]{2})?(?!\w)"

# A hit can only begin where a run of e-mail characters begins or where the
# last hit ended, so a long run without "@" is read once and not once per
# character.
_EMAIL_IN_TEXT = r"(?:\G|(?<![a-zA-Z0-9.\-_]))" + EMAIL


def _find_all(col: Column, pattern: str) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(0))


def _after_colon(href: Column) -> Column:
    return F.element_at(F.split(href, ":"), -1)


def emails(text: Column, links: Column) -> Column:
    """Distinct e-mails of the text and of ``mailto:`` links; case is kept."""
    in_text = F.when(F.contains(text, F.lit("@")), _find_all(text, _EMAIL_IN_TEXT)).otherwise(
        F.array().cast("array<string>")
    )
    mailto = F.filter(links, lambda a: F.contains(a["href"], F.lit("mailto:")))
    in_links = F.transform(mailto, lambda a: F.regexp_extract(_after_colon(a["href"]), EMAIL, 0))
    found = F.filter(F.concat(in_text, in_links), lambda e: e != F.lit(""))
    return F.array_distinct(F.transform(found, lambda e: F.trim(e, F.lit("\"'.,"))))


def phones(text: Column, links: Column) -> Column:
    """Distinct 11-digit numbers starting with 7 or 8, digits only.

    Both spellings of one number (7... and 8...) stay separate entries.
    """
    tel = F.filter(links, lambda a: F.contains(a["href"], F.lit("tel:")))
    in_links = F.transform(
        tel, lambda a: F.when(a["text"] != F.lit(""), a["text"]).otherwise(_after_colon(a["href"]))
    )
    raw = F.concat(_find_all(text, "(?U)" + PHONE), in_links)
    digits = F.transform(raw, lambda n: F.regexp_replace(n, "[^0-9]", ""))
    return F.array_distinct(F.filter(digits, lambda n: F.regexp_like(n, F.lit("^[78][0-9]{10}$"))))


def _check_digit_matches(number: Column, length: int, weights: list[int], strict_mod10: bool) -> Column:
    """Weighted sum of the leading digits, mod 11, equals the next digit."""

    def digit(position: int) -> Column:
        return F.call_function("div", number, F.lit(10 ** (length - position)).cast("bigint")) % 10

    total = sum((digit(i) * w for i, w in enumerate(weights, start=1)), F.lit(0))
    key = total % 11
    if strict_mod10:
        key = key % 10
    return key == digit(len(weights) + 1)


def is_valid_inn(inn: Column, strict_mod10: bool = False) -> Column:
    """Check digits of a 10- or 12-digit INN; false for anything else.

    A weighted sum of 10 (mod 11) can match no digit, so such ids are
    rejected; the official rule takes it mod 10 again (``strict_mod10``).
    """

    def ten(number: Column) -> Column:
        return _check_digit_matches(number, 10, INN10_WEIGHTS, strict_mod10)

    def twelve(number: Column) -> Column:
        return _check_digit_matches(number, 12, INN12_WEIGHTS_11, strict_mod10) & _check_digit_matches(
            number, 12, INN12_WEIGHTS_12, strict_mod10
        )

    number = inn.try_cast("bigint")
    return F.coalesce(
        F.when(F.regexp_like(inn, F.lit("^[0-9]{10}$")), let(number, ten)).when(
            F.regexp_like(inn, F.lit("^[0-9]{12}$")), let(number, twelve)
        ),
        F.lit(False),
    )


def inns(text: Column, strict_mod10: bool = False) -> Column:
    """Distinct 10- and 12-digit numbers of the text with right check digits."""
    found = F.array_distinct(_find_all(text, _INN_IN_TEXT))
    return F.filter(found, lambda n: is_valid_inn(n, strict_mod10))
