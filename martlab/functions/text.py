"""Address, state and flag expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import as_column

# State, district and territory names with their two-letter postal codes.
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO",
    "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH",
    "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT",
    "Virginia": "VA", "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
    "District of Columbia": "DC", "Puerto Rico": "PR", "Guam": "GU", "Virgin Islands": "VI",
    "American Samoa": "AS", "Northern Mariana Islands": "MP",
}

# Street suffixes of the basic profile.
BASIC_SUFFIXES = (
    "Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Drive|Dr|Court|Ct|Lane|Ln|Way|Place|Pl|Circle|Cir|Terrace|Ter|"
    "Highway|Hwy|Parkway|Pkwy|Pike|Loop|Trail|Trl|Run|Pass|Commons?|Plaza|Center|Centre|Square|Sq"
)
# Further street suffixes of the extended profile.
MORE_SUFFIXES = (
    "Cove|Cv|Creek|Crk|Crossing|Xing|Expressway|Expy|Freeway|Fwy|Glen|Gln|Grove|Grv|Heights|Hts|Hollow|Holw|"
    "Junction|Jct|Key|Ky|Knoll|Knl"
)
# Box patterns and flag spellings.
PO_BOX_PATTERNS = ("P.O.%", "PO BOX%", "P O BOX%")
MORE_PO_BOX_PATTERNS = ("POST OFFICE BOX%",)
TRUE_FLAGS = ("Y", "YES", "TRUE", "1")

ZIP_PATTERN = r"^\d{5}(-\d{4})?\z"


def is_blank(c: str | Column) -> Column:
    c = as_column(c)
    return c.isNull() | (F.trim(c) == "")


def flag_is_set(c: str | Column) -> Column:
    """True for Y, YES, TRUE or 1 in any case, also on boolean and number columns; False for NULL."""
    return F.coalesce(F.upper(as_column(c).cast("string")).isin(*TRUE_FLAGS), F.lit(False))


def _true_or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def address_flags(
    street: str | Column,
    zip_code: str | Column,
    *,
    profile: str = "basic",
    ignore_case: bool = False,
    state: str | Column | None = None,
) -> dict[str, Column]:
    """Named boolean columns that describe a street address and ZIP code.

    `basic` judges the box patterns on the untrimmed text and takes any leading digits as a street number;
    `extended` trims first, knows more box and suffix words, allows `&` and `'` in the name and wants a blank
    after the number. `loose` only asks for a number followed by three more characters. With `state`, the flag
    `is_valid_state` is added.
    """
    if profile not in ("basic", "extended", "loose"):
        raise ValueError("profile must be one of: 'basic', 'extended', 'loose'")
    raw = as_column(street)
    trimmed = F.trim(raw)
    # The patterns of a number, of a street name and of a whole address.
    boxes, number, body, suffixes = PO_BOX_PATTERNS, r"^\d+", r"[\w\s\.\-]", BASIC_SUFFIXES
    boxed = raw
    if profile == "extended":
        boxes = PO_BOX_PATTERNS + MORE_PO_BOX_PATTERNS
        number, body, suffixes = r"^\d+[A-Za-z]?\s", r"[\w\s\.\-&']", BASIC_SUFFIXES + "|" + MORE_SUFFIXES
        boxed = trimmed
    full = rf"^\d+[A-Za-z]?\s+{body}{{2,}}\s+({suffixes})\.?(\s+.+)?\z"
    if profile == "loose":
        full = r"^[0-9]+[A-Za-z]?\s+.{3,}"
    if ignore_case:
        full = "(?i)" + full
    box = F.lit(False)
    for pattern in boxes:
        box = box | boxed.ilike(pattern)
    flags = {
        "is_null_address": is_blank(raw),
        "is_po_box": _true_or_false(box),
        "has_street_number": _true_or_false(trimmed.rlike(number)),
        "is_valid_street_address": _true_or_false(trimmed.rlike(full)),
        "is_valid_zip": _true_or_false(F.trim(as_column(zip_code)).rlike(ZIP_PATTERN)),
    }
    if state is not None:
        codes = sorted(US_STATES.values())
        flags["is_valid_state"] = _true_or_false(F.upper(F.trim(as_column(state))).isin(*codes))
    return flags


def zip5(zip_code: str | Column) -> Column:
    return F.left(F.trim(as_column(zip_code)), F.lit(5))


def normalize_state(c: str | Column, lookup: Mapping[str, str] = US_STATES) -> Column:
    """Two-letter code for a code or a full name in any case; NULL for blank or unknown text.

    The lookup is a small Python mapping, so it travels as a literal in the plan and needs no join.
    """
    key = F.upper(F.trim(as_column(c)))
    entries: dict[str, str] = {}
    for name, code in lookup.items():
        entries.setdefault(name.upper(), code.upper())
    entries.update({code.upper(): code.upper() for code in lookup.values()})
    table = F.create_map(*[F.lit(v) for pair in entries.items() for v in pair])
    return F.when(key != "", F.try_element_at(table, key))


def shown(c: Column, dtype: T.DataType) -> Column:
    """A value as users see it: `True` and `False`, and doubles from 0.0001 up to 1e16 in plain digits with a decimal point."""
    text = c.cast("string")
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+\z", "$1")
        return F.when((F.abs(c) >= 1e-4) & (F.abs(c) < 1e16), plain).otherwise(text)
    return text
