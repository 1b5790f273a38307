"""Column functions with the null, NaN and rounding rules of the data model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers for "no value" in published sheets.
MISSING_MARKERS = ["-", "--", "---", "...", ""]

# First digit of a state code to the name of its region.
REGION_NAMES = {1: "Norte", 2: "Nordeste", 3: "Sudeste", 4: "Sul", 5: "Centro-Oeste"}

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Half-to-even on the scaled binary double; adding zero turns -0.0 into 0.0."""
    scale = float(10**digits)
    return F.rint(col(c).cast("double") * scale) / scale + F.lit(0.0)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def to_number(c: Column | str) -> Column:
    """Text to double; markers and anything that is not a plain number become null."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null for a zero or null denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def state_code(area: Column | str, digits: int = 5) -> Column:
    """Leading part of an area code: the code without its last `digits` digits."""
    return F.floor(col(area) / F.lit(10**digits)).cast("bigint")


def lookup(c: Column | str, table: Mapping) -> Column:
    """Literal map lookup; an unknown key gives null."""
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    return F.try_element_at(F.create_map(*pairs), col(c))


def region_name(state: Column | str) -> Column:
    return lookup(F.floor(col(state) / F.lit(10)).cast("int"), REGION_NAMES)


def log1p_safe(c: Column | str) -> Column:
    return F.log1p(F.greatest(col(c).cast("double"), F.lit(0.0)))


def per_capita(amount_thousands: Column | str, people: Column | str) -> Column:
    people = col(people)
    return F.when(people > 0, ratio(F.lit(1000.0) * col(amount_thousands), people))


def clean_text(c: Column | str, drop: Sequence[str] = (), lower: bool = False) -> Column:
    out = col(c).cast("string")
    for token in drop:
        out = F.replace(out, F.lit(token), F.lit(""))
    out = F.trim(out)
    return F.lower(out) if lower else out


def year_in_header(name: Column | str, stem: str) -> Column:
    """Year suffix of a header `STEM_YYYY`; null when the header is anything else."""
    return F.regexp_extract(col(name), rf"^{stem}_(\d{{4}})$", 1).try_cast("int")


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limits a value and keeps null (greatest and least would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def band_label(index: Column | str, bands: int) -> Column:
    i = col(index)
    return F.format_string("%.1f a %.1f", i / F.lit(float(bands)), (i + 1) / F.lit(float(bands)))


def met_target(value: Column | str, target: Column | str, missing_value_fails: bool) -> Column:
    """value >= target. Without a target: null. Without a value: null, or false when asked."""
    value, target = col(value), col(target)
    hit = value >= target
    if missing_value_fails:
        hit = F.coalesce(hit, F.lit(False))
    return F.when(target.isNotNull(), hit)


def key_hash(keys: Sequence[Column | str], seed: int | str) -> Column:
    """60-bit number from md5(seed|key|...): the only source of randomness in this package."""
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
