"""Country codes and regions as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv


def alpha2(code, extended=False, strict=False) -> Column:
    """Two-letter code of a three-letter one, in any letter case.

    A code outside the list gives its own first two letters, as written; null if `strict`.
    """
    code = _col(code)
    listed = fv.ALPHA3.strip()
    if extended:
        listed = f"{listed}, {fv.ALPHA3_EXTENDED}"
    pairs = F.str_to_map(F.lit(" ".join(listed.split())), F.lit(", "), F.lit(" "))
    known = F.try_element_at(pairs, F.upper(code))
    return known if strict else F.coalesce(known, F.substring(code, 1, 2))


def country_upper(code) -> Column:
    """Upper-case two-letter key; null gives the empty string."""
    code = _col(code)
    return F.upper(
        F.when(F.length(code) == 3, alpha2(code)).otherwise(
            F.substring(F.coalesce(code, F.lit("")), 1, 2)
        )
    )


def country_lower(code, extended=False) -> Column:
    """Lower-case trimmed key; only three-letter codes are shortened, null stays."""
    code = _col(code)
    return F.lower(F.trim(F.when(F.length(code) == 3, alpha2(code, extended)).otherwise(code)))


def trimmed_lower(text) -> Column:
    """The event side of a lower-case country match."""
    return F.lower(F.trim(_col(text)))


def region(country, europe=None) -> Column:
    """Sales region of a two-letter code; unknown and null are the rest."""
    key = F.lower(_col(country))
    return (
        F.when(key.isin(list(europe or fv.EUROPE)), fv.REGION_EUROPE)
        .when(key.isin(fv.NORTH_AMERICA), fv.REGION_NORTH_AMERICA)
        .otherwise(fv.REGION_OTHER)
    )


def _col(c):
    return F.col(c) if isinstance(c, str) else c
