"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from both ends. Spark's one-argument trim() only removes
# blanks, while the business rule removes any whitespace (tabs from ERP exports).
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def norm_upper(c: Column | str) -> Column:
    """Categorical text: no surrounding whitespace, upper case."""
    return F.upper(strip(c))


def norm_lower(c: Column | str) -> Column:
    """E-mail style text: no surrounding whitespace, lower case."""
    return F.lower(strip(c))


def norm_default(c: Column | str, default: str) -> Column:
    """Like :func:`norm_upper`, with a default for NULL."""
    return norm_upper(F.coalesce(_col(c), F.lit(default)))


def digits_only(c: Column | str) -> Column:
    """Keep digits; NULL becomes the empty string."""
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[^0-9]", "")


def extract_first(c: Column | str, pattern: str, group: int = 0) -> Column:
    """First regex match; NULL (not '') when nothing matches."""
    hit = F.regexp_extract(_col(c), pattern, group)
    return F.when(_col(c).rlike(pattern), hit)
