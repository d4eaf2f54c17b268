"""Text expressions that behave like Python's ``str.strip`` and ``str.title``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txmart.settings import NA_TOKENS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- Fixed values: the characters Python's ``str.strip`` removes ---
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# --- end of fixed values ---


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace: every Unicode blank Python strips, not only ASCII."""
    return F.trim(_col(c), F.lit(BLANKS))


def title_case(c) -> Column:
    """Python ``str.title``: each run of cased characters gets an upper first one, the rest
    lower. ``o'brien`` -> ``O'Brien``, ``3rd`` -> ``3Rd``, ``\u00dfa`` -> ``Ssa``.

    A first character whose upper case is several characters keeps only the first of them in upper case.

    Texts of ASCII alone whose words begin after a blank take the built-in ``initcap``, which is far
    cheaper and begins words there only.
    """
    return F.when(_col(c).rlike(r"[^A-Za-z ][A-Za-z]|[^\x00-\x7f]"), _title_runs(c)).otherwise(F.initcap(_col(c)))


def _title_runs(c) -> Column:
    """:func:`title_case` of any text, cut into alternating cased / uncased runs."""
    cased = r"[\p{IsUppercase}\p{IsLowercase}\p{Lt}]"
    runs = F.regexp_extract_all(_col(c), F.lit(rf"({cased}+|[^\p{{IsUppercase}}\p{{IsLowercase}}\p{{Lt}}]+)"), 1)

    def titled(r):
        first = F.upper(F.substring(r, 1, 1))
        return F.concat(F.substring(first, 1, 1), F.lower(F.substring(first, 2, 8)), F.lower(F.substring(r, 2, 1 << 30)))

    return F.array_join(F.transform(runs, titled), "")


def null_if_na(c, tokens=NA_TOKENS) -> Column:
    """Null for the strings a pandas CSV reader treats as missing."""
    col = _col(c)
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)
