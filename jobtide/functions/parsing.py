"""Safe parsing of dirty text columns. Every function maps Column -> Column and stays
inside whole-stage code generation; none depends on the session's ANSI flag or time zone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and limits that decide how a text is read.
BOOLEAN_TRUE = ("true", "t", "yes", "y", "on", "1")
BOOLEAN_FALSE = ("false", "f", "no", "n", "off", "0")
FRENCH_TRUE = ("vrai", "oui")
FRENCH_FALSE = ("faux", "non")
LISTED_TRUE = ("true", "1", "yes", "vrai", "oui")
LISTED_FALSE = ("false", "0", "no", "faux", "non")
MILLISECONDS_ABOVE = 100000000000

_EPOCH = "1970-01-01 00:00:00"
_NUMBER = "decimal(38,0)"
_MILLIS = "decimal(15,0)"  # what a timestamp surely holds; narrowing to it is the range check


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Strip outer spaces (only spaces); blank becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def lower_label(c: Column | str) -> Column:
    """``clean_text`` folded to lower case."""
    return F.nullif(F.lower(F.trim(_col(c))), F.lit(""))


def upper_label(c: Column | str) -> Column:
    """``clean_text`` folded to upper case."""
    return F.nullif(F.upper(F.trim(_col(c))), F.lit(""))


def safe_number(c: Column | str) -> Column:
    """Text to an exact whole number, fractions rounded half away from zero, bad text NULL.

    A number starts with a blank, sign, point or digit, all of which sort before ``:``. Words
    and blanks are turned away by that one comparison, because a cast that fails costs about
    ten times one that succeeds and dirty columns hold many of them.
    """
    text = _col(c).cast("string")
    return F.when((text < ":") & (text != ""), text.try_cast(_NUMBER))


def clean_number(c: Column | str) -> Column:
    """``safe_number`` of the trimmed text."""
    return safe_number(clean_text(c))


def safe_id(c: Column | str) -> Column:
    """Text to BIGINT; bad or out-of-range text is NULL. The cheap form of a join key."""
    return safe_number(c).try_cast("bigint")


def _fail_on(problem: str, c: Column) -> Column:
    """NULL for NULL; any value stops the job with a message that shows it."""
    return F.when(
        c.isNotNull(), F.raise_error(F.concat(F.lit(f"{problem}: "), c.cast("string")))
    )


def strict_id(c: Column | str, on_bad: str = "fail") -> Column:
    """Text to BIGINT where bad text stops the job (``"fail"``) or becomes NULL (``"null"``)."""
    number = safe_id(c)
    if on_bad == "null":
        return number
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    return F.coalesce(number, _fail_on("not an id", _col(c)).cast("bigint"))


def word_map(meanings: Mapping[str, object]) -> Column:
    """A constant map Column; one literal instead of one comparison per word."""
    return F.expr(f"map({', '.join(f'{_sql(w)}, {_sql(m)}' for w, m in meanings.items())})")


def _sql(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _meaning(true: Sequence[str], false: Sequence[str], word: Column) -> Column:
    return F.try_element_at(
        word_map({**dict.fromkeys(true, True), **dict.fromkeys(false, False)}), word
    )


def safe_boolean(c: Column | str) -> Column:
    """Boolean words only, any case, untrimmed; anything else NULL."""
    return _meaning(BOOLEAN_TRUE, BOOLEAN_FALSE, F.lower(_col(c)))


def robust_boolean(c: Column | str) -> Column:
    """Boolean words, French words, or a number that rounds to 1 or 0; anything else NULL."""
    word = F.lower(_col(c).cast("string"))
    number = safe_number(c)
    return F.coalesce(
        _meaning(BOOLEAN_TRUE + FRENCH_TRUE, BOOLEAN_FALSE + FRENCH_FALSE, word),
        F.when(number.isin(0, 1), number == 1),
    )


def list_boolean(c: Column | str) -> Column:
    """Trimmed word list only, without the number rule; anything else NULL."""
    return _meaning(LISTED_TRUE, LISTED_FALSE, F.lower(F.trim(_col(c))))


def epoch_to_ts(c: Column | str, on_bad: str = "fail") -> Column:
    """Epoch text to TIMESTAMP_NTZ: above ``MILLISECONDS_ABOVE`` milliseconds, else seconds.

    Text that is no number is NULL. A number no timestamp can hold fails the job, or is NULL
    with ``on_bad="null"``.
    """
    number = safe_number(c)
    n = number.try_cast(_MILLIS).cast("bigint")
    if on_bad != "null":
        n = F.coalesce(n, _fail_on("not an epoch", number).cast("bigint"))
    millis = F.when(n > MILLISECONDS_ABOVE, n).otherwise(n * 1000)
    if on_bad == "null":
        millis = millis.try_cast(_MILLIS).cast("bigint")
    return F.timestamp_add("MILLISECOND", millis, F.lit(_EPOCH).cast("timestamp_ntz"))


def recency(c: Column | str) -> Column:
    """Sort key for "latest": epoch text first, then a written timestamp, else NULL.

    Never fails: a value no timestamp can hold sorts as undated.
    """
    return F.coalesce(epoch_to_ts(c, on_bad="null"), _col(c).try_cast("timestamp_ntz"))
