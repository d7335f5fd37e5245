"""Numbers as Persian words: integer and text columns to strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sokhan import tables as T
from sokhan.functions.text import let

AND = " و "


#: 0 (nothing said) to 99, by rule.
BELOW_HUNDRED = ["", *T.DIGITS[1:], *T.TEENS, *(AND.join(filter(None, (T.TENS[n // 10], T.DIGITS[n % 10] if n % 10 else ""))) for n in range(20, 100))]


def pick(names: list[str], at: Column) -> Column:
    """A name by its number from 0; null for an empty name. The list is folded to one literal."""
    return F.nullif(F.get(F.split(F.lit("|".join(names)), "[|]"), at.cast("int")), F.lit(""))


def below_thousand(n: Column) -> Column:
    """Words of 1 to 999."""
    return F.concat_ws(AND, pick(T.HUNDREDS, F.floor(n / 100)), pick(BELOW_HUNDRED, n % 100))


def cardinal(n: Column) -> Column:
    """A whole number: BIGINT, or DECIMAL(38,0) up to 10^24; beyond that digit by digit."""
    return read(n.cast("decimal(38,0)").cast("string"))


def read(number: Column) -> Column:
    """As cardinal, of a number in digits of any length, without zeros before it."""
    width = 3 * len(T.SCALES)

    def spelled(s: Column) -> Column:
        padded = F.lpad(s, width, "0")

        def group(i: Column) -> Column:
            def named(g: Column) -> Column:
                said = F.when((i == 1) & (g == 1), F.lit(T.SCALES[1])).otherwise(F.concat_ws(" ", below_thousand(g), pick(T.SCALES, i)))
                return F.when(g > 0, said)

            return let(F.substring(padded, width - 3 * i - 2, F.lit(3)).cast("int"), named)

        groups = F.sequence(F.floor((F.length(s) - 1) / 3).cast("int"), F.lit(0), F.lit(-1))
        return F.when(F.length(s) > width, digits(s)).otherwise(F.array_join(F.transform(groups, group), AND))

    def signed(s: Column) -> Column:
        bare = let(F.regexp_replace(s, "^-", ""), spelled)
        return F.when(s == "0", F.lit(T.ZERO)).otherwise(F.concat(F.when(F.startswith(s, F.lit("-")), F.lit(T.NEGATIVE + " ")).otherwise(F.lit("")), bare))

    return let(number, signed)


def ordinal(n: Column, first_as_name: bool = True) -> Column:
    """The ordinal of a whole number; 1 alone has a name of its own if wanted."""
    return read_ordinal(n.cast("decimal(38,0)").cast("string"), first_as_name)


def read_ordinal(number: Column, first_as_name: bool = True) -> Column:
    """As ordinal, of a number in digits."""

    def ended(w: Column) -> Column:
        cut = F.substring(w, F.lit(1), F.length(w) - 2)
        return (
            F.when(F.endswith(w, F.lit("سه")), F.concat(cut, F.lit("سوم")))
            .when(F.endswith(w, F.lit("یک")), F.concat(cut, F.lit("یکم")))
            .when(F.endswith(w, F.lit("ی")), F.concat(w, F.lit(T.ZWNJ + "ام")))
            .otherwise(F.concat(w, F.lit("م")))
        )

    out = let(read(number), ended)
    return F.when(number == "1", F.lit("اول")).otherwise(out) if first_as_name else out


def digits(s: Column) -> Column:
    """Digit by digit; what is no digit is left out."""
    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit("[0-9]"), F.lit(0)), lambda d: pick(T.DIGITS, d.cast("int"))), " ")


def whole(s: Column) -> Column:
    """A run of digits without zeros before it, as text, so that it may be of any length; null if there is none."""
    return F.when(s != "", F.regexp_replace(s, "^0+(?=[0-9])", ""))


def decimal(integer: Column, fraction: Column, style: str = "momayez") -> Column:
    """Integer and fraction digits: after the point digit by digit, or as a share with a place's name."""
    first = F.coalesce(read(whole(integer)), F.lit(T.ZERO))
    kept = F.coalesce(F.nullif(F.regexp_replace(fraction, "0+$", ""), F.lit("")), F.lit("0"))
    spoken = F.concat(first, F.lit(f" {T.POINT} "), digits(kept))
    if style != "fractional":
        return spoken
    place = pick(T.PLACES, F.least(F.length(kept), F.lit(len(T.PLACES) - 1)))
    return F.when(F.length(kept) < len(T.PLACES), F.concat(first, F.lit(AND), read(whole(kept)), F.lit(" "), place)).otherwise(spoken)


def fraction(numerator: Column, denominator: Column) -> Column:
    return F.when((numerator == 1) & (denominator == 2), F.lit("نیم")).otherwise(F.concat(cardinal(numerator), F.lit(" "), ordinal(denominator, first_as_name=False)))


def year(n: Column) -> Column:
    """Years are read as plain numbers."""
    return cardinal(n)
