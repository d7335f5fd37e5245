"""Numeric and symbolic expressions as spoken words, in a fixed order."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from sokhan import tables as T
from sokhan.functions import numbers as N
from sokhan.functions.text import B0, B1, S, chain, guarded, substitute

Z = T.ZWNJ
GUARD = f"[\\u0600-\\u06FFA-Za-z{Z}]"


def part(m: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(m, pattern, k)


def abbreviations(text: Column) -> Column:
    """Whole abbreviations only: no letter or joiner on either side."""
    rules = [(f"(?<!{GUARD}){re.escape(short)}(?!{GUARD})", f" {T.ABBREVIATIONS[short]} ") for short in sorted(T.ABBREVIATIONS, key=len, reverse=True)]
    return guarded(text, "|".join(map(re.escape, T.ABBREVIATIONS)), lambda t: chain(t, *rules))


def thousands(text: Column) -> Column:
    """Separators between groups of digits go."""
    return F.regexp_replace(text, f"(?<=[0-9])[,٬،](?=[0-9]{{3}}{B1})", "")


def signs(text: Column) -> Column:
    """A sign at a word's start, glued to digits, is read; the digits stay."""
    return chain(text, (f"(?:^|(?<={S}))-(?=[0-9])", T.NEGATIVE + " "), (f"(?:^|(?<={S}))\\+(?=[0-9])", T.POSITIVE + " "))


def time(text: Column) -> Column:
    clock = "([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?"
    lead = f"(?:ساعت{S}*)?"
    shape = f"^({lead}){clock}$"

    def say(m: Column) -> Column:
        h, mi, sec = (F.nullif(part(m, shape, k), F.lit("")).cast("int") for k in (2, 3, 4))
        out = F.concat(
            F.when(part(m, shape, 1) == "", F.lit("ساعت ")).otherwise(part(m, shape, 1)), N.cardinal(h),
            F.when(mi > 0, F.concat(F.lit(N.AND), N.cardinal(mi), F.lit(" دقیقه"))).otherwise(F.lit("")),
            F.when(sec > 0, F.concat(F.lit(N.AND), N.cardinal(sec), F.lit(" ثانیه"))).otherwise(F.lit("")),
        )
        return F.when((h > 23) | (mi > 59), m).otherwise(out)

    return substitute(text, f"{lead}{B0}{clock}{B1}", say)


def dates(text: Column) -> Column:
    """Year first, then day first; the Jalali calendar for years 1200 to 1500."""
    sep = "[/\\-.]"

    def rule(shape: str, y: int, m: int, d: int):
        def say(x: Column) -> Column:
            year, month, day = (part(x, shape, k).cast("int") for k in (y, m, d))
            safe = F.least(F.greatest(month, F.lit(1)), F.lit(12)) - 1
            name = F.when(year.between(1200, 1500), N.pick(T.JALALI, safe)).otherwise(N.pick(T.GREGORIAN, safe))
            spoken = F.concat_ws(" ", N.ordinal(day), name, N.year(year))
            return F.when(month.between(1, 12) & day.between(1, 31), spoken).otherwise(x)

        return say

    first, last = f"([0-9]{{4}}){sep}([0-9]{{1,2}}){sep}([0-9]{{1,2}})", f"([0-9]{{1,2}}){sep}([0-9]{{1,2}}){sep}([0-9]{{4}})"
    return substitute(substitute(text, f"{B0}{first}{B1}", rule(first, 1, 2, 3)), f"{B0}{last}{B1}", rule(last, 3, 2, 1))


def phone(text: Column) -> Column:
    """Phone numbers and runs of eleven digits or more, digit by digit."""
    return substitute(substitute(text, "(?<![0-9])0[0-9]{9,10}(?![0-9])", N.digits), "(?<![0-9])[0-9]{11,}(?![0-9])", N.digits)


def amount(number: Column) -> Column:
    """Digits with an optional fraction."""
    i, f = (F.regexp_extract(number, "^([0-9]+)(?:[.٫]([0-9]+))?", k) for k in (1, 2))
    return F.when(F.regexp_like(number, F.lit("[.٫]")), N.decimal(i, f)).otherwise(N.read(N.whole(i)))


def currency(text: Column) -> Column:
    """A symbol before an amount is said after it."""
    names = F.create_map(*(F.lit(x) for kv in T.CURRENCY.items() for x in kv))
    pattern = f"[{''.join(T.CURRENCY)}]{S}*[0-9]+(?:[,٬][0-9]{{3}})*(?:[٫.][0-9]+)?"

    def say(m: Column) -> Column:
        return F.concat_ws(" ", amount(F.regexp_replace(m, "[^0-9.٫]", "")), names[F.substring(m, 1, 1)])

    return substitute(text, pattern, say)


def percent(text: Column) -> Column:
    """The sign after a number, which may have a fraction, or before a whole one."""
    text = substitute(text, f"[0-9]+(?:[٫.][0-9]+)?{S}*[٪%]", lambda m: F.concat(amount(m), F.lit(" درصد")))
    return substitute(text, f"[٪%]{S}*[0-9]+", lambda m: F.concat(N.read(N.whole(F.regexp_extract(m, "[0-9]+", 0))), F.lit(" درصد")))


def units(text: Column) -> Column:
    names = F.create_map(*(F.lit(x) for k, v in T.UNITS.items() for x in (k, " " + v)))
    some = "|".join(re.escape(u) for u in sorted(T.UNITS, key=lambda u: len(re.escape(u)), reverse=True))
    # A unit that ends in a word character ends a word; the bare degree sign is followed by one.
    return substitute(text, f"(?<=[0-9{S[1:-1]}])(?:{some})(?:(?<=[\\p{{L}}\\p{{N}}_]){B1}|(?<![\\p{{L}}\\p{{N}}_])(?=[\\p{{L}}\\p{{N}}_]))", lambda m: names[m])


def fractions(text: Column) -> Column:
    shape = f"([0-9]+){S}*/{S}*([0-9]+)"

    def say(m: Column) -> Column:
        a, b = (N.whole(part(m, shape, k)) for k in (1, 2))
        # Both are at most 1000, so at most four digits.
        small = (F.length(a) <= 4) & (F.length(b) <= 4)
        x, y = (F.when(small, v).try_cast("int") for v in (a, b))
        return F.when(~small | (y == 0) | (y > 1000) | (x > 1000), m).otherwise(N.fraction(x, y))

    return substitute(text, f"{B0}{shape}{B1}", say)


def ordinals(text: Column) -> Column:
    def say(m: Column) -> Column:
        n = N.whole(F.regexp_extract(m, "^[0-9]+", 0))
        return F.when(F.contains(m, F.lit("مین")), N.read_ordinal(n, first_as_name=False)).otherwise(N.read_ordinal(n))

    return substitute(text, f"{B0}[0-9]+{S}*{Z}?(?:ام|مین){B1}", say)


def ranges(text: Column) -> Column:
    shape = f"([0-9]+){S}*[-–—]{S}*([0-9]+)"
    return substitute(text, shape, lambda m: F.concat(N.read(N.whole(part(m, shape, 1))), F.lit(" تا "), N.read(N.whole(part(m, shape, 2)))))


def decimals(text: Column, style: str = "momayez") -> Column:
    shape = "([0-9]+)[٫.]([0-9]+)"
    return substitute(text, shape, lambda m: N.decimal(part(m, shape, 1), part(m, shape, 2), style))


def integers(text: Column) -> Column:
    return substitute(text, "[0-9]+", lambda m: N.read(N.whole(m)))


#: The order matters: special shapes before those whose digits they share.
ORDER = {
    "abbreviations": abbreviations, "thousands": thousands, "signs": signs, "time": time, "dates": dates, "phone": phone, "currency_symbol": currency,
    "percent": percent, "units": units, "fractions": fractions, "ordinals": ordinals, "ranges": ranges, "decimals": decimals, "integers": integers,
}


#: Steps that change nothing in a text without digits.
DIGITS_ONLY = set(ORDER) - {"abbreviations", "units"}


def steps(decimal_style: str = "momayez", skip: frozenset[str] = frozenset()) -> Iterator[Callable[[Column], Column]]:
    """The expanders to apply, in order; those in a row that need digits share one search for them."""
    kept = [n for n in ORDER if n not in skip]
    for digits, names in groupby(kept, DIGITS_ONLY.__contains__):
        fns = [partial(ORDER[n], style=decimal_style) if n == "decimals" else ORDER[n] for n in names]
        if digits:
            yield lambda text, fns=fns: guarded(text, "[0-9]", lambda t: reduce(lambda x, fn: fn(x), fns, t))
        else:
            yield from fns


def expand(text: Column, decimal_style: str = "momayez", skip: frozenset[str] = frozenset()) -> Column:
    for fn in steps(decimal_style, skip):
        text = fn(text)
    return text
