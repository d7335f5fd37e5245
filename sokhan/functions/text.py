"""Text columns: characters, punctuation, spacing. Built-in expressions only.

``\\b`` and ``\\s`` mean other things to Java than the rules need, so word edges
are spelled out by lookarounds and blanks by ``tables.BLANK``.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sokhan import tables as T

Z = T.ZWNJ
WORDS_EDGE_BEFORE, WORDS_EDGE_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
#: Edges of a match that begins or ends with a word character.
B0, B1 = WORDS_EDGE_BEFORE, WORDS_EDGE_AFTER
S = f"[{T.BLANK}]"
FIRST_PRIVATE, LAST_PRIVATE = 0xE000, 0xF8FF
PRIVATE = "\\uE000-\\uF8FF"
WORD = f"[\\u0600-\\u06FF{Z}]+"


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value), with value evaluated once however often fn uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def chain(text: Column, *rules: tuple[str, str]) -> Column:
    """Pattern replacements one after the other."""
    for pattern, to in rules:
        text = F.regexp_replace(text, pattern, to)
    return text


def quoted(chars: str) -> str:
    """A character class's inside."""
    return "".join(re.escape(c) if c in r"\\]^-[&" else c for c in chars)


def ranges(chars: str) -> str:
    """A character class's inside as few ranges: Java tests a class's members one by one."""
    out, codes = "", sorted(set(map(ord, chars)))
    for code in codes:
        if code - 1 not in codes:
            first = code
        if code + 1 not in codes:
            out += f"\\u{first:04X}-\\u{code:04X}" if code > first else f"\\u{code:04X}"
    return out


def substitute(text: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Each match of pattern replaced by fn(match); the pattern sees the whole text, lookarounds included."""

    def run(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), fn)
        joined = F.zip_with(F.split(t, pattern, -1), found, lambda p, f: F.concat(p, F.coalesce(f, F.lit(""))))
        return F.when(F.regexp_like(t, F.lit(pattern)), F.array_join(joined, "")).otherwise(t)

    return let(text, run)


def guarded(text: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """fn(text) where the pattern occurs; a text without it is left as it is, for the price of one search."""
    return let(text, lambda t: F.when(F.regexp_like(t, F.lit(pattern)), fn(t)).otherwise(t))


def holding(text: Column, parts: list[str], fn: Callable[[Column], Column]) -> Column:
    """fn(text) where one of the parts occurs, without which fn changes nothing; looking for plain text is much cheaper than for a pattern."""
    return let(text, lambda t: F.when(reduce(or_, (F.contains(t, F.lit(p)) for p in parts)), fn(t)).otherwise(t))


def strip(text: Column) -> Column:
    """Without blanks at either end."""
    return F.regexp_replace(text, f"^{S}+|{S}+$", "")


@F.arrow_udf(StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


#: Canonical composition, which Spark has no function for. It always gives the same
#: result, but the optimizer would move a deterministic one into a lambda function,
#: where Python can't be called, and evaluate it once for each use.
nfc = _nfc.asNondeterministic()
#: Characters that neither change under composition nor join with one before: Latin letters
#: and signs, Arabic letters and digits, general punctuation.
COMPOSED = "\\u0000-\\u02FF\\u060C\\u061B\\u061F\\u0621-\\u064A\\u0660-\\u066F\\u0671-\\u06D5\\u06EE-\\u06FF\\u2002-\\u205F\\u20A0-\\u20BF\\u25A0-\\u25FF\\uE000-\\uF8FF\\uFDFC"


def composed(text: Column) -> Column:
    """Canonical composition; only texts that it could change are sent to Python. text is a plain column."""
    # The lookahead passes over the commonest characters before the whole class is tried.
    return F.coalesce(nfc(F.when(F.regexp_like(text, F.lit(f"(?![\\u0000-\\u02FF\\u0621-\\u064A])[^{COMPOSED}]")), text)), text)


def is_composed(text: Column) -> Column:
    """Whether composition changes nothing. text is a plain column."""
    return composed(text) == text


def presentation_forms(text: Column) -> Column:
    """Arabic presentation forms back to their letters; the map is derived, not listed."""
    single, several = {}, {}
    for code in range(0xFB50, 0xFF00):
        c = chr(code)
        k = unicodedata.normalize("NFKC", c)
        if k != c:
            (single if len(k) == 1 else several)[c] = k
    names = F.create_map(*(F.lit(x) for kv in several.items() for x in kv))

    def run(t: Column) -> Column:
        plain = F.translate(t, "".join(single), "".join(single.values()))
        return F.when(F.regexp_like(t, F.lit("[\\uFB50-\\uFEFF]")), substitute(plain, "[" + ranges("".join(several)) + "]", lambda c: names[c])).otherwise(t)

    return let(text, run)


def remove_invisibles(text: Column) -> Column:
    """Direction marks and the like go, odd blanks become blanks; the joiner between morphemes stays."""
    return F.translate(text, T.SPACES + T.REMOVED, " " * len(T.SPACES))


def fold(text: Column) -> Column:
    """Arabic letters and digits to Persian and ASCII, ligatures to words."""
    text = F.translate(text, "".join(T.FOLDED), "".join(T.FOLDED.values()))
    for c, words in T.PHRASES.items():
        text = F.replace(text, F.lit(c), F.lit(words))
    return text


def drop_foreign_marks(text: Column) -> Column:
    return F.translate(text, T.DROPPED_MARKS, "")


def strip_marks(text: Column) -> Column:
    """Bare spelling."""
    return F.translate(text, T.MARKS, "")


def has_marks(text: Column) -> Column:
    return F.regexp_like(text, F.lit(f"[{ranges(T.MARKS)}]"))


def count_marks(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{T.MARKS}]"))


def words(text: Column) -> Column:
    """Words as the statistics count them: runs of the Arabic block and joiners."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_density(text: Column) -> Column:
    """Share of words with a mark; 0 without words."""
    return let(words(text), lambda w: F.when(F.size(w) == 0, 0.0).otherwise(F.size(F.filter(w, has_marks)) / F.size(w)))


def ends_with_ezafe(word: Column) -> Column:
    return F.endswith(word, F.lit(T.KASRA))


def mark_order_signature(text: Column) -> Column:
    """Combining classes of the marks, letters between them as a bar."""
    classes = {c: str(unicodedata.combining(c)) for c in T.MARKS + T.DROPPED_MARKS}
    runs = F.regexp_replace(text, f"^[^{''.join(classes)}]+", "")
    runs = F.regexp_replace(runs, f"[^{''.join(classes)}]+", "|")
    return substitute(runs, "[" + "".join(classes) + "]", lambda c: F.create_map(*(F.lit(x) for kv in classes.items() for x in kv))[c])


def punctuation(text: Column, brackets_to_commas: bool = True) -> Column:
    """Quotes in pairs, Persian marks, runs collapsed, brackets as commas."""
    text = holding(text, ['"'], lambda t: F.regexp_replace(t, '"([^"\\n]{1,300})"', "«$1»"))
    text = F.translate(text, "".join(T.PUNCTUATION) + T.BULLETS, "".join(T.PUNCTUATION.values()))
    text = holding(text, ["...", "……"], lambda t: chain(t, (r"\.{3,}", "…"), ("…{2,}", "…")))
    text = holding(text, ["!!", "؟؟"], lambda t: F.regexp_replace(t, "([!؟])\\1+", "$1"))
    if brackets_to_commas:
        text = holding(text, list("([{)]}"), lambda t: chain(t, (rf"{S}*[(\[{{]{S}*", "، "), (rf"{S}*[)\]}}]{S}*", "، ")))
    return holding(text, ["«", "»"], lambda t: chain(t, (f"{S}*«{S}*", " «"), (f"{S}*»{S}*", "» ")))


def fix_spacing(text: Column) -> Column:
    """One blank between words, none beside joiners, closing marks close up and are followed by one."""
    closing = "".join(c for c in T.KEPT_PUNCTUATION if c not in "«-'")
    fa = "[\\u0600-\\u06FF]"
    # From the first rule on every blank is a single space, and no later rule brings two together.
    text = holding(F.translate(text, T.BLANKS, " " * len(T.BLANKS)), ["  "], lambda t: F.regexp_replace(t, " {2,}", " "))

    def joiners(t: Column) -> Column:
        t = F.replace(F.replace(t, F.lit(f" {Z}"), F.lit(Z)), F.lit(f"{Z} "), F.lit(Z))
        return chain(t, (f"{Z}{{2,}}", Z), (f"{Z}(?!{fa})", ""), (f"{Z}(?<!{fa}{Z})", ""))

    text = holding(text, [Z], joiners)
    return F.trim(chain(text, (f" ([{quoted(closing)}])", "$1"), (f"[.!:،؛؟](?=[^{T.BLANK}])", "$0 ")))


def cleanup(text: Column) -> Column:
    """What expansion leaves behind: free dashes become pauses, of two marks in a row the stronger or last stays."""
    end, pause, dash = ".!؟…", "،؛", "[-–—]"
    text = holding(text, list("-–—"), lambda t: chain(t, (f"{S}*{dash}{S}+", "، "), (f"{S}+{dash}{S}*", "، ")))
    pauses = (f"([{pause}])[{T.BLANK}{pause}]*([{pause}])", "$2"), (f"[{pause}]{S}*(?=[{end}])", ""), (f"([{end}]){S}*[{pause}]", "$1")
    text = holding(text, list(pause), lambda t: chain(t, *pauses))
    return F.ltrim(F.regexp_replace(text, f"[{end}][{T.BLANK}{end}]*([{end}])", "$1"), F.lit(pause + end + T.BLANKS))


def repair_joiners(text: Column) -> Column:
    """Verb prefixes and suffixes written apart are joined, but a suffix doesn't take a suffix."""
    fa, longest = "[\\u0600-\\u06FF]", "|".join(T.SUFFIXES)
    text = holding(text, ["می "], lambda t: F.regexp_replace(t, f"{B0}(ن?می) ({fa}{{2,}})", f"$1{Z}$2"))

    def join(m: Column) -> Column:
        # The match holds the joiner before its stem, if there is one.
        return F.when(F.regexp_like(m, F.lit(f"^{Z}(?:{longest}) ")), m).otherwise(F.regexp_replace(m, " ", Z))

    return holding(text, sorted({f" {s[:2]}" for s in T.SUFFIXES}), lambda t: substitute(t, f"{Z}?{fa}{{2,}}+ (?:{longest}){B1}", join))


def separate_scripts(text: Column) -> Column:
    """A blank where Latin letters or digits touch Persian letters."""
    return guarded(text, "[A-Za-z0-9]", lambda t: guarded(t, f"[{ranges(T.LETTERS_FA)}]", _separated))


def _separated(text: Column) -> Column:
    return F.regexp_replace(text, f"(?<=[A-Za-z0-9])(?=[{ranges(T.LETTERS_FA)}])|(?<=[{ranges(T.LETTERS_FA)}])(?=[A-Za-z0-9])", " ")


def foreign_class(keep_marks: bool = True) -> str:
    """Pattern of a character outside the inventory; digits and escapes' placeholders are let through."""
    return f"[^{PRIVATE}0-9{ranges(inventory(keep_marks))}]"


def inventory(keep_marks: bool = True) -> str:
    """The characters of normalized texts."""
    return T.LETTERS_FA + T.KEPT_PUNCTUATION + " " + Z + (T.MARKS if keep_marks else "")


def unexpected(text: Column, keep_marks: bool = True) -> Column:
    """The distinct characters outside the inventory, sorted."""
    # Without the inventory little is left to search.
    rest = F.translate(text, inventory(keep_marks) + "0123456789", "")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(rest, F.lit(foreign_class(keep_marks)), F.lit(0))))


def problems(text: Column) -> Column:
    """Misplaced marks by code and place: mark_at_start, double_mark, mark_on_nonletter, mark_after_zwnj, not_nfc."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    harakat = [F.lit(c) for c in T.MARKS]

    def judge(c: Column, i: Column, before: Column) -> Column:
        at = F.concat(F.lit("@"), i.cast("string"))
        shadda = (before == T.SHADDA) | (c == T.SHADDA)
        first = (
            F.when(i == 0, F.lit("mark_at_start"))
            .when(before.isin(*harakat), F.when(~shadda, F.concat(F.lit("double_mark"), at)))
            .when(~F.regexp_like(before, F.lit("[\\u0600-\\u06FF]")), F.concat(F.lit("mark_on_nonletter"), at))
        )
        second = F.when(before == Z, F.concat(F.lit("mark_after_zwnj"), at))
        return F.when(c.isin(*harakat), F.array_compact(F.array(first, second))).otherwise(F.array().cast("array<string>"))

    marks = let(chars, lambda cs: F.flatten(F.transform(cs, lambda c, i: judge(c, i, F.when(i > 0, F.get(cs, i - 1)).otherwise(F.lit(""))))))
    return F.concat(F.when(has_marks(text), marks).otherwise(F.array().cast("array<string>")), F.when(composed(text) != text, F.array(F.lit("not_nfc"))).otherwise(F.array().cast("array<string>")))
