"""Latin words in Persian text: lexicon, letter names, acronyms, escapes or transliteration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan import tables as T
from sokhan.functions.text import let

TOKEN = "[A-Za-z][A-Za-z0-9'.-]*"
STRATEGIES = ("escalate", "lexicon", "transliterate")


def tokens(text: Column) -> Column:
    """Latin tokens in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def key_of(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), "^[.'-]+|[.'-]+$", "")


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def spell(token: Column) -> Column:
    """Names of a token's letters, joined."""
    letters = F.filter(F.split(F.lower(token), ""), lambda c: F.regexp_like(c, F.lit("[a-z]")))
    return F.array_join(F.transform(letters, lambda c: lookup(T.LETTER_NAMES, c)), T.ZWNJ)


def transliterate(token: Column) -> Column:
    """Letter groups in order, then single letters; what is left of other characters goes."""
    t = F.lower(token)
    for group, to in T.LETTER_GROUPS.items():
        t = F.replace(t, F.lit(group), F.lit(to))
    t = F.replace(t, F.lit("x"), F.lit(T.LETTERS["x"]))
    single = {k: v for k, v in T.LETTERS.items() if len(v) == 1}
    t = F.translate(t, "".join(single), "".join(single.values()))
    t = F.regexp_replace(t, "[^\\u0600-\\u06FF]", "")
    return let(t, lambda s: F.coalesce(F.nullif(F.regexp_replace(s, "^ا", "آ"), F.lit("")), token))


def is_acronym(token: Column) -> Column:
    return F.regexp_like(token, F.lit("^[A-Z]{2,6}$"))


def readings(text: Column, lexicon: dict[str, str] | None = None) -> Column:
    """Each Latin token in order as (token, key, said); said is null where the lexicon doesn't know it."""
    table = T.LATIN_WORDS | {k.lower(): v for k, v in (lexicon or {}).items()}

    def one(token: Column) -> Column:
        # The membership test is a hash lookup, the map's a scan.
        said = lambda k: F.when(k.isin(*table), lookup(table, k)).when(F.length(k) == 1, lookup(T.LETTER_NAMES, k))
        return let(key_of(token), lambda k: F.struct(token.alias("token"), k.alias("key"), said(k).alias("said")))

    return F.transform(tokens(text), one)


def resolved(text: Column, found: Column, strategy: str = "escalate") -> Column:
    """The text with its tokens, found by readings(), as the strategy says; the lexicon strategy spells acronyms too, like escalate."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")

    def one(piece: Column, x: Column) -> Column:
        last = transliterate(x["key"]) if strategy == "transliterate" else F.concat(F.lit("{"), x["key"], F.lit("}"))
        word = F.coalesce(x["said"], F.when(is_acronym(x["token"]), spell(x["token"])).otherwise(last))
        return F.concat(piece, F.when(x.isNull(), F.lit("")).otherwise(word))

    return F.when(F.size(found) > 0, F.array_join(F.zip_with(F.split(text, TOKEN, -1), found, one), "")).otherwise(text)


def unresolved(found: Column) -> Column:
    """Tokens of readings() that the lexicon doesn't know: acronyms as they stand, others by key."""
    missing = F.filter(found, lambda x: x["said"].isNull())
    return F.transform(missing, lambda x: F.when(is_acronym(x["token"]), x["token"]).otherwise(x["key"]))


def resolve(text: Column, strategy: str = "escalate", lexicon: dict[str, str] | None = None) -> Column:
    """Each Latin token as the strategy says."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    return let(text, lambda t: let(readings(t, lexicon), lambda found: resolved(t, found, strategy)))


def unknown(text: Column, lexicon: dict[str, str] | None = None) -> Column:
    """Unresolved tokens: acronyms as they stand, others by key."""
    return let(readings(text, lexicon), unresolved)


def work_queue(df: DataFrame, text_col: str = "text", top: int = 200, lexicon: dict[str, str] | None = None) -> DataFrame:
    """The most frequent unresolved tokens; ties by token."""
    each = df.select(F.explode(unknown(F.col(text_col), lexicon)).alias("token"))
    return each.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(top)
