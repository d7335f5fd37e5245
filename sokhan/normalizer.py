"""The normalizer: all rules in their order, as one struct column of a text column."""

from __future__ import annotations

import hashlib
import inspect
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan import tables
from sokhan.functions import expand, latin, marks, numbers, text
from sokhan.functions.text import FIRST_PRIVATE, LAST_PRIVATE, let, substitute

ESCAPE = r"\{[^{}]{1,64}\}"


@dataclass(frozen=True)
class Config:
    """What can be switched. ``compat`` keeps the old way of dropping marks, one blank for each."""

    keep_harakat: bool = True
    drop_foreign_marks: bool = True
    brackets_to_commas: bool = True
    repair_joiners: bool = True
    expand_numerics: bool = True
    decimal_style: str = "momayez"
    skip_expansions: frozenset[str] = frozenset()
    latin_strategy: str = "escalate"
    strip_unknown: bool = True
    compat: bool = False

    @property
    def version(self) -> str:
        """Changes with any rule and any setting; recorded with each output row."""
        h = hashlib.sha256()
        for module in (tables, text, numbers, expand, latin, marks):
            h.update(inspect.getsource(module).encode())
        h.update(inspect.getsource(inspect.getmodule(type(self))).encode())
        h.update(json.dumps({k: sorted(v) if isinstance(v, frozenset) else v for k, v in asdict(self).items()}, sort_keys=True).encode())
        return "sokhan-" + h.hexdigest()[:12]


def protect(t: Column, held: Column) -> Column:
    """struct(text, held): escapes become private-use characters, numbered on from those held."""
    found = F.regexp_extract_all(t, F.lit(ESCAPE), F.lit(0))

    def run(f: Column) -> Column:
        room = LAST_PRIVATE - FIRST_PRIVATE + 1
        mark = F.transform(f, lambda x, i: F.when(i + F.size(held) < room, private(i + F.size(held))).otherwise(x))
        pieces = F.zip_with(F.split(t, ESCAPE, -1), mark, lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
        return F.struct(F.array_join(pieces, "").alias("text"), F.slice(F.concat(held, f), 1, room).alias("held"))

    return let(found, run)


def private(i: Column) -> Column:
    """The private-use character of a number; the list is folded to one literal."""
    return F.get(F.split(F.lit("".join(map(chr, range(FIRST_PRIVATE, LAST_PRIVATE + 1)))), ""), i)


def restore(t: Column, held: Column) -> Column:
    """Escapes in place of their characters; others of these characters go."""
    return substitute(t, f"[{text.PRIVATE}]", lambda c: F.coalesce(F.get(held, F.ascii(c) - FIRST_PRIVATE), F.lit("")))


def normalized(df: DataFrame, text_col: str = "text", config: Config = Config(), lexicon: dict[str, str] | None = None, out: str = "norm") -> DataFrame:
    """df with a struct: text, raw, changed, unexpected, diacritic_density, n_words, problems, latin_unknown.

    Steps are columns of their own, so that none is evaluated twice; they are
    dropped at the end, and named as no column of df is. Null texts give an empty text, flagged.
    """
    own = "_"
    while any(c.startswith(own) for c in df.columns):
        own += "_"
    c, names = F.col(text_col), {k: own + k for k in ("text", "held", "pair", "found", "odd", "clean", "problems", "density", "words")}
    t, held = F.col(names["text"]), F.col(names["held"])

    def put(**columns: Column) -> None:
        nonlocal df
        df = df.withColumns({names[k]: v for k, v in columns.items()})

    def get(k: str) -> Column:
        return F.col(names[k])

    def step(fn, *args) -> None:
        put(text=fn(t, *args))

    put(pair=protect(F.coalesce(c.cast("string"), F.lit("")), F.array().cast("array<string>")))
    put(text=get("pair")["text"], held=get("pair")["held"])
    step(text.presentation_forms)
    step(text.composed)
    step(lambda x: text.fold(text.remove_invisibles(x)))
    if config.drop_foreign_marks:
        step(text.drop_foreign_marks)
    if not config.keep_harakat and not config.compat:
        step(text.strip_marks)
    step(text.punctuation, config.brackets_to_commas)
    step(text.separate_scripts)
    if config.expand_numerics:
        for fn in expand.steps(config.decimal_style, config.skip_expansions):
            step(fn)
        step(text.separate_scripts)
    put(found=latin.readings(t, lexicon))
    step(latin.resolved, get("found"), config.latin_strategy)
    put(pair=protect(t, held))
    put(text=get("pair")["text"], held=get("pair")["held"])
    step(text.cleanup)
    if config.repair_joiners:
        step(text.repair_joiners)
    step(text.fix_spacing)
    step(text.composed)
    put(odd=text.unexpected(t, config.keep_harakat))
    if config.strip_unknown:
        # Only texts with a foreign character are tidied a second time.
        put(clean=F.when(F.size(get("odd")) > 0, F.call_function("translate", t, F.array_join(get("odd"), ""), F.repeat(F.lit(" "), F.size(get("odd"))))))
        put(text=F.coalesce(text.fix_spacing(text.cleanup(get("clean"))), t))
    step(restore, held)
    none = F.array().cast("array<string>")
    put(problems=text.problems(t) if config.keep_harakat else none, density=text.word_density(t), words=F.size(text.words(t)))
    result = F.struct(
        t.alias("text"), c.cast("string").alias("raw"), F.coalesce(t != c.cast("string"), F.lit(False)).alias("changed"),
        F.when(c.isNull(), F.array(F.lit("non_str_input"))).otherwise(get("odd")).alias("unexpected"),
        get("density").alias("diacritic_density"), get("words").alias("n_words"), get("problems").alias("problems"), latin.unresolved(get("found")).alias("latin_unknown"),
    )
    return df.withColumn(out, result).drop(*names.values())


def ok(norm: Column) -> Column:
    """Whether nothing was unexpected and no mark misplaced."""
    return (F.size(norm["unexpected"]) == 0) & (F.size(norm["problems"]) == 0)


def not_idempotent(df: DataFrame, text_col: str = "text", config: Config = Config()) -> DataFrame:
    """Rows whose normalized text changes when normalized again, with both results (norm, again)."""
    once = normalized(df, text_col, config)
    return normalized(once, "norm.text", config, out="again").filter(F.col("again.text") != F.col("norm.text"))


def selftest(df: DataFrame, text_col: str = "text", config: Config = Config()) -> DataFrame:
    """One row of counts: texts, empty, not idempotent, with unexpected characters, with problems."""
    once = normalized(df, text_col, config, out="first").select(F.struct("first.text", "first.unexpected", "first.problems").alias("first"))
    twice, said = normalized(once, "first.text", config), F.col("first.text")
    empty = text.strip(said) == ""
    return twice.agg(
        F.count("*").alias("n"), F.count_if(empty).alias("empty"), F.count_if(~empty & (F.col("norm.text") != said)).alias("idempotent"),
        F.count_if(~empty & (F.size("first.unexpected") > 0)).alias("unexpected"), F.count_if(~empty & (F.size("first.problems") > 0)).alias("problems"),
    )
