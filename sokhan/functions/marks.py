"""Diacritic masking. Randomness is a hash of seed, row and word, so it doesn't depend on the order of rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan import tables as T
from sokhan.functions.text import WORD, count_marks, ends_with_ezafe, has_marks, let, problems, strip_marks, word_density


def homographs(path: str) -> dict[str, list[str]]:
    """Marked forms by bare word, from a JSON lexicon with a key ``homographs``; the words are a ``priority`` of mask."""
    with open(path, encoding="utf-8") as f:
        return {word: [x["form"] for x in forms] for word, forms in json.load(f)["homographs"].items()}


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mask(text: Column, keep_rate: Column, row: Column, seed: int = 1234, priority: list[str] | None = None, boost: float = 0.45, keep_ezafe: bool = True) -> Column:
    """Marks stay on a share of the marked words; a final ezafe stays if wanted; priority words stay likelier."""

    def one(w: Column, i: Column) -> Column:
        bare = strip_marks(w)
        rate = F.when(bare.isin(*priority), F.least(F.lit(1.0), keep_rate + boost)).otherwise(keep_rate) if priority else keep_rate
        dropped = F.when(ends_with_ezafe(w), F.concat(bare, F.lit(T.KASRA))).otherwise(bare) if keep_ezafe else bare
        return F.when(~has_marks(w) | (uniform(F.lit(seed), row, i) < rate), w).otherwise(dropped)

    def run(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), one)
        return F.array_join(F.zip_with(F.split(t, WORD, -1), found, lambda p, f: F.concat(p, F.coalesce(f, F.lit("")))), "")

    return F.when(has_marks(text), let(text, run)).otherwise(text)


def keep_rate(step: Column, total: int, row: Column, warm: float = 0.2, anneal: float = 0.3, warm_keep: float = 0.9, seed: int = 1234) -> Column:
    """The curriculum: fixed while warm, then a falling lower bound, then any rate."""
    f = F.least(F.lit(1.0), step / F.lit(max(1, total)))
    t = (f - warm) / max(1e-9, anneal)
    low = warm_keep * (1 - t) + 0.1 * t
    u = uniform(F.lit(seed), row, step)
    return F.when(f < warm, F.lit(warm_keep)).when(f < warm + anneal, low + u * (warm_keep - low)).otherwise(u)


def sample_density(row: Column, seed: int = 1234) -> Column:
    """A rate from the fixed mix of sparse, medium and full marking."""
    r, u = uniform(F.lit(seed), row, F.lit(0)), uniform(F.lit(seed), row, F.lit(1))
    out, total = F.lit(1.0), sum(s for s, _, _ in T.DENSITY_MIX)
    for share, low, high in reversed(T.DENSITY_MIX):
        out = F.when(r <= total, low + u * (high - low)).otherwise(out) if total < 1 else low + u * (high - low)
        total -= share
    return out


def nearest_rank(sorted_values: Column, p: float) -> Column:
    """v[min(n - 1, floor(p n))] of a sorted array."""
    n = F.size(sorted_values)
    return F.element_at(sorted_values, F.least(n - 1, F.floor(F.lit(p) * n)).cast("int") + 1)


def diacritic_report(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: texts, marked texts, density quantiles, marks."""
    from sokhan.operators.report import ranked

    each = df.select(word_density(F.col(text_col)).alias("density"), count_marks(F.col(text_col)).alias("marks"))
    totals = each.agg(F.count("*").alias("n"), F.count_if(F.col("density") > 0).alias("samples_with_any_mark"), F.avg("density").alias("mean_word_density"), F.sum("marks").alias("total_marks"))
    ranks = ranked(each, "density", {"median_word_density": 0.5, "p90_word_density": 0.9})
    return totals.crossJoin(ranks)  # one row each


def problem_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each problem occurs, places left out."""
    each = df.select(F.explode(problems(F.col(text_col))).alias("p"))
    return each.groupBy(F.split_part("p", F.lit("@"), F.lit(1)).alias("problem")).agg(F.count("*").alias("n"))
