"""Corpus statistics as small aggregated DataFrames."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sokhan.normalizer import Config, selftest
from sokhan.operators.gates import as_number

QUANTILES = {"min": 0.0, "p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "max": 1.0}
#: Bins of distinct values in exact quantiles.
BINS = 128


def stage_counts(df: DataFrame, gate: str = "gate") -> DataFrame:
    """Rows by reason; kept rows have none."""
    return df.groupBy(F.coalesce(gate, F.lit("kept")).alias("stage")).agg(F.count("*").alias("n"))


def keep_rate(df: DataFrame, gate: str = "gate") -> DataFrame:
    kept = F.count_if(F.col(gate).isNull())
    return df.agg(F.count("*").alias("read"), kept.alias("kept"), (kept / F.greatest(F.count("*"), F.lit(1))).alias("keep_rate"))


def top(df: DataFrame, key: Column, k: int, name: str = "key", weight: Column | None = None) -> DataFrame:
    """The most frequent (or heaviest) values; ties by value."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(key.alias(name)).agg(n.alias("n")).orderBy(F.desc("n"), name).limit(k)


def unexpected_top(df: DataFrame, unexpected: Column, k: int = 40) -> DataFrame:
    """Characters by the number of rows that hold them."""
    return top(df.select(F.explode(unexpected).alias("char")), F.col("char"), k, "char")


def ranked(df: DataFrame, value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row of nearest-rank quantiles v[min(n - 1, floor(p n))], by a counted histogram.

    Equal values are counted first. Distinct values fall into bins between their
    approximate quantiles, near equal in size however the values are spread, and
    the running count is over the bins' sums, so that no task sorts all rows.
    The edges only deal values out; the result is exact.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    total = counts.agg(F.sum("c").alias("n"))
    edges = counts.agg(F.array_distinct(F.percentile_approx("v", [i / BINS for i in range(1, BINS)], 10 * BINS)).alias("edges"))
    dealt = counts.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("v")))).drop("edges")
    bins = dealt.groupBy("bin").agg(F.sum("c").alias("in_bin"))
    before = bins.select("bin", (F.sum("in_bin").over(Window.orderBy("bin")) - F.col("in_bin")).alias("before"))  # a row for each bin
    below = dealt.join(F.broadcast(before), "bin").select("v", "c", (F.col("before") + F.sum("c").over(Window.partitionBy("bin").orderBy("v")) - F.col("c")).alias("below"))
    at = {name: F.least(F.col("n") - 1, F.floor(F.lit(p) * F.col("n"))) for name, p in quantiles.items()}
    rows = below.crossJoin(F.broadcast(total))
    return rows.agg(*(F.max(F.when((F.col("below") <= a) & (a < F.col("below") + F.col("c")), F.col("v"))).alias(n) for n, a in at.items()))


def field_stats(df: DataFrame, value: str) -> DataFrame:
    """n, quantiles and mean of a column, nulls left out."""
    totals = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    return totals.crossJoin(ranked(df, value, QUANTILES))  # one row each


def top_share(df: DataFrame, key: Column) -> DataFrame:
    """The share of rows of the largest tenth of groups, at least one."""
    counts = df.groupBy(key.alias("key")).agg(F.count("*").alias("c"))
    # Groups by size: how many there are of each size, so the window has a row for each size only.
    sizes = counts.groupBy("c").agg(F.count("*").alias("groups"))
    w = Window.orderBy(F.desc("c"))
    run = sizes.select("c", "groups", (F.sum("groups").over(w) - F.col("groups")).alias("before"))
    totals = counts.agg(F.greatest(F.lit(1), F.floor(F.count("*") / 10)).alias("k"), F.sum("c").alias("n"))
    taken = F.greatest(F.lit(0), F.least(F.col("groups"), F.col("k") - F.col("before")))
    return run.crossJoin(F.broadcast(totals)).agg((F.sum(taken * F.col("c")) / F.max("n")).alias("share"))


def density(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(col).alias("mean"), F.avg((F.col(col) == 0).cast("int")).alias("zero_share"))


def dropped_examples(df: DataFrame, order: list[str], text_col: str, k: int = 10, reasons: tuple[str, ...] = ("drop_text_pattern", "drop_empty_after_norm", "drop_too_long")) -> DataFrame:
    """The first dropped rows of some reasons, in a stated order."""
    return df.filter(F.col("gate").isin(*reasons)).orderBy(*order).limit(k).select(*(c for c in order if c != text_col), "gate", F.substring(text_col, 1, 160).alias("text"))


def corpus_report(df: DataFrame, speaker: str | None = None, duration: str | None = None, default_speaker: str = "unknown", config: Config = Config(), fields: dict[str, str] | None = None, with_selftest: bool = False) -> dict:
    """All statistics of gated rows (with norm and gate) as one nested document; each part is small.

    Callers that read df more than once persist it. fields: columns by the name of what they hold, for their quantiles.
    """
    kept, judged = df.filter("gate is null"), df.filter("norm is not null")
    out: dict = {"frontend_version": config.version, "config": {k: sorted(v) if isinstance(v, frozenset) else v for k, v in asdict(config).items()}}
    out |= {"stages": {r["stage"]: r["n"] for r in stage_counts(df).collect()}} | keep_rate(df).first().asDict()
    out["unexpected_chars"] = {r["char"]: r["n"] for r in unexpected_top(judged, F.col("norm.unexpected")).collect()}
    each = judged.select(F.explode("norm.problems").alias("p"))
    out["diacritic_problems"] = {r["p"]: r["n"] for r in top(each, F.split_part("p", F.lit("@"), F.lit(1)), 100, "p").collect()}
    out["density"] = density(kept.select(F.col("norm.diacritic_density").alias("d")), "d").first().asDict()
    out["latin_work_queue"] = [(r["t"], r["n"]) for r in top(judged.select(F.explode("norm.latin_unknown").alias("t")), F.col("t"), 60, "t").collect()]
    if speaker:
        who = F.coalesce(F.nullif(F.col(speaker), F.lit("")), F.lit(default_speaker))
        out["speakers"] = {"n_distinct": kept.select(who.alias("s")).distinct().count(), "top": [(r["s"], r["n"]) for r in top(kept, who, 20, "s").collect()], "gini_hint": top_share(kept, who).first()["share"]}
        if duration:
            out["speakers"]["top_hours"] = [(r["s"], r["n"]) for r in top(kept, who, 20, "s", F.col(duration) / 3600).collect()]
    order = [c for c in ("audio", "text") if c in df.columns]
    out["dropped_examples"] = [r.asDict() for r in dropped_examples(df, order, "text").collect()] if "text" in order else []
    if fields:
        out["field_stats"] = {n: field_stats(kept.select(as_number(F.col(f"`{c}`")).alias("v")), "v").first().asDict() for n, c in sorted(fields.items())}
    if duration:
        hours = kept.agg((F.sum(duration) / 3600).alias("h")).first()["h"]
        out["audio_duration"] = field_stats(kept, duration).first().asDict() | {"total_hours": hours}
    if with_selftest:
        out["selftest"] = selftest(judged.select(F.col("norm.raw").alias("text")), "text", config).first().asDict()
    return out
