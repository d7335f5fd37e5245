"""Tokenizer cost: counts, fertility, clip survival, batching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan import tables as T
from sokhan.functions.marks import diacritic_report, mask
from sokhan.functions.text import count_marks, has_marks, strip_marks
from sokhan.operators.report import ranked

Count = Callable[[Column], Column]
CANDIDATES = ((8192, 8), (8192, 4), (8192, 2), (16384, 8), (16384, 4), (16384, 2))
OVERHEAD = 8


def stand_in_tokens(text: Column, merges: bool = True) -> Column:
    """Tokens of the stand-in tokenizer: merged pairs and known letters count one, others their UTF-8 bytes, a lead mark one."""
    t = F.regexp_replace(text, "|".join(T.MERGES), "a") if merges else text
    # Known characters become one byte each; "a" itself is one byte as it is.
    body = F.octet_length(F.translate(t, T.SINGLE_TOKENS, "a" * len(T.SINGLE_TOKENS)))
    return (body + F.when((text != "") & ~F.startswith(text, F.lit(" ")), 1).otherwise(0)).cast("long")


def fertility(df: DataFrame, text_col: str = "text", count: Count = stand_in_tokens) -> DataFrame:
    """One row: tokens a character with and without marks, what marks cost, quantiles of tokens a text."""
    t = F.col(text_col)
    each = df.select(count(t).alias("tok"), F.length(t).alias("ch"), count(strip_marks(t)).alias("btok"), F.length(strip_marks(t)).alias("bch"), count_marks(t).alias("marks"), F.regexp_count(t, F.lit(f"[{T.FALLBACK_LETTERS}]")).alias("bf"))
    s = {c: F.sum(c) for c in ("tok", "ch", "btok", "bch", "marks", "bf")}
    one = F.lit(1)
    totals = each.agg(
        F.count("*").alias("n_texts"), (s["tok"] / s["ch"]).alias("tok_per_char"), (s["btok"] / F.greatest(one, s["bch"])).alias("tok_per_char_bare"),
        (100.0 * (s["tok"] - s["btok"]) / F.greatest(one, s["btok"])).alias("diacritic_overhead_pct"), ((s["tok"] - s["btok"]) / F.greatest(one, s["marks"])).alias("tokens_per_mark"),
        (s["bf"] / s["ch"]).alias("byte_fallback_letter_share"), (s["tok"] / F.count("*")).alias("mean_tokens"),
    )
    return totals.crossJoin(ranked(each, "tok", {"median_tokens": 0.5, "p95_tokens": 0.95, "max_tokens": 1.0}))  # one row each


def cost_curve(df: DataFrame, row: str, text_col: str = "text", densities: tuple[float, ...] = (0.0, 0.15, 0.3, 0.5, 1.0), count: Count = stand_in_tokens) -> DataFrame:
    """Tokens at each share of marked words, and what they cost over none."""
    rates = F.explode(F.array(*map(F.lit, densities))).alias("keep_rate")
    each = df.select(F.col(text_col).alias("t"), F.col(row).alias("r"), rates)
    total = each.groupBy("keep_rate").agg(F.sum(count(mask(F.col("t"), F.col("keep_rate"), F.col("r"), seed=0))).alias("total_tokens"))
    base = total.filter("keep_rate = 0").select(F.col("total_tokens").alias("b"))
    return total.crossJoin(F.broadcast(base)).select("keep_rate", "total_tokens", (100.0 * (F.col("total_tokens") - F.col("b")) / F.col("b")).alias("overhead_pct"))


def audio_tokens(duration: Column, per_second: float) -> Column:
    """Rounded half to even."""
    return F.rint(duration * per_second).cast("long")


def tokens_per_second(latent_length: Column, duration: Column) -> Column:
    return latent_length / F.greatest(F.lit(1e-9), duration)


def clip_tokens(df: DataFrame, text_col: str, duration: str, per_second: float, count: Count = stand_in_tokens) -> DataFrame:
    n = count(F.col(text_col)) + audio_tokens(F.col(duration), per_second) + OVERHEAD
    return df.select(F.col(duration).cast("double").alias("duration"), n.alias("total"))


def survival_by(clips: DataFrame, settings: tuple[tuple[int, int], ...]) -> DataFrame:
    """For each (max_batch_tokens, batch_size): clips and hours kept and dropped by the ceiling, and a verdict at two percent."""
    grid = F.explode(F.array(*(F.struct(F.lit(m).alias("max_batch_tokens"), F.lit(b).alias("batch_size"), F.lit(m // b).alias("ceiling")) for m, b in settings))).alias("s")
    each = clips.select("duration", "total", grid).select("duration", "total", "s.*").withColumn("over", F.col("total") > F.col("ceiling"))
    n, over = F.count("*"), F.count_if("over")
    hours = lambda cond: F.sum(F.when(cond, F.col("duration")).otherwise(0.0)) / 3600
    return each.groupBy("max_batch_tokens", "batch_size", F.col("ceiling").alias("per_clip_ceiling")).agg(
        n.alias("n_rows"), (n - over).alias("kept"), over.alias("dropped"), (100.0 * over / F.greatest(F.lit(1), n)).alias("dropped_pct"),
        hours(~F.col("over")).alias("kept_hours"), hours(F.col("over")).alias("dropped_hours"), (over / F.greatest(F.lit(1), n) < 0.02).alias("acceptable"),
    )


def dropped_buckets(clips: DataFrame, ceiling: int) -> DataFrame:
    """Dropped clips by five seconds of duration."""
    low = (F.floor(F.col("duration") / 5) * 5).cast("long")
    return clips.filter(F.col("total") > ceiling).groupBy(F.concat(low.cast("string"), F.lit("-"), (low + 5).cast("string"), F.lit("s")).alias("bucket")).agg(F.count("*").alias("n"))


def roundtrip(tokenizer, probes: tuple[str, ...] = T.PROBES) -> dict:
    """Whether a tokenizer gives each probe back; on the driver, over a fixed list."""
    rows = []
    for p in probes:
        ids = tokenizer.encode(p, add_special_tokens=False)
        back = tokenizer.decode(ids)
        rows.append({"input": p, "n_tokens": len(ids), "n_chars": len(p), "decoded": back, "equal": back == p})
    bad = [r["input"] for r in rows if not r["equal"]]
    return {"rows": rows, "failures": bad, "all_passed": not bad}


def sample(df: DataFrame, k: int, key: str, seed: int = 0) -> DataFrame:
    """k rows by a hash of a key; the same rows whatever the partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(k)


def measured(latent_length: int | None, seconds: float | None) -> float | None:
    """Tokens a second of one clip; None where either is unknown."""
    return latent_length / max(1e-9, seconds) if latent_length and seconds else None


def audit(rows: DataFrame, k: int = 5000, seed: int = 0, per_second: float | None = None, max_batch_tokens: int = 8192, batch_size: int = 8, default_duration: float | None = None, count: Count = stand_in_tokens, marked_rows: int = 2000) -> dict:
    """All checks over a sample of a manifest (text, duration): what tokens cost, marks, and which clips survive.

    The cost curve takes the first marked rows by hash; rows that lack a duration get the
    default one, or are left out of the clip checks and counted.
    """
    rows = rows if "duration" in rows.columns else rows.withColumn("duration", F.lit(None).cast("double"))
    some = sample(rows.select("text", F.col("duration").cast("double").alias("duration")), k, "text", seed).persist()
    out = {"n_rows": some.count(), "fertility": fertility(some, count=count).first().asDict(), "diacritic_stats": diacritic_report(some).first().asDict()}
    marked = sample(some.filter(has_marks(F.col("text"))), marked_rows, "text", seed)
    if not marked.isEmpty():
        out["diacritic_cost_curve"] = [r.asDict() for r in cost_curve(marked, "text", count=count).orderBy("keep_rate").collect()]
    if per_second is not None:
        clips = some.withColumn("duration", F.coalesce(F.nullif("duration", F.lit(0.0)), F.lit(default_duration).cast("double")))
        out["missing_duration"] = clips.filter("duration is null").count()
        totals = clip_tokens(clips.filter("duration is not null"), "text", "duration", per_second, count)
        out["survival"] = next((r.asDict() for r in survival_by(totals, ((max_batch_tokens, batch_size),)).collect()), None)
        out["dropped_by_duration"] = {r["bucket"]: r["n"] for r in dropped_buckets(totals, max_batch_tokens // batch_size).collect()}
        out["batching_grid"] = [r.asDict() for r in survival_by(totals, CANDIDATES).orderBy("max_batch_tokens", "batch_size").collect()]
    some.unpersist()
    return out
