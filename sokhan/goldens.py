"""Queries of single rules over fixed texts beside each region; their SQL is the table of what must come out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan import tables as T
from sokhan.functions import expand, latin, marks, text
from sokhan.normalizer import Config, normalized, selftest
from sokhan.operators import audit, report
from sokhan.operators.gates import Gates, with_gate
from sokhan.session import table

Z = T.ZWNJ
ACUTE, HAMZA_ABOVE = "́", "ٔ"
#: Rule by name: the column function and pairs of a text and what the rule makes of it.
RULES: dict[str, tuple[Callable[[Column], Column], dict[str, str]]] = {
    "punctuation": (text.punctuation, {'"سلام" گفت': " «سلام» گفت", "سلام, دنیا; خوب?": "سلام، دنیا؛ خوب؟", "صبر....کن": "صبر…کن", "چی؟؟!!": "چی؟!", "متن (داخل) بعد": "متن، داخل، بعد"}),
    "punctuation_with_brackets": (lambda t: text.punctuation(t, False), {"متن (داخل) بعد": "متن (داخل) بعد"}),
    "fix_spacing": (text.fix_spacing, {"سلام  دنیا .": "سلام دنیا.", f"می{Z} رود": f"می{Z}رود", "خوب،بد": "خوب، بد", f"  a{Z}b ": "ab", f"کتاب{Z}{Z}ها": f"کتاب{Z}ها"}),
    "cleanup": (text.cleanup, {"خوب - بد": "خوب، بد", "خوب،، بد": "خوب، بد", "تمام، .": "تمام.", "،سلام": "سلام", "چه؟ !": "چه!"}),
    "repair_joiners": (text.repair_joiners, {"می رود": f"می{Z}رود", "نمی دانم": f"نمی{Z}دانم", "کتاب ها": f"کتاب{Z}ها", "بزرگ ترین شهر": f"بزرگ{Z}ترین شهر", "ها ها": f"ها{Z}ها"}),
    "separate_scripts": (text.separate_scripts, {"60تا": "60 تا", "سلامhello": "سلام hello", "GTA6": "GTA6", "ب5ت": "ب 5 ت"}),
    "presentation_forms": (text.presentation_forms, {"ﺳﻼﻡ": "سلام", "﷼": "ریال", "سلام": "سلام"}),
    "composition": (text.composed, {f"e{ACUTE}": "é", "آ": "آ", "سلام": "سلام"}),
    "fold_all": (text.fold, {c: to for c, to in (T.FOLDED | T.PHRASES).items()}),
    "drop_foreign_marks": (text.drop_foreign_marks, {f"خانه{HAMZA_ABOVE}": "خانه", **{f"ب{m}": "ب" for m in T.DROPPED_MARKS}}),
    "strip_marks": (text.strip_marks, {"کِتابِ بُزُرگ": "کتاب بزرگ", "بچّه": "بچه"}),
    "abbreviations": (expand.abbreviations, {"ص. 12": " صفحه  12", "خاص. 12": "خاص. 12", "سال 300 ه.ق": "سال 300  هجری قمری ", "الخ": " و غیره "}),
    "thousands": (expand.thousands, {"1,250,000": "1250000", "1,25": "1,25", "12٬500": "12500"}),
    "signs": (expand.signs, {"-5 درجه": "منفی 5 درجه", "دما +3": "دما مثبت 3", "2-3": "2-3", "- 5": "- 5"}),
    "times": (expand.time, {"14:30": "ساعت چهارده و سی دقیقه", "ساعت 8:05": "ساعت هشت و پنج دقیقه", "7:00": "ساعت هفت", "25:10": "25:10", "1:02:03": "ساعت یک و دو دقیقه و سه ثانیه"}),
    "dates": (expand.dates, {"1403/05/12": "دوازدهم مرداد هزار و چهارصد و سه", "12/05/1403": "دوازدهم مرداد هزار و چهارصد و سه", "2024-13-01": "2024-13-01", "1.2.2024": "اول فوریه دو هزار و بیست و چهار", "1501/1/3": "سوم ژانویه هزار و پانصد و یک"}),
    "phone": (expand.phone, {"09123456789": "صفر نه یک دو سه چهار پنج شش هفت هشت نه", "12345678901": "یک دو سه چهار پنج شش هفت هشت نه صفر یک", "1234567890": "1234567890"}),
    "currency": (expand.currency, {"$500": "پانصد دلار", "€3.5": "سه ممیز پنج یورو", "£1,000": "هزار پوند", "¥20": "بیست ین", "﷼7": "هفت ریال", "5$": "5$"}),
    "percent": (expand.percent, {"%25": "بیست و پنج درصد", "2.5٪": "دو ممیز پنج درصد", "50 %": "پنجاه درصد", "%2.5": "دو درصد.5"}),
    "units": (expand.units, {f"3{u}": f"3 {v}" for u, v in T.UNITS.items() if u != "°"} | {"3 kg": "3  کیلوگرم", "3kgs": "3kgs", "3°": "3°"}),
    "fractions": (expand.fractions, {"1/2": "نیم", "3/4": "سه چهارم", "1/0": "1/0", "5/2000": "5/2000", "2 / 3": "دو سوم"}),
    "ordinals": (expand.ordinals, {"5ام": "پنجم", "3مین": "سوم", "1ام": "اول", "30ام": f"سی{Z}ام"}),
    "decimals": (expand.decimals, {"3.14": "سه ممیز یک چهار", "2.50": "دو ممیز پنج", "0.0": "صفر ممیز صفر"}),
    "decimals_as_shares": (lambda t: expand.decimals(t, "fractional"), {"3.14": "سه و چهارده صدم", "2.5": "دو و پنج دهم"}),
    "integers": (expand.integers, {"007": "هفت", "1000": "هزار", "2001": "دو هزار و یک", "1" + "0" * 40: "یک" + " صفر" * 40}),
    "acronyms": (latin.spell, {"DNA": f"دی{Z}ان{Z}ای", "AB": f"ای{Z}بی"}),
    "transliteration": (latin.transliterate, {"banana": "بانانا", "anna": "آننا", "tree": "تری", "xqu": "کسکو", "eee": "ی"}),
    "latin_escalate": (latin.resolve, {"در google": "در گوگل", "DNA و b": f"دی{Z}ان{Z}ای و بی", "Zqxwv.": "{zqxwv}"}),
    "latin_transliterate": (lambda t: latin.resolve(t, "transliterate"), {"Great banana": "گریت بانانا", "GTA": f"جی{Z}تی{Z}ای"}),
    "mark_counts": (lambda t: F.concat_ws(",", text.has_marks(t).cast("string"), text.count_marks(t).cast("string"), text.ends_with_ezafe(t).cast("string")), {"کِتابِ": "true,2,true", "کتاب": "false,0,false", "بُزُرگ": "true,2,false"}),
    "mark_order": (text.mark_order_signature, {"بّ": "33", "بَّ": "3033", "بَّکِ": "3033|32"}),
    "mark_problems": (lambda t: F.concat_ws(",", text.problems(t)), {"کِرْم": "", "ِکرم": "mark_at_start", "کرمِِ": "double_mark@4", "a ِ": "mark_on_nonletter@2", f"می{Z}ِ": "mark_on_nonletter@3,mark_after_zwnj@3"}),
    "densities": (lambda t: F.concat_ws(",", F.size(text.words(t)).cast("string"), text.word_density(t).cast("string")), {"کِتاب بزرگ": "2,0.5", "abc": "0,0.0", "کِتابِ بُزُرگ": "2,1.0"}),
}
#: Texts and what the whole normalizer makes of them.
NORMALIZED = {
    "كتاب": "کتاب", f"مي{Z}رود": f"می{Z}رود", "سال ۱۴۰۳": "سال هزار و چهارصد و سه", "۲۵٪": "بیست و پنج درصد", "%25": "بیست و پنج درصد",
    "دمای هوا -۵ درجه بود": "دمای هوا منفی پنج درجه بود", "بدهی 1,250 دلار": "بدهی هزار و دویست و پنجاه دلار", "ص. ۱۲ را ببین": "صفحه دوازده را ببین",
    "بزرگ ترین شهر": f"بزرگ{Z}ترین شهر", "و/یا این": "و یا این", "آهنگ ♫ پخش شد": "آهنگ پخش شد", "در google جستجو کردم": "در گوگل جستجو کردم",
    "ساعت ۱۴:۳۰": "ساعت چهارده و سی دقیقه", "۱۴۰۳/۰۵/۱۲": "دوازدهم مرداد هزار و چهارصد و سه", "$500": "پانصد دلار", f"نرم{Z}افزار Zqxwv را نصب کن": f"نرم{Z}افزار {{zqxwv}} را نصب کن",
    "به فرودگاه {mehrɒbɒd} رسیدیم": "به فرودگاه {mehrɒbɒd} رسیدیم", "بین 5km و 3 kg": "بین پنج کیلومتر و سه کیلوگرم", "۲۵-۳۰ درصد": "بیست و پنج تا سی درصد", "عجب!!!": "عجب!",
}


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows: dict[str, str]) -> str:
    """SQL for each region beside each text and what comes of it."""
    listed = ", ".join(f"({quoted(raw)}, {quoted(said)})" for raw, said in rows.items())
    return f"SELECT r_name, raw, said FROM region CROSS JOIN (VALUES {listed}) AS t(raw, said)"


def beside_regions(spark, d: str, texts: list[str]) -> DataFrame:
    fixed = spark.createDataFrame([(x,) for x in texts], "raw string")
    return table(spark, d, "region").select("r_name").crossJoin(F.broadcast(fixed))


def register(query: Callable) -> None:
    """Adds the queries to a registry by its decorator."""

    def rule(name: str, fn: Callable[[Column], Column], rows: dict[str, str]) -> None:
        def run(spark, d):
            return beside_regions(spark, d, list(rows)).select("r_name", "raw", fn(F.col("raw")).alias("said"))

        run.__name__ = f"rule_{name}"
        query(values(rows))(run)

    for name, (fn, rows) in RULES.items():
        rule(name, fn, rows)

    @query(values(NORMALIZED))
    def normalizer_goldens(spark, d):
        return normalized(beside_regions(spark, d, list(NORMALIZED)), "raw").select("r_name", "raw", F.col("norm.text").alias("said"))

    @query(values({"کِرْم": "کرم"}))
    def normalizer_without_marks(spark, d):
        return normalized(beside_regions(spark, d, ["کِرْم"]), "raw", Config(keep_harakat=False)).select("r_name", "raw", F.col("norm.text").alias("said"))

    @query(f"SELECT 5 * {len(NORMALIZED)} AS n, 0 AS empty, 0 AS idempotent, 10 AS unexpected, 0 AS problems")
    def selftest_goldens(spark, d):
        # The note sign and the slash are unexpected.
        out = selftest(beside_regions(spark, d, list(NORMALIZED)), "raw")
        return out.select(*(F.col(c).cast("int").alias(c) for c in ("n", "empty", "idempotent", "unexpected", "problems")))

    clips = (("a", "سلام دنیا", 2.0, None), ("b", " ", 2.0, None), ("c", "یک", 2.0, None), ("d", "سلام به همه", 90.0, None), ("e", "سلام به شما", None, None), ("f", "سلام به ما", 0.5, None), ("g", "♫", 3.0, None), ("h", "خیلی خیلی خیلی بلند", 3.0, None), ("i", "", 1.0, "bad_json"), ("j", "بد &&& است", 3.0, None))
    gates = {"a": "kept", "b": "drop_empty_source", "c": "drop_too_short", "d": "drop_too_long_audio", "e": "drop_duration_unknown", "f": "drop_too_short_audio", "g": "drop_empty_after_norm", "h": "drop_too_long", "i": "bad_json", "j": "drop_text_pattern"}

    @query("SELECT r_name, audio, gate FROM region CROSS JOIN (VALUES " + ", ".join(f"('{a}', '{g}')" for a, g in gates.items()) + ") AS t(audio, gate)")
    def gate_chain(spark, d):
        rows = spark.createDataFrame(list(clips), "audio string, text string, duration double, error string")
        df = table(spark, d, "region").select("r_name").crossJoin(F.broadcast(rows))
        g = Gates(drop_pattern="&{3}", max_chars=15, min_duration=1.0, max_duration=30.0)
        return with_gate(df, g, "text", duration="duration", error="error").select("r_name", "audio", F.coalesce("gate", F.lit("kept")).alias("gate"))

    @query("SELECT 'drop_text_pattern' AS gate, doc_id, left(text, 160) AS text FROM documents WHERE trim(text) <> '' AND regexp_matches(text, '[%&#$]{3}') ORDER BY doc_id LIMIT 10")
    def dropped_examples(spark, d):
        docs = table(spark, d, "documents").select("doc_id", "text")
        gate = F.when(text.strip(F.col("text")) == "", "drop_empty_source").when(F.regexp_like("text", F.lit("[%&#$]{3}")), "drop_text_pattern")
        return report.dropped_examples(docs.withColumn("gate", gate), ["doc_id"], "text")

    @query("SELECT 'mark_at_start' AS problem, count(*) AS n FROM part UNION ALL SELECT 'double_mark', 2 * count(*) FROM part")
    def problem_histogram(spark, d):
        return marks.problem_counts(table(spark, d, "part").select(F.concat(F.lit("ِکرمِِِ "), F.col("p_name")).alias("text")))

    @query("SELECT count(*) AS n, count_if(p_size % 4 > 0) AS samples_with_any_mark, avg((p_size % 4) / 3) AS mean_word_density, sum(p_size % 4)::BIGINT AS total_marks, list_sort(list((p_size % 4) / 3))[least(count(*) - 1, floor(0.5 * count(*))::BIGINT) + 1] AS median_word_density, list_sort(list((p_size % 4) / 3))[least(count(*) - 1, floor(0.9 * count(*))::BIGINT) + 1] AS p90_word_density FROM part")
    def diacritic_statistics(spark, d):
        marked = F.col("p_size") % 4
        words = F.concat_ws(" ", *(F.when(marked > i, F.lit("بُز")).otherwise(F.lit("بز")) for i in range(3)))
        return marks.diacritic_report(table(spark, d, "part").select(words.alias("text")))

    @query("SELECT avg((p_size % 4) / 3) AS mean, avg(CASE WHEN p_size % 4 = 0 THEN 1 ELSE 0 END) AS zero_share FROM part")
    def density_statistics(spark, d):
        return report.density(table(spark, d, "part").select(((F.col("p_size") % 4) / 3).alias("d")), "d")

    @query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'warm' WHEN p_size < 25 THEN 'falling' ELSE 'any' END AS stage, true AS within FROM part")
    def masking_schedule(spark, d):
        """The stages of the curriculum over 50 steps, and whether each rate lies within its stage's bounds."""
        rate, size = marks.keep_rate(F.col("p_size"), 50, F.col("p_partkey")), F.col("p_size")
        low = 0.9 - (size / 50 - 0.2) / 0.3 * 0.8
        stage = F.when(size < 10, "warm").when(size < 25, "falling").otherwise("any")
        within = F.when(size < 10, rate == 0.9).when(size < 25, (rate >= low - 1e-9) & (rate <= 0.9)).otherwise((rate >= 0) & (rate < 1))
        return table(spark, d, "part").select("p_partkey", stage.alias("stage"), within.alias("within"))

    @query("SELECT count(*) AS n, 0::BIGINT AS outside, true AS near_mix FROM orders")
    def density_mix(spark, d):
        """Sampled densities: how many lie in no part of the mix, and whether the parts' shares are within two hundredths."""
        rate = table(spark, d, "orders").select(marks.sample_density(F.col("o_orderkey")).alias("r"))
        part = F.coalesce(*(F.when(F.col("r").between(low, high), i) for i, (_, low, high) in enumerate(T.DENSITY_MIX)), F.lit(-1))
        shares = [F.abs(F.avg((F.col("part") == i).cast("int")) - share) < 0.02 for i, (share, _, _) in enumerate(T.DENSITY_MIX)]
        return rate.withColumn("part", part).agg(F.count("*").alias("n"), F.count_if(F.col("part") < 0).alias("outside"), (shares[0] & shares[1] & shares[2]).alias("near_mix"))

    tokens = lambda t: f"strlen(translate(regexp_replace({t}, '{'|'.join(T.MERGES)}', 'a', 'g'), '{T.SINGLE_TOKENS}', '{'a' * len(T.SINGLE_TOKENS)}')) + 1"
    bare, full = "'کتابِ ' || p_name || ' بزرگ'", "'کِتابِ ' || p_name || ' بُزُرگ'"

    @query(f"SELECT k AS keep_rate, t::BIGINT AS total_tokens, 100.0 * (t - b) / b AS overhead_pct FROM (SELECT sum({tokens(bare)}) AS b, sum({tokens(full)}) AS f FROM part), LATERAL (VALUES (0.0::DOUBLE, b), (1.0::DOUBLE, f)) AS v(k, t)")
    def cost_of_all_marks(spark, d):
        t = F.concat(F.lit("کِتابِ "), F.col("p_name"), F.lit(" بُزُرگ"))
        return audit.cost_curve(table(spark, d, "part").select("p_partkey", t.alias("text")), "p_partkey", densities=(0.0, 1.0))

    @query("SELECT o_orderkey, o_totalprice / greatest(1e-9, o_orderkey % 7) AS per_second, CAST(round_even(o_custkey * 2.5, 0) AS BIGINT) AS audio_tokens FROM orders")
    def token_rates(spark, d):
        rate = audit.tokens_per_second(F.col("o_totalprice"), (F.col("o_orderkey") % 7).cast("double"))
        return table(spark, d, "orders").select("o_orderkey", rate.alias("per_second"), audit.audio_tokens(F.col("o_custkey"), 2.5).alias("audio_tokens"))
