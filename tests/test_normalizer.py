"""Golden texts and invariants of the normalizer and its parts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sokhan import registry
from sokhan import tables as T
from sokhan.functions import expand, latin, marks, text
from sokhan.functions import numbers as N
from sokhan.normalizer import Config, normalized, selftest

CARDINALS = {0: "صفر", 7: "هفت", 19: "نوزده", 21: "بیست و یک", 101: "صد و یک", 999: "نهصد و نود و نه", 1000: "هزار", 1001: "هزار و یک", 2000: "دو هزار", 1000000: "یک میلیون", 1234567: "یک میلیون و دویست و سی و چهار هزار و پانصد و شصت و هفت", -5: "منفی پنج"}
ORDINALS = {1: "اول", 2: "دوم", 3: "سوم", 21: "بیست و یکم", 23: "بیست و سوم", 30: "سی‌ام", 40: "چهلم", 1000: "هزارم"}
GOLDEN = [
    ("كتاب", "کتاب"), ("مي‌رود", "می‌رود"), ("سال ۱۴۰۳", "سال هزار و چهارصد و سه"), ("۲۵٪", "بیست و پنج درصد"), ("%25", "بیست و پنج درصد"),
    ("دمای هوا -۵ درجه بود", "دمای هوا منفی پنج درجه بود"), ("بدهی 1,250 دلار", "بدهی هزار و دویست و پنجاه دلار"), ("خونه‌م.", "خونه‌م."),
    ("ص. ۱۲ را ببین", "صفحه دوازده را ببین"), ("گرفتیم.", "گرفتیم."), ("روی سایر شبکه ها ها نیست", "روی سایر شبکه‌ها ها نیست"), ("بزرگ ترین شهر", "بزرگ‌ترین شهر"),
    ("و/یا این", "و یا این"), ("آهنگ ♫ پخش شد", "آهنگ پخش شد"), ("در google جستجو کردم", "در گوگل جستجو کردم"), ("کتاب ۵ام را خواند", "کتاب پنجم را خواند"),
    ("ساعت ۱۴:۳۰", "ساعت چهارده و سی دقیقه"), ("۱۴:۳۰", "ساعت چهارده و سی دقیقه"), ("۱۴۰۳/۰۵/۱۲", "دوازدهم مرداد هزار و چهارصد و سه"), ("$500", "پانصد دلار"),
    ("نرم‌افزار Zqxwv را نصب کن", "نرم‌افزار {zqxwv} را نصب کن"), ("به فرودگاه {mehrɒbɒd} رسیدیم", "به فرودگاه {mehrɒbɒd} رسیدیم"), ("بین 5km و 3 kg", "بین پنج کیلومتر و سه کیلوگرم"),
    ("۲۵-۳۰ درصد", "بیست و پنج تا سی درصد"), ("آزمایش DNA داد", "آزمایش دی‌ان‌ای داد"), ("۲×۳ برابر شش", "دو سه برابر شش"), ("عجب!!!", "عجب!"), ("", ""), (None, ""),
]


def mismatches(df, got):
    return [tuple(r) for r in df.select("x", "want", got.alias("got")).filter("got <> want").collect()]


def test_numbers(spark):
    assert not mismatches(spark.createDataFrame(list(CARDINALS.items()), "x long, want string"), N.cardinal(F.col("x")))
    assert not mismatches(spark.createDataFrame(list(ORDINALS.items()), "x long, want string"), N.ordinal(F.col("x")))
    one = spark.range(1).select(N.digits(F.lit("09123")), N.decimal(F.lit("3"), F.lit("14")), N.decimal(F.lit("3"), F.lit("14"), "fractional"), N.fraction(F.lit(1), F.lit(2)), N.fraction(F.lit(3), F.lit(4))).first()
    assert tuple(one) == ("صفر نه یک دو سه", "سه ممیز یک چهار", "سه و چهارده صدم", "نیم", "سه چهارم")


def test_numbers_of_any_length(spark):
    digits = "1" + "0" * 49
    one = "یک" + " صفر" * 49
    df = spark.createDataFrame([(digits,)], "t string").select(expand.integers(F.col("t")), expand.ranges(F.concat("t", F.lit("-2"))), expand.currency(F.concat(F.lit("$"), "t")), expand.ordinals(F.concat("t", F.lit("ام"))), expand.fractions(F.concat("t", F.lit("/2"))), expand.decimals(F.concat("t", F.lit(".5"))))
    assert tuple(df.first()) == (one, f"{one} تا دو", f"{one} دلار", f"{one}م", digits + "/2", f"{one} ممیز پنج")
    skip = Config(skip_expansions=frozenset({"phone"}))
    assert normalized(spark.createDataFrame([("0" * 40 + "7",)], "text string"), config=skip).first()["norm"]["text"] == "هفت"


def test_names_of_columns_do_not_clash(spark):
    df = spark.createDataFrame([("كتاب ۵", 1, 2, 3)], "text string, _text int, _t int, gate string")
    row = normalized(df).first()
    assert row["norm"]["text"] == "کتاب پنج" and (row["_text"], row["_t"], row["gate"]) == (1, 2, "3")
    assert normalized(df.limit(0)).count() == 0


def test_composition_skips_only_what_it_leaves(spark):
    """Texts of the characters that aren't sent to Python are composed, whatever stands together."""
    import random
    import re
    import unicodedata

    r, inside = random.Random(1), re.compile(f"[{text.COMPOSED}]")
    chars = [chr(c) for c in range(0xFFFF) if inside.match(chr(c)) and not 0xD800 <= c < 0xE000]
    assert all(unicodedata.normalize("NFC", c) == c and not unicodedata.combining(c) for c in chars)
    assert all(unicodedata.is_normalized("NFC", "".join(r.choices(chars, k=400))) for _ in range(300))
    rows = [("e\u0301 \u212B",), ("ئا" + "\u0627\u0653",), ("plain",), (None,)]
    got = [x[0] for x in spark.createDataFrame(rows, "t string").select(text.composed(F.col("t"))).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFC", t) for (t,) in rows]


def test_golden_texts(spark):
    df = spark.createDataFrame(GOLDEN, "x string, want string")
    assert [tuple(r) for r in normalized(df, "x").filter("norm.text <> want").select("x", "want", "norm.text").collect()] == []


def test_transliterate(spark):
    rows = [("60تا تاجر", "شصت تا تاجر"), ("ما Great Depressionایم", "ما گریت دیپرشن ایم"), ("تریلر GTA6منتشر شد", "تریلر جی‌تی‌ای شش منتشر شد"), ("ویتامین d بخور", "ویتامین دی بخور")]
    df = spark.createDataFrame(rows, "x string, want string")
    assert normalized(df, "x", Config(latin_strategy="transliterate")).filter("norm.text <> want").count() == 0


def test_idempotent(spark):
    rows = ["استفاده کرده 130 00:13:30,686 --> 00:13:30,666 میشه اینطور", "یک:‌ توانایی یادگیری‌مون داره می‌آد پایین", "مسئول‌ش .. این‌که من در واقع", "قیمت ۱۲٬۵۰۰ تومان بود، یعنی حدود $3.5", "کِرْمِ ابریشم و بچّه‌ها"]
    r = selftest(spark.createDataFrame([(x,) for x in rows], "text string")).first()
    assert (r["n"], r["empty"], r["idempotent"], r["problems"]) == (5, 0, 0, 0)


def test_strip_marks_keeps_words(spark):
    df = spark.createDataFrame([("کِرْم",)], "text string")
    assert normalized(df, config=Config(keep_harakat=False)).first()["norm"]["text"] == "کرم"


def test_problems(spark):
    df = spark.createDataFrame([("کِرْم",), ("ِکرم",), ("کرمِِ",)], "t string")
    assert [r[0] for r in df.select(text.problems(F.col("t"))).collect()] == [[], ["mark_at_start"], ["double_mark@4"]]


def test_mask_is_the_same_on_any_partitions(spark):
    df = spark.range(200).select("id", F.lit("کِتابِ بُزُرگ").alias("t"))
    a, b = (sorted(map(tuple, df.repartition(n).select("id", marks.mask(F.col("t"), F.lit(0.5), F.col("id")).alias("m")).collect())) for n in (1, 7))
    assert a == b and len({m for _, m in a}) > 1


def test_version():
    assert Config().version == Config().version != Config(decimal_style="fractional").version


def test_strategy_is_checked():
    with pytest.raises(ValueError):
        latin.resolve(None, "none")


def test_selftest_query_uses_all_cores(spark):
    """A table in one file of one row group isn't normalized by a single task."""
    plan = registry.queries()["normalizer_selftest"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {2 * spark.sparkContext.defaultParallelism}, true" in plan


def test_spacing_by_plain_rules(spark):
    """Shortcuts for texts that a rule can't change give what the rules alone give."""
    r, z, fa, end, pause = random.Random(9), T.ZWNJ, "[؀-ۿ]", ".!؟…", "،؛"
    closing = re.escape("".join(c for c in T.KEPT_PUNCTUATION if c not in "«-'"))
    spacing = [(r"\s+", " "), (rf"\s+{z}", z), (rf"{z}\s+", z), (f"{z}{{2,}}", z), (f"{z}(?!{fa})", ""), (f"(?<!{fa}){z}", ""), (rf"\s+([{closing}])", r"\1"), (r"([.!:،؛؟])(?=\S)", r"\1 "), (r"^\s+|\s+$", "")]
    cleanup = [
        (r"\s*[-–—]\s+", "، "), (r"\s+[-–—]\s*", "، "), (rf"([{pause}])[\s{pause}]*([{pause}])", r"\2"), (rf"[{pause}]\s*(?=[{end}])", ""), (rf"([{end}])\s*[{pause}]", r"\1"),
        (rf"([{end}])[\s{end}]*([{end}])", r"\2"), (rf"^[{pause}{end}\s]+", ""),
    ]

    def plain(rules, t):
        for pattern, to in rules:
            t = re.sub(pattern, to, t)
        return t

    bits = ["ک", "تا", "a", " ", "  ", "\t", " ", "\x1c", z, z, "-", "—", *pause, *end, ":", "«", "»", "'", "3"]
    rows = [("".join(r.choices(bits, k=r.randint(0, 14))),) for _ in range(4000)]
    got = spark.createDataFrame(rows, "t string").select("t", text.fix_spacing(F.col("t")).alias("s"), text.cleanup(F.col("t")).alias("c")).collect()
    assert [x["t"] for x in got if (x["s"], x["c"]) != (plain(spacing, x["t"]), plain(cleanup, x["t"]))] == []


def test_blanks():
    assert T.BLANKS == "".join(chr(c) for c in range(0x10000) if re.match(r"\s", chr(c)))
