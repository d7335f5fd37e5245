"""Queries of the library's own operators over whole tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan import goldens
from sokhan import tables as T
from sokhan.functions import expand, latin, marks, text
from sokhan.functions import numbers as N
from sokhan.normalizer import normalized, selftest
from sokhan.operators import audit, report
from sokhan.operators.gates import Gates, as_number, source_gate, with_gate
from sokhan.session import expose_package, spread, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with SQL if there is any."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            expose_package(spark)
            return fn(spark, sf_dir)

        _QUERIES[fn.__name__] = run
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def sql_list(names: list[str]) -> str:
    return "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "]"


def sql_join(items: str, sep: str = N.AND) -> str:
    return f"array_to_string(list_filter([{items}], lambda x: x <> ''), '{sep}')"


def sql_cardinal(n: str) -> str:
    """SQL for whole numbers from 0 to below 10^12."""

    def group(i: int) -> str:
        g = f"CAST(({n}) // {1000**i} % 1000 AS BIGINT)"
        words = sql_join(f"{sql_list(T.HUNDREDS)}[{g} // 100 + 1], {sql_list(N.BELOW_HUNDRED)}[{g} % 100 + 1]")
        one = f"WHEN {g} = 1 THEN '{T.SCALES[1]}' " if i == 1 else ""
        return f"CASE WHEN {g} = 0 THEN '' {one}ELSE {words} || '{' ' + T.SCALES[i] if i else ''}' END"

    return f"CASE WHEN ({n}) = 0 THEN '{T.ZERO}' ELSE {sql_join(', '.join(group(i) for i in (3, 2, 1, 0)))} END"


def sql_ordinal(n: str) -> str:
    return f"(SELECT CASE WHEN n = 1 THEN 'اول' WHEN w LIKE '%سه' THEN left(w, length(w) - 2) || 'سوم' WHEN w LIKE '%یک' THEN left(w, length(w) - 2) || 'یکم' WHEN w LIKE '%ی' THEN w || '{T.ZWNJ}ام' ELSE w || 'م' END FROM (SELECT n, {sql_cardinal('n')} AS w FROM (SELECT CAST({n} AS BIGINT) AS n)))"


def sql_digits(s: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({s}, '[0-9]'), lambda d: {sql_list(T.DIGITS)}[CAST(d AS INT) + 1]), ' ')"


@query(f"SELECT p_partkey, {sql_cardinal('p_partkey * 7919')} AS words FROM part")
def cardinal(spark, d):
    return table(spark, d, "part").select("p_partkey", N.cardinal(F.col("p_partkey") * 7919).alias("words"))


@query(f"SELECT p_partkey, CASE WHEN n = 1 THEN 'اول' WHEN w LIKE '%سه' THEN left(w, length(w) - 2) || 'سوم' WHEN w LIKE '%یک' THEN left(w, length(w) - 2) || 'یکم' WHEN w LIKE '%ی' THEN w || '{T.ZWNJ}ام' ELSE w || 'م' END AS words FROM (SELECT p_partkey, p_partkey AS n, {sql_cardinal('p_partkey')} AS w FROM part)")
def ordinal(spark, d):
    return table(spark, d, "part").select("p_partkey", N.ordinal(F.col("p_partkey")).alias("words"))


@query(f"SELECT o_orderkey, {sql_digits('CAST(o_custkey AS VARCHAR)')} AS words FROM orders")
def digits(spark, d):
    return table(spark, d, "orders").select("o_orderkey", N.digits(F.col("o_custkey").cast("string")).alias("words"))


_MONEY = "CAST(round(p_retailprice * 100) AS BIGINT)"
_FRACTION = f"lpad(CAST({_MONEY} % 100 AS VARCHAR), 2, '0')"
_KEPT = f"CASE WHEN regexp_replace({_FRACTION}, '0+$', '') = '' THEN '0' ELSE regexp_replace({_FRACTION}, '0+$', '') END"


def _money():
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    return F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")


@query(f"SELECT p_partkey, {sql_cardinal(_MONEY + ' // 100')} || ' {T.POINT} ' || {sql_digits(_KEPT)} AS words FROM part")
def decimal(spark, d):
    return table(spark, d, "part").select("p_partkey", N.decimal(*_money()).alias("words"))


@query(f"SELECT p_partkey, {sql_cardinal('p_size')} || ' ' || {sql_ordinal('p_size + 51')} AS words FROM part")
def fraction(spark, d):
    return table(spark, d, "part").select("p_partkey", N.fraction(F.col("p_size"), F.col("p_size") + 51).alias("words"))


@query(f"SELECT event_id, 'ساعت ' || {sql_cardinal('hour(ts)')} || CASE WHEN minute(ts) > 0 THEN ' و ' || {sql_cardinal('minute(ts)')} || ' دقیقه' ELSE '' END AS words FROM events")
def time_expand(spark, d):
    return table(spark, d, "events").select("event_id", expand.time(F.date_format("ts", "HH:mm")).alias("words"))


@query(f"SELECT o_orderkey, {sql_ordinal('day(o_orderdate)')} || ' ' || {sql_list(T.GREGORIAN)}[month(o_orderdate)] || ' ' || {sql_cardinal('year(o_orderdate)')} AS words FROM orders")
def date_expand(spark, d):
    return table(spark, d, "orders").select("o_orderkey", expand.dates(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("words"))


@query(f"SELECT p_partkey, {sql_cardinal(_MONEY + ' // 100')} || ' {T.POINT} ' || {sql_digits(_KEPT)} || ' دلار' AS words FROM part")
def currency_expand(spark, d):
    i, f = _money()
    return table(spark, d, "part").select("p_partkey", expand.currency(F.concat(F.lit("$"), i, F.lit("."), f)).alias("words"))


@query(f"SELECT p_partkey, {sql_cardinal('p_size')} || ' درصد' AS words FROM part")
def percent_expand(spark, d):
    return table(spark, d, "part").select("p_partkey", expand.percent(F.concat(F.col("p_size").cast("string"), F.lit("%"))).alias("words"))


@query(f"SELECT p_partkey, {sql_cardinal('p_size')} || ' تا ' || {sql_cardinal('p_size + p_partkey')} AS words FROM part")
def range_expand(spark, d):
    return table(spark, d, "part").select("p_partkey", expand.ranges(F.concat_ws("-", F.col("p_size").cast("string"), (F.col("p_size") + F.col("p_partkey")).cast("string"))).alias("words"))


@query(f"SELECT p_partkey, {sql_cardinal('p_size')} || ' ' || 'کیلوگرم' AS words FROM part")
def unit_expand(spark, d):
    s = F.concat(F.col("p_size").cast("string"), F.lit("kg"))
    return table(spark, d, "part").select("p_partkey", expand.integers(expand.units(s)).alias("words"))


@query(f"SELECT doc_id, length(translate(text, ' ' || '{T.REMOVED}', ' ')) AS n FROM documents")
def remove_invisibles(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(text.remove_invisibles(F.regexp_replace("text", "[\t\x0b\x0c]", " "))).cast("long").alias("n"))


@query("SELECT doc_id, count(*) AS n_tokens FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9''.-]*')) AS t FROM documents) GROUP BY doc_id")
def latin_tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(latin.tokens(F.col("text"))).cast("long").alias("n_tokens")).filter("n_tokens > 0")


_KEY = "regexp_replace(lower(t), '^[.''-]+|[.''-]+$', '', 'g')"


@query(f"SELECT token, count(*) AS n FROM (SELECT CASE WHEN regexp_full_match(t, '[A-Z]{{2,6}}') THEN t ELSE {_KEY} END AS token FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9''.-]*')) AS t FROM documents) WHERE {_KEY} NOT IN ({', '.join(repr(k) for k in T.LATIN_WORDS)}) AND NOT regexp_full_match({_KEY}, '[a-z]')) GROUP BY token ORDER BY n DESC, token LIMIT 60")
def latin_work_queue(spark, d):
    return latin.work_queue(spread(table(spark, d, "documents").select("text")), "text", 60)


def sql_class(chars: str) -> str:
    """The inside of a character class for DuckDB's patterns."""
    return "".join(f"\\x{{{ord(c):X}}}" for c in sorted(set(chars)))


_ALLOWED = "\\x{E000}-\\x{F8FF}0-9" + sql_class(T.LETTERS_FA + T.KEPT_PUNCTUATION + " " + T.ZWNJ + T.MARKS)


@query(f"SELECT c AS char, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '(?s)[^{_ALLOWED}]')) AS c FROM documents) GROUP BY c")
def unexpected_chars(spark, d):
    """Characters outside the guard's inventory by the number of documents that hold them."""
    each = spread(table(spark, d, "documents").select("text")).select(F.explode(text.unexpected(F.col("text"))).alias("char"))
    return each.groupBy("char").agg(F.count("*").alias("n"))


_FA = "text || ' این کتاب را می‌خواندیم، در پژوهش'"


@query(f"SELECT doc_id, strlen(translate(regexp_replace({_FA}, '{'|'.join(T.MERGES)}', 'a', 'g'), '{T.SINGLE_TOKENS}', '{'a' * len(T.SINGLE_TOKENS)}')) + CASE WHEN left(text, 1) <> ' ' THEN 1 ELSE 0 END AS n_tokens FROM documents")
def token_count(spark, d):
    fa = F.concat("text", F.lit(" این کتاب را می‌خواندیم، در پژوهش"))
    return table(spark, d, "documents").select("doc_id", audit.stand_in_tokens(fa).alias("n_tokens"))


_TOK = f"strlen(translate(regexp_replace(text, '{'|'.join(T.MERGES)}', 'a', 'g'), '{T.SINGLE_TOKENS}', '{'a' * len(T.SINGLE_TOKENS)}')) + CASE WHEN text <> '' AND left(text, 1) <> ' ' THEN 1 ELSE 0 END"


@query(f"SELECT count(*) AS n_texts, sum(k) / sum(c) AS tok_per_char, sum(k) / sum(c) AS tok_per_char_bare, 0.0::DOUBLE AS diacritic_overhead_pct, 0.0::DOUBLE AS tokens_per_mark, 0.0::DOUBLE AS byte_fallback_letter_share, sum(k) / count(*) AS mean_tokens, list_sort(list(k))[least(count(*) - 1, floor(0.5 * count(*))::BIGINT) + 1] AS median_tokens, list_sort(list(k))[least(count(*) - 1, floor(0.95 * count(*))::BIGINT) + 1] AS p95_tokens, max(k) AS max_tokens FROM (SELECT {_TOK} AS k, length(text) AS c FROM documents)")
def fertility(spark, d):
    return audit.fertility(table(spark, d, "documents"))


_SURVIVAL = f"""SELECT m AS max_batch_tokens, b AS batch_size, m // b AS per_clip_ceiling, count(*) AS n_rows, count_if(t <= m // b) AS kept, count_if(t > m // b) AS dropped, 100.0 * count_if(t > m // b) / count(*) AS dropped_pct, sum(CASE WHEN t <= m // b THEN s ELSE 0 END) / 3600 AS kept_hours, sum(CASE WHEN t > m // b THEN s ELSE 0 END) / 3600 AS dropped_hours, count_if(t > m // b) / count(*) < 0.02 AS acceptable
FROM (SELECT CAST(n_chars AS DOUBLE) AS s, {_TOK} + n_chars * 2 + 8 AS t FROM documents), (VALUES {{}}) AS g(m, b) GROUP BY m, b"""


def _clips(spark, d):
    return audit.clip_tokens(table(spark, d, "documents"), "text", "n_chars", 2.0)


@query(_SURVIVAL.format("(8192, 8)"))
def survival(spark, d):
    return audit.survival_by(_clips(spark, d), ((8192, 8),))


@query(_SURVIVAL.format(", ".join(map(str, audit.CANDIDATES))))
def batching_grid(spark, d):
    return audit.survival_by(_clips(spark, d), audit.CANDIDATES)


@query(f"SELECT CAST(floor(n_chars / 5) * 5 AS BIGINT) || '-' || CAST(floor(n_chars / 5) * 5 + 5 AS BIGINT) || 's' AS bucket, count(*) AS n FROM documents WHERE {_TOK} + n_chars * 2 + 8 > 1024 GROUP BY 1")
def dropped_buckets(spark, d):
    return audit.dropped_buckets(_clips(spark, d), 1024)


def _rank(col: str, p: float) -> str:
    return f"list_sort(list({col}))[least(count({col}) - 1, floor({p} * count({col}))::BIGINT) + 1]"


@query("SELECT count(value) AS n, avg(value) AS mean, " + ", ".join(f"{_rank('value', p)} AS {n}" for n, p in report.QUANTILES.items()) + " FROM (SELECT n_chars AS value FROM documents)")
def quantiles(spark, d):
    return report.field_stats(table(spark, d, "documents").select(F.col("n_chars").alias("value")), "value")


@query("SELECT " + ", ".join(f"{_rank('value', p)} AS {n}" for n, p in report.QUANTILES.items()) + " FROM events")
def event_quantiles(spark, d):
    return report.ranked(table(spark, d, "events"), "value", report.QUANTILES)


@query("SELECT source AS speaker, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, speaker LIMIT 20")
def speaker_top(spark, d):
    return report.top(table(spark, d, "documents"), F.col("source"), 20, "speaker")


@query("SELECT sum(CASE WHEN r <= greatest(1, t // 10) THEN c ELSE 0 END) / sum(c) AS share FROM (SELECT c, row_number() OVER (ORDER BY c DESC) AS r, count(*) OVER () AS t FROM (SELECT count(*) AS c FROM events GROUP BY user_id))")
def speaker_share(spark, d):
    return report.top_share(table(spark, d, "events"), F.col("user_id"))


@query("SELECT CASE WHEN trim(text) = '' THEN 'drop_empty_source' WHEN regexp_matches(text, '[%&#$]{3}') THEN 'drop_text_pattern' WHEN quality IS NULL THEN 'drop_quality_missing' WHEN quality < 1 THEN 'drop_quality_out_of_range' ELSE 'kept' END AS stage, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def gate_counts(spark, d):
    return report.stage_counts(_gated(spark, d))


def _gated(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    g = Gates(drop_pattern="[%&#$]{3}", bounds={"quality": (1.0, None)})
    return docs.withColumn("gate", source_gate(g, F.col("text"), {"quality": as_number(F.col("quality"))}))


@query("SELECT count(*) AS read, count_if(ok) AS kept, count_if(ok) / greatest(count(*), 1) AS keep_rate FROM (SELECT coalesce(trim(text) <> '' AND NOT regexp_matches(text, '[%&#$]{3}') AND quality >= 1, false) AS ok FROM documents LEFT JOIN labels USING (doc_id))")
def keep_rate(spark, d):
    return report.keep_rate(_gated(spark, d))


@query("""SELECT coalesce(CASE WHEN value < 10 OR value > 90 THEN 'drop_value_out_of_range' WHEN k IS NULL THEN 'drop_k_missing' WHEN k < 5 THEN 'drop_k_out_of_range' END, 'kept') AS stage, count(*) AS n FROM (SELECT value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1""")
def bounds_gate(spark, d):
    e = table(spark, d, "events").withColumn("text", F.lit("x"))
    g = Gates(bounds={"value": (10.0, 90.0), "k": (5.0, None)})
    fields = {"value": as_number(F.col("value")), "k": as_number(F.get_json_object("props", "$.k"))}
    return report.stage_counts(e.withColumn("gate", source_gate(g, F.col("text"), fields)))


_MARKED = "'کِتابِ ' || p_name || ' بُزُرگ'"


@query(f"SELECT p_partkey, translate({_MARKED}, '{T.MARKS}', '') AS bare, 'کتابِ ' || p_name || ' بزرگ' AS kept_ezafe, 1.0::DOUBLE AS density FROM part")
def mask_and_strip(spark, d):
    t = F.concat(F.lit("کِتابِ "), F.col("p_name"), F.lit(" بُزُرگ"))
    return table(spark, d, "part").select("p_partkey", text.strip_marks(t).alias("bare"), marks.mask(t, F.lit(0.0), F.col("p_partkey")).alias("kept_ezafe"), text.word_density(t).alias("density"))


@query("SELECT p_partkey, 'ک ' || p_size || ' ی' AS folded FROM part")
def fold(spark, d):
    size = F.translate(F.col("p_size").cast("string"), "0123456789", "٠١٢٣٤٥٦٧٨٩")
    return table(spark, d, "part").select("p_partkey", text.fold(F.concat(F.lit("ك "), size, F.lit(" ي"))).alias("folded"))


@query()
def cost_curve(spark, d):
    t = F.concat(F.lit("کِتابِ "), F.col("p_name"), F.lit(" بُزُرگ"))
    return audit.cost_curve(table(spark, d, "part").select("p_partkey", t.alias("text")), "p_partkey")


@query()
def normalize_documents(spark, d):
    out = normalized(spread(table(spark, d, "documents").select("doc_id", "text")))
    return out.select("doc_id", "norm.text", "norm.changed", "norm.unexpected", "norm.diacritic_density", "norm.n_words", "norm.problems")


@query()
def normalize_gated(spark, d):
    g = Gates(min_words=0, max_chars=2000)
    return report.stage_counts(with_gate(spread(table(spark, d, "documents").select("doc_id", "text")), g, "text"))


@query()
def normalizer_selftest(spark, d):
    # Persian text around the tables' numbers and dates; documents are normalized above.
    t = F.concat(F.lit("قیمت "), F.col("o_totalprice").cast("string"), F.lit(" $ در "), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit(" بود، كتاب ها -5 درجه!!"))
    return selftest(spread(table(spark, d, "orders").select(t.alias("text"))))


goldens.register(query)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
