"""Command line: normalize a source to a manifest, build a dataset, try sentences, inspect a source, audit a manifest."""

from __future__ import annotations

import argparse
import json
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.normalizer import Config, normalized
from sokhan.operators import audit
from sokhan.operators.gates import Gates, parse_bounds, with_gate
from sokhan.operators.report import corpus_report
from sokhan.session import expose_package, settled, spread
from sokhan.sources import readers, sinks

#: Adapters that read columns of any name and type, embedded audio among them.
COLUMNAR = ("arrow", "parquet")


def names(value: str) -> list[str]:
    """A list of names, comma by comma."""
    return [n.strip() for n in value.split(",") if n.strip()]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sokhan")
    sub = p.add_subparsers(dest="command", required=True)
    normalize, build, attempt, inspect, check = (sub.add_parser(n) for n in ("normalize", "build", "try", "inspect", "audit"))
    for c in (normalize, build, inspect):
        c.add_argument("--input", required=True, help="a file, pattern, folder or URI")
        c.add_argument("--split", help="a folder of the dataset, or a part of its files' names")
        c.add_argument("--adapter", choices=sorted(readers.READERS), default="jsonl" if c is normalize else None)
    for c in (normalize, build):
        c.add_argument("--text-field", default="text")
        c.add_argument("--audio-field", default="audio")
        c.add_argument("--duration-field", default="duration")
        c.add_argument("--duration-from-audio", action="store_true", help="read a missing duration from the WAV header")
        c.add_argument("--keep-fields", type=names, default=[])
        c.add_argument("--min-field", action="append", default=[], metavar="NAME=V")
        c.add_argument("--max-field", action="append", default=[], metavar="NAME=V")
        c.add_argument("--drop-text-matching", metavar="REGEX")
        c.add_argument("--min-duration", type=float, default=0.0)
        c.add_argument("--max-duration", type=float, default=0.0)
        c.add_argument("--min-words", type=int, default=2)
        c.add_argument("--max-chars", type=int, default=600)
        c.add_argument("--dataset-id", type=int, default=0)
        c.add_argument("--tier", default="core")
        c.add_argument("--report")
    normalize.add_argument("--output")
    normalize.add_argument("--output-arrow", metavar="DIR")
    normalize.add_argument("--audio-root")
    normalize.add_argument("--speaker-field")
    normalize.add_argument("--default-speaker")
    normalize.add_argument("--limit", type=int, default=0)
    normalize.add_argument("--require-audio", action="store_true")
    normalize.add_argument("--no-provenance", action="store_true")
    normalize.add_argument("--selftest", action="store_true")
    build.add_argument("--output-dataset", required=True, metavar="DIR")
    build.add_argument("--sampling-rate", type=int, default=16000)
    build.add_argument("--shard-mb", type=int, default=500)
    build.add_argument("--carry-fields", type=names, default=[])
    build.add_argument("--audio-feature-fields", type=names, default=[])
    build.add_argument("--format", choices=("arrow", "parquet"), default="arrow")
    attempt.add_argument("text", nargs="*", help="sentences; without any they are read from standard input")
    for c in (normalize, build, attempt):
        c.add_argument("--strip-harakat", action="store_true")
        c.add_argument("--keep-parens", action="store_true")
        c.add_argument("--decimal-style", choices=("momayez", "fractional"), default="momayez")
        c.add_argument("--latin-strategy", choices=("escalate", "lexicon", "transliterate"), default="escalate")
    inspect.add_argument("--rows", type=int, default=3)
    check.add_argument("--manifest", required=True)
    check.add_argument("--sample", type=int, default=5000)
    check.add_argument("--seed", type=int, default=0)
    check.add_argument("--tokens-per-second", type=float)
    check.add_argument("--latent-len", type=int)
    check.add_argument("--clip-duration", type=float)
    check.add_argument("--max-batch-tokens", type=int, default=8192)
    check.add_argument("--batch-size", type=int, default=8)
    check.add_argument("--default-duration", type=float)
    check.add_argument("--out")
    return p


def source(a: argparse.Namespace, spark: SparkSession, extra: list[str], carry: list[str] = ()) -> DataFrame:
    """The rows that an adapter reads; columnar ones take any column by name."""
    options = {"text_field": a.text_field, "audio_field": a.audio_field, "duration_field": a.duration_field}
    if getattr(a, "speaker_field", None):
        options["speaker_field"] = a.speaker_field
    if getattr(a, "audio_root", None):
        options["audio_root"] = a.audio_root
    if a.adapter in COLUMNAR:
        options |= {"extra_fields": tuple(extra), "split": a.split, "carry": tuple(carry), "wav": a.duration_from_audio}
    elif a.adapter in ("commonvoice", "trans"):
        options = {k: v for k, v in options.items() if k == "audio_root"}
    return readers.READERS[a.adapter](spark, a.input, **options)


def run(argv: list[str], spark: SparkSession) -> object:
    a = parser().parse_args(argv)
    expose_package(spark)
    if a.command == "inspect":
        return readers.inspect(spark, a.input, a.adapter, a.split, a.rows)
    if a.command == "audit":
        report = audit.audit(spark.read.json(a.manifest), a.sample, a.seed, a.tokens_per_second or audit.measured(a.latent_len, a.clip_duration), a.max_batch_tokens, a.batch_size, a.default_duration)
        if a.out:
            sinks.write_report(report, a.out)
        return report
    config = Config(keep_harakat=not a.strip_harakat, brackets_to_commas=not a.keep_parens, latin_strategy=a.latin_strategy, decimal_style=a.decimal_style)
    if a.command == "try":
        texts = a.text or [line.rstrip("\n") for line in sys.stdin if line.strip()]
        df = normalized(spark.createDataFrame([(t,) for t in texts], "text string"), config=config)
        return [r["norm"].asDict(recursive=True) for r in df.select("norm").collect()]
    build = a.command == "build"
    if build:
        a.adapter = a.adapter or readers.columnar(a.input)
    if a.drop_text_matching:
        re.compile(a.drop_text_matching)
    bounds = parse_bounds(a.min_field, a.max_field)
    wanted = list(dict.fromkeys([*a.keep_fields, *bounds]))
    df = source(a, spark, wanted, a.carry_fields if build else ())
    if not build and a.limit:
        df = df.limit(a.limit)
    df = spread(df).withColumns({f"_field_{n}": F.try_element_at("_extra", F.lit(n)) for n in wanted})
    missing = None
    if not build and a.require_audio:
        df, missing = readers.with_missing_audio(df), "_missing"
    gates = Gates(a.drop_text_matching, bounds, a.min_words, a.max_chars, a.min_duration or None, a.max_duration or None, build_order=build)
    rows = settled(with_gate(df, gates, "text", config, "duration", {n: f"_field_{n}" for n in wanted}, "_error", missing))
    keep = tuple(a.keep_fields)
    if build:
        made = sinks.dataset(rows, a.dataset_id, config.version, keep, tuple(a.carry_fields), a.tier)
        if a.format == "arrow":
            sinks.write_arrow(made, a.output_dataset, a.shard_mb << 20, audio=("audio", *a.audio_feature_fields), sampling_rate=a.sampling_rate)
        else:
            sinks.write_dataset(made, a.output_dataset)
    else:
        manifest = sinks.manifest(rows, a.dataset_id, config.version, not a.no_provenance, keep, a.default_speaker, a.tier)
        if a.output:
            sinks.write_manifest(manifest, a.output)
        if a.output_arrow:
            sinks.write_arrow(sinks.plain(manifest, keep), a.output_arrow, sidecars=False)
    default = getattr(a, "default_speaker", None) or "unknown"
    report = corpus_report(rows, "speaker", "duration", default, config, {n: f"_field_{n}" for n in wanted}, getattr(a, "selftest", False))
    if a.report:
        sinks.write_report(report, a.report)
    return report


def main() -> None:
    print(json.dumps(run(sys.argv[1:], SparkSession.builder.getOrCreate()), ensure_ascii=False, indent=2, default=str))


if __name__ == "__main__":
    main()
