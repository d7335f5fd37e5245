"""Readers, gates and writers on small files."""

import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sokhan.operators.gates import Gates, parse_bounds, with_gate
from sokhan.operators.report import corpus_report
from sokhan.sources import readers, sinks


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"audio":"a.wav","text":"سلام دنیا","duration":"2.5","mos":3}\n\n{bad\n{"text":"x","duration":0}\n', encoding="utf-8")
    rows = readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), audio_root="/r").collect()
    assert [(r["audio"], r["duration"], r["_extra"].get("mos")) for r in rows if r["_error"] is None] == [("/r/a.wav", 2.5, "3"), (None, None, None)]
    assert sum(r["_error"] is not None for r in rows) == 1


def test_csv_and_trans(spark, tmp_path):
    (tmp_path / "a.csv").write_text('audio,text,duration,mos\na.wav,"x, y",1.5,3\nb.wav,z,,4\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "a.csv")).select("audio", "text", "duration", F.col("_extra")["mos"]).collect()] == [("a.wav", "x, y", 1.5, "3"), ("b.wav", "z", None, "4")]
    (tmp_path / "t.txt").write_text("u1 hello there\nnoblank\n")
    assert [tuple(r) for r in readers.read_trans(spark, str(tmp_path / "t.txt"), "/a").select("audio", "text").collect()] == [("/a/u1.wav", "hello there")]


@pytest.mark.parametrize("kind", ["file", "stream"])
def test_arrow(spark, tmp_path, kind):
    table = pa.table({"audio": pa.array([{"bytes": b"ab", "path": None}, {"bytes": b"c", "path": "p.wav"}]), "text": ["سلام دنیا", "دو"], "duration": [1.0, 2.0]})
    path = str(tmp_path / "a.arrow")
    with (pa.ipc.new_file if kind == "file" else pa.ipc.new_stream)(path, table.schema) as w:
        w.write_table(table)
    rows = readers.read_arrow(spark, path).collect()
    assert [(r["audio"], r["text"]) for r in rows] == [(f"{path}#row=0", "سلام دنیا"), ("p.wav", "دو")]
    with pytest.raises(ValueError, match="audio.path"):
        readers.read_arrow(spark, path, text_field="none")


def test_wav_and_container(spark):
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16)
    head = b"RIFF" + struct.pack("<I", 0) + b"WAVE"
    assert readers.wav_seconds(head + fmt + b"data" + struct.pack("<I", 224000)) == 7.0
    assert readers.wav_seconds(head + b"LIST" + struct.pack("<I", 4) + b"abcd" + fmt + b"data" + struct.pack("<I", 32000)) == 1.0
    assert readers.wav_seconds(b"junk") is None and readers.wav_seconds(None) is None
    df = spark.createDataFrame([(bytearray(b"fLaC1234"),), (bytearray(b"zzzz"),)], "b binary")
    assert [r[0] for r in df.select(readers.container(F.col("b"))).collect()] == ["flac", "unknown:7a7a7a7a"]


def test_bounds():
    assert parse_bounds(["a=1"], ["a=2", "b=3"]) == {"a": (1.0, 2.0), "b": (None, 3.0)}
    for bad in ("a", "a=high", "=3"):
        with pytest.raises(ValueError):
            parse_bounds([bad])


def test_gates_report_and_manifest(spark, tmp_path):
    rows = [("a", "سلام دنیا", 2.0, "s1"), ("b", " ", 2.0, "s1"), ("c", "یک", 2.0, None), ("d", "سلام به همه", 90.0, "s2"), ("e", "سلام به شما", None, "")]
    df = spark.createDataFrame(rows, "audio string, text string, duration double, speaker string").withColumn("_extra", F.create_map().cast("map<string,string>"))
    out = with_gate(df, Gates(max_duration=30.0), "text", duration="duration")
    assert {r["audio"]: r["gate"] for r in out.collect()} == {"a": None, "b": "drop_empty_source", "c": "drop_too_short", "d": "drop_too_long_audio", "e": "drop_duration_unknown"}
    report = corpus_report(out, "speaker", "duration")
    assert report["read"] == 5 and report["kept"] == 1 and report["audio_duration"]["median"] == 2.0
    assert report["frontend_version"] and report["dropped_examples"] == [] and report["audio_duration"]["total_hours"] == 2 / 3600
    sinks.write_manifest(sinks.manifest(out, 1, "v"), str(tmp_path / "m"), single=True)
    assert spark.read.json(str(tmp_path / "m")).count() == 1
    names = sinks.write_arrow(out.filter("gate is null").select("audio", "text"), str(tmp_path / "d"))
    assert len(names) == 1 and (tmp_path / "d" / "state.json").exists()


def test_commands(spark, tmp_path):
    from sokhan.plans.commands import run

    (tmp_path / "a.jsonl").write_text('{"clip":"a.wav","said":"سلام (دنیا) ۵","seconds":"2.5","mos":3.25678,"by":"x","n":7}\n{"clip":"b","said":"یک دو","seconds":1,"mos":1}\n{"bad\n', encoding="utf-8")
    (tmp_path / "a.wav").write_bytes(b"RIFF")
    fields = ["--text-field", "said", "--audio-field", "clip", "--duration-field", "seconds"]
    report = run(["normalize", "--input", str(tmp_path / "a.jsonl"), "--output", str(tmp_path / "out"), "--output-arrow", str(tmp_path / "arrow"), *fields, "--speaker-field", "by", "--audio-root", str(tmp_path), "--require-audio", "--keep-parens", "--min-field", "mos=2", "--keep-fields", "mos,by,n", "--selftest", "--report", str(tmp_path / "r.json")], spark)
    assert report["stages"] == {"kept": 1, "drop_mos_out_of_range": 1, "bad_json": 1}
    assert report["selftest"]["n"] == 1 and report["field_stats"]["mos"]["median"] == 3.25678 and (tmp_path / "r.json").exists()
    import json

    line = json.loads("".join(f.read_text() for f in (tmp_path / "out").glob("part*")))
    assert (line["mos"], line["n"], line["speaker"], line["audio"]) == (3.2568, 7, "x", f"{tmp_path}/a.wav") and "by" not in line
    assert line["text"].startswith("سلام") and line["tier"] == "core"
    gone = run(["normalize", "--input", str(tmp_path / "a.jsonl"), *fields, "--audio-root", str(tmp_path / "none"), "--require-audio"], spark)
    assert gone["stages"] == {"bad_json": 1, "drop_missing_audio": 2}
    assert run(["try", "۵"], spark)[0]["text"] == "پنج"
    assert run(["inspect", "--input", str(tmp_path / "arrow")], spark)["rows"] == 1
    checked = run(["audit", "--manifest", str(tmp_path / "out"), "--tokens-per-second", "25", "--out", str(tmp_path / "audit.json")], spark)
    assert checked["n_rows"] == 1 and checked["survival"]["kept"] == 1 and len(checked["batching_grid"]) == 6 and (tmp_path / "audit.json").exists()


def test_build_keeps_audio_and_types(spark, tmp_path):
    import io
    import json
    import wave

    from sokhan.plans.commands import run

    clip = io.BytesIO()
    with wave.open(clip, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(b"\0\0" * 32000)
    clip = clip.getvalue()
    assert readers.wav_length(clip) == 2.0
    rows = {"audio": pa.array([{"bytes": clip, "path": None}, {"bytes": b"x", "path": "p.wav"}]), "sentence": ["سلام دنیا", "دو سه"], "mos": [4.0, 1.0], "metrics": pa.array([{"tier": "a", "cer": 0.5}, {"tier": "b", "cer": 1.0}])}
    (tmp_path / "in").mkdir()
    import pyarrow.parquet as pq

    pq.write_table(pa.table(rows), tmp_path / "in" / "train-0.parquet")
    pq.write_table(pa.table(rows), tmp_path / "in" / "test-0.parquet")
    options = ["build", "--input", str(tmp_path / "in"), "--adapter", "parquet", "--split", "train", "--text-field", "sentence", "--output-dataset", str(tmp_path / "ds"), "--carry-fields", "metrics,metrics.cer", "--keep-fields", "mos", "--min-field", "mos=3", "--duration-from-audio", "--min-duration", "1"]
    report = run(options, spark)
    assert report["stages"] == {"kept": 1, "drop_mos_out_of_range": 1}
    for _ in range(2):  # a second run replaces the first one's shards
        run(options, spark)
    shards = list((tmp_path / "ds").glob("data-*.arrow"))
    assert len(shards) == 1
    with pa.ipc.open_stream(shards[0]) as f:
        table = f.read_all()
    assert table.column("audio").to_pylist() == [{"bytes": clip, "path": None}] and table.column("duration").to_pylist() == [2.0]
    assert table.column("metrics").to_pylist() == [{"tier": "a", "cer": 0.5}] and table.column("cer").to_pylist() == [0.5] and table.column("mos").to_pylist() == [4.0]
    features = json.loads(table.schema.metadata[b"huggingface"])["info"]["features"]
    assert features["audio"] == {"_type": "Audio", "sampling_rate": 16000} and features == json.loads((tmp_path / "ds" / "dataset_info.json").read_text())["features"]
    run([*options, "--format", "parquet"], spark)
    with pytest.raises(ValueError, match="metrics.tier"):
        readers.read_parquet(spark, str(tmp_path / "in"), carry=("none",), text_field="sentence")


def test_homographs_and_bad_lines(spark, tmp_path):
    from sokhan.functions import marks

    (tmp_path / "h.json").write_text('{"homographs": {"مرد": [{"form": "مَرْد", "ipa": "", "gloss": ""}, {"form": "مُرْد", "ipa": "", "gloss": ""}]}}', encoding="utf-8")
    words = marks.homographs(str(tmp_path / "h.json"))
    df = spark.createDataFrame([(i, "مَرْد کِتاب") for i in range(300)], "id long, t string")
    kept = df.select(marks.mask(F.col("t"), F.lit(0.6), F.col("id"), priority=list(words)).alias("m")).agg(F.count_if(F.startswith("m", F.lit("مَرْد"))), F.count_if(F.endswith("m", F.lit("کِتاب")))).first()
    assert kept[0] == 300 and 120 < kept[1] < 240
    (tmp_path / "b.jsonl").write_text('{bad one\n{bad two\n')
    rows = readers.read_jsonl(spark, str(tmp_path / "b.jsonl")).collect()
    assert [r["_error"] for r in rows] == ["bad_json"] * 2 and {r["_extra"]["bad_line"] for r in rows} == {"{bad one", "{bad two"}
