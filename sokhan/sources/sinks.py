"""Writers: manifests as JSON lines, built datasets as Parquet or Arrow shards, reports."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan.operators.gates import as_number


def manifest(df: DataFrame, dataset_id: int, version: str, provenance: bool = True, keep: tuple[str, ...] = (), default_speaker: str | None = None, tier: str | None = None) -> DataFrame:
    """The columns of a manifest in their order; a JSON writer leaves nulls out, so rows are ragged as wanted."""
    cols: list[Column] = [F.col("audio"), F.col("norm.text").alias("text"), F.round("duration", 3).alias("duration"), F.lit(dataset_id).cast("long").alias("dataset_id")]
    if provenance:
        who = F.coalesce(F.nullif(F.col("speaker"), F.lit("")), F.lit(default_speaker))
        cols += [F.col("norm.raw").alias("text_raw"), F.lit(version).alias("norm_version"), F.lit(tier).cast("string").alias("tier"), F.round("norm.diacritic_density", 4).alias("diacritic_density"), who.alias("speaker")]
    for name in dict.fromkeys(keep):
        cols.append(kept_value(F.try_element_at("_extra", F.lit(name))).alias(name))
    return df.filter("gate is null").select(*cols)


def kept_value(v: Column) -> Column:
    """A kept field as a variant: numbers (fractions to four places) as numbers, other text as text."""
    number = as_number(v)
    whole = F.regexp_like(v, F.lit("^[+-]?[0-9]{1,18}$"))
    said = F.when(whole, v.try_cast("long").cast("string")).otherwise(F.round(number, 4).cast("string"))
    return F.coalesce(F.when(number.isNotNull(), F.try_parse_json(said)), v.cast("variant"))


def plain(manifest_rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """A manifest whose kept fields are text, for formats without variants."""
    return manifest_rows.withColumns({k: F.col(f"`{k}`").cast("string") for k in keep}) if keep else manifest_rows


def write_manifest(df: DataFrame, path: str, single: bool = False) -> None:
    """JSON lines; rows without a value lack its key."""
    variants = [f.name for f in df.schema.fields if f.dataType.typeName() == "variant"]
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "true"}) if variants else None
    df = df if line is None else df.select(line.alias("value"))
    writer = (df.coalesce(1) if single else df).write.mode("overwrite")
    writer.json(path) if line is None else writer.text(path)


def dataset(df: DataFrame, dataset_id: int, version: str, keep: tuple[str, ...] = (), carry: tuple[str, ...] = (), tier: str | None = None) -> DataFrame:
    """A built dataset's columns; kept fields become doubles, carried ones (and the audio with them) keep their type."""
    audio = F.col("_audio") if "_audio" in df.columns else F.col("audio")
    cols = [audio.alias("audio"), F.col("norm.text").alias("text"), F.col("norm.raw").alias("text_raw"), F.col("duration").cast("double").alias("duration"), F.lit(dataset_id).cast("long").alias("dataset_id"), F.lit(tier).cast("string").alias("tier"), F.lit(version).alias("norm_version"), F.col("norm.diacritic_density").alias("diacritic_density")]
    taken = {"audio", "text", "text_raw", "duration", "dataset_id", "tier", "norm_version", "diacritic_density"}
    found = {k: as_number(F.try_element_at("_extra", F.lit(k))) for k in dict.fromkeys(keep)} | {c: F.col(f"`_carry_{c}`") for c in dict.fromkeys(carry)}
    for name, value in found.items():
        short = name.rsplit(".", 1)[-1]
        if short in taken or name in carry and f"_carry_{name}" not in df.columns:
            raise ValueError(f"{name} isn't there, or its name is taken")
        taken.add(short)
        cols.append(value.alias(short))
    return df.filter("gate is null").select(*cols)


def write_dataset(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Parquet shards; no row left is an error."""
    if df.isEmpty():
        raise ValueError("no row is left")
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_arrow(df: DataFrame, folder: str, shard_bytes: int = 256 << 20, audio: tuple[str, ...] = ("audio",), sampling_rate: int | None = None, sidecars: bool = True) -> list[str]:
    """Arrow IPC shards in a shared folder (a path or URI), one or more a partition; features in the schema and two sidecar files.

    Shards of an earlier run go only when the new ones are all there; names differ between runs.
    """
    from pyarrow import fs

    uri = folder if "://" in folder else os.path.abspath(folder)
    store, base = fs.FileSystem.from_uri(uri)
    store.create_dir(base)
    features = {f.name: feature(f.dataType.jsonValue(), f.name, audio, sampling_rate) for f in df.schema.fields}
    note, mark = {"huggingface": json.dumps({"info": {"features": features}}, ensure_ascii=False)}, uuid.uuid4().hex[:8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(uri)
        task, k, writer, size, made, name = TaskContext.get(), 0, None, 0, [], ""

        def close() -> None:
            writer.close()
            out.close()
            store.move(f"{base}/{name}.{task.taskAttemptId()}.tmp", f"{base}/{name}")
            made.append(name)

        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                name = f"data-{mark}-{task.partitionId():05d}-{k:05d}.arrow"
                out = store.open_output_stream(f"{base}/{name}.{task.taskAttemptId()}.tmp")
                writer, size = pa.ipc.new_stream(out, b.schema.with_metadata(note)), 0
            writer.write_batch(b)
            size += b.nbytes
            if size >= shard_bytes:
                close()
                writer, k = None, k + 1
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(made, pa.string())})

    names = sorted(r["name"] for r in df.mapInArrow(run, "name string").collect())
    if not names:
        raise ValueError("no row is left")
    for f in store.get_file_info(fs.FileSelector(base)):
        if f.base_name.startswith("data-") and f.base_name not in names:
            store.delete_file(f.path)
    if sidecars:
        for name, content in (("dataset_info.json", {"features": features}), ("state.json", {"_data_files": [{"filename": n} for n in names], "_split": "train"})):
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(json.dumps(content, ensure_ascii=False).encode())
    return names


def feature(kind: dict | str, name: str = "", audio: tuple[str, ...] = ("audio",), sampling_rate: int | None = None) -> dict | list:
    """A column's feature: audio by name or shape, else its parts or its plain type."""
    if isinstance(kind, str):
        return {"dtype": {"long": "int64", "integer": "int32", "short": "int16", "byte": "int8", "double": "float64", "float": "float32", "boolean": "bool"}.get(kind, kind), "_type": "Value"}
    if kind["type"] == "struct":
        parts = {f["name"]: f["type"] for f in kind["fields"]}
        if name in audio or set(parts) == {"bytes", "path"}:
            return {"_type": "Audio"} | ({"sampling_rate": sampling_rate} if sampling_rate else {})
        return {n: feature(t, n, audio, sampling_rate) for n, t in parts.items()}
    return [feature(kind["elementType"], "", audio, sampling_rate)]


def write_report(report: dict, path: str) -> None:
    with open(path, "w") as f:
        json.dump(report, f, ensure_ascii=False, indent=2, default=str)
