"""Readers: each gives audio, text, duration, speaker, _extra (a map) and _error."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sokhan.functions.text import S, strip
from sokhan.operators.gates import as_duration, as_number

AUDIO_PATH_FIELDS = ("path", "filename", "file", "audio_path", "audio_filepath")
EXTRA = "map<string,string>"


def rooted(path: Column, root: str | None) -> Column:
    """Under a root unless absolute."""
    return path if not root else F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def shaped(df: DataFrame, audio: Column, text: Column, duration: Column, speaker: Column, extra: Column | None = None, error: Column | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    none = F.lit(None)
    return df.select(audio.alias("audio"), F.coalesce(text, F.lit("")).alias("text"), duration.cast("double").alias("duration"), speaker.alias("speaker"), (F.create_map().cast(EXTRA) if extra is None else extra).alias("_extra"), (none if error is None else error).cast("string").alias("_error"), *(c.alias(n) for n, c in (more or {}).items()))


def read_jsonl(spark: SparkSession, path: str, text_field: str = "text", audio_field: str = "audio", duration_field: str = "duration", speaker_field: str = "speaker", audio_root: str | None = None) -> DataFrame:
    """JSON lines; blank lines are left out, bad ones become rows with an error and the line in _extra; other keys go to _extra."""
    lines = spark.read.text(path).filter(strip(F.col("value")) != "")
    m = F.from_json("value", EXTRA, {"mode": "PERMISSIVE"})
    df = lines.select("value", m.alias("m"), F.try_parse_json("value").isNotNull().alias("good"), F.col("_metadata.file_path").alias("file"))
    used = [text_field, audio_field, duration_field, speaker_field]
    error = F.when(~F.col("good"), F.lit("bad_json"))
    rest = F.coalesce(F.map_filter("m", lambda k, v: ~k.isin(*used)), F.create_map().cast(EXTRA))
    # One code for the counts; the file and the line itself tell which it was.
    bad = F.create_map(F.lit("bad_file"), F.col("file"), F.lit("bad_line"), F.substring("value", 1, 160))
    extra = F.when(F.col("good"), rest).otherwise(bad)
    at = lambda f: F.try_element_at("m", F.lit(f))
    return shaped(df, rooted(at(audio_field), audio_root), at(text_field), as_duration(at(duration_field)), at(speaker_field), extra, error)


def read_csv(spark: SparkSession, path: str, text_field: str = "text", audio_field: str = "audio", duration_field: str = "duration", speaker_field: str = "speaker", audio_root: str | None = None, sep: str = ",", compat: bool = False) -> DataFrame:
    """CSV with a header; other columns go to _extra (with compat, nothing does)."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep).csv(path)
    at = lambda f: F.col(f"`{f}`") if f in df.columns else F.lit(None).cast("string")
    rest = [] if compat else [c for c in df.columns if c not in (text_field, audio_field, duration_field, speaker_field)]
    extra = F.create_map(*(x for c in rest for x in (F.lit(c), F.col(f"`{c}`")))) if rest else None
    return shaped(df, rooted(at(audio_field), audio_root), at(text_field), as_number(at(duration_field)), at(speaker_field), extra)


def read_tsv(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv(spark, path, sep="\t", **kw)


def read_commonvoice(spark: SparkSession, path: str, audio_root: str | None = None) -> DataFrame:
    """The fixed columns path, sentence, client_id; votes and accents go to _extra."""
    df = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    at = lambda f: F.col(f) if f in df.columns else F.lit(None).cast("string")
    accents = F.coalesce(F.nullif(at("accents"), F.lit("")), at("accent"))
    extra = F.create_map(F.lit("up_votes"), at("up_votes"), F.lit("down_votes"), at("down_votes"), F.lit("accents"), accents)
    return shaped(df, rooted(at("path"), audio_root), at("sentence"), F.lit(None).cast("double"), at("client_id"), extra)


def read_trans(spark: SparkSession, path: str, audio_root: str | None = None) -> DataFrame:
    """Lines of an utterance's name and its text; lines without a blank are left out."""
    df = spark.read.text(path).select(strip(F.col("value")).alias("v"), F.col("_metadata.file_path").alias("f")).filter(F.contains("v", F.lit(" ")))
    name, text = F.substring_index("v", " ", 1), F.regexp_replace("v", "^[^ ]* ", "")
    root = F.lit(audio_root) if audio_root else F.regexp_replace(F.regexp_replace("f", "^file:/+", "/"), "/[^/]*$", "")
    return shaped(df, F.concat(root, F.lit("/"), name, F.lit(".wav")), text, F.lit(None).cast("double"), F.lit(None).cast("string"))


def dotted(schema: T.StructType, name: str) -> Column | None:
    """A column by dotted path, or None."""
    kind: T.DataType = schema
    for part in name.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return None
        kind = kind[part].dataType
    return F.col(".".join(f"`{p}`" for p in name.split(".")))


def dotted_names(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """All dotted paths of a schema."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield prefix + f.name
            yield from dotted_names(f.dataType, f"{prefix}{f.name}.")


def audio_path(schema: T.StructType, name: str) -> Column:
    """The path within an audio column: of a struct its first path field, of bytes none."""
    kind = schema[name].dataType
    if isinstance(kind, T.StructType):
        return next((F.col(name)[f].cast("string") for f in AUDIO_PATH_FIELDS if f in kind.fieldNames()), F.lit(None).cast("string"))
    return F.lit(None).cast("string") if isinstance(kind, T.BinaryType) else F.col(name).cast("string")


def read_columnar(df: DataFrame, locator: Column, text_field: str = "text", audio_field: str = "audio", duration_field: str = "duration", speaker_field: str = "speaker", extra_fields: tuple[str, ...] = (), audio_root: str | None = None, carry: tuple[str, ...] = (), wav: bool = False) -> DataFrame:
    """Shape a Parquet or Arrow table; rows without an audio path get their locator.

    carry: columns to keep with their type, as _carry_<name>, the audio itself among them
    as _audio; wav: durations that are missing are read from the audio's WAV header.
    """
    text = dotted(df.schema, text_field)
    if text is None:
        raise ValueError(f"no column {text_field!r}; there are {', '.join(dotted_names(df.schema))}")
    null = F.lit(None).cast("string")
    audio = audio_path(df.schema, audio_field) if audio_field in df.columns else null
    duration, speaker = (dotted(df.schema, f) for f in (duration_field, speaker_field))
    found = [(f, c) for f in extra_fields if (c := dotted(df.schema, f)) is not None]
    extra = F.create_map(*(x for f, c in found for x in (F.lit(f), c.cast("string")))) if found else None
    seconds = as_duration(null if duration is None else duration)
    blob = audio_bytes(df.schema, audio_field)
    if wav and blob is not None:
        seconds = F.coalesce(seconds, wav_duration(F.substring(blob, 1, 128)))
    kept = {f"_carry_{c}": dotted(df.schema, c) for c in carry}
    if missing := [c for c in carry if kept[f"_carry_{c}"] is None]:
        raise ValueError(f"no column {missing[0]!r}; there are {', '.join(dotted_names(df.schema))}")
    if carry and audio_field in df.columns:
        kept["_audio"] = F.col(audio_field)
    out = shaped(df, F.coalesce(rooted(audio, audio_root), locator), text.cast("string"), seconds, null if speaker is None else speaker.cast("string"), extra, more=kept)
    return out


def audio_bytes(schema: T.StructType, name: str) -> Column | None:
    """The bytes within an audio column, if it has any."""
    kind = schema[name].dataType if name in schema.fieldNames() else None
    if isinstance(kind, T.StructType) and "bytes" in kind.fieldNames():
        return F.col(name)["bytes"]
    return F.col(name) if isinstance(kind, T.BinaryType) else None


def read_parquet(spark: SparkSession, path: str, split: str | None = None, **kw) -> DataFrame:
    df = parquet_of(spark, path, split)
    return read_columnar(df, F.concat(F.col("_metadata.file_path"), F.lit("#row="), F.col("_metadata.row_index")), **kw)


def parquet_of(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Parquet files of a dataset; a split is a folder of it, or else a part of the files' names."""
    if split is None:
        return spark.read.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, split)
    if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return spark.read.parquet(folder.toString())
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{split}*").parquet(path)


class ArrowFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def open_ipc(path: str):
    """A reader of either encoding of Arrow IPC."""
    source = pa.memory_map(path)
    try:
        return pa.ipc.open_file(source)
    except pa.ArrowInvalid:
        return pa.ipc.open_stream(pa.memory_map(path))


class ArrowReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[ArrowFile]:
        return [ArrowFile(p) for p in self.paths]

    def read(self, partition: ArrowFile) -> Iterator[pa.RecordBatch]:
        r, row = open_ipc(partition.path), 0
        batches = (r.get_batch(i) for i in range(r.num_record_batches)) if hasattr(r, "num_record_batches") else r
        for b in batches:
            locators = pa.array([f"{partition.path}#row={row + i}" for i in range(b.num_rows)], pa.string())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, locators], [*b.schema.names, "_locator"])


class ArrowSource(DataSource):
    """format("arrow_ipc"): paths joined by commas; each row gets a _locator."""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def paths(self) -> list[str]:
        return self.options["path"].split(",")

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        return from_arrow_schema(open_ipc(self.paths()[0]).schema).add("_locator", T.StringType())

    def reader(self, schema: T.StructType) -> ArrowReader:
        return ArrowReader(self.paths())


def arrow_of(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Arrow IPC files, one partition each, with a _locator."""
    spark.dataSource.register(ArrowSource)
    return spark.read.format("arrow_ipc").load(",".join(fragments(path, split)))


def read_arrow(spark: SparkSession, path: str, split: str | None = None, **kw) -> DataFrame:
    """Arrow IPC files of a folder that driver and executors share."""
    df = arrow_of(spark, path, split)
    return read_columnar(df, F.col("_locator"), **kw)


def fragments(path: str, split: str | None = None) -> list[str]:
    """The files of a dataset: a file, a pattern, or a folder walked in order; .arrow comes before .parquet."""
    import glob

    if os.path.isfile(path):
        return [path]
    if any(c in path for c in "*?["):
        found = sorted(glob.glob(path))
    else:
        top = os.path.join(path, split) if split and os.path.isdir(os.path.join(path, split)) else path
        walked = [os.path.join(d, f) for d, _, files in os.walk(top) for f in sorted(files) if not f.startswith(".")]
        found = next((x for kind in (".arrow", ".parquet") if (x := sorted(f for f in walked if f.endswith(kind)))), [])
        if split and top == path:
            found = [f for f in found if split in os.path.basename(f)]
    if not found:
        raise FileNotFoundError(f"no data files under {path}")
    return found


def wav_seconds(head: bytes | None) -> float | None:
    """Length of a clip from the first bytes of a WAV file, by walking its chunks."""
    if not head or len(head) < 12 or head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None
    at, rate = 12, None
    while at + 8 <= len(head):
        name, size = head[at : at + 4], struct.unpack_from("<I", head, at + 4)[0]
        if name == b"fmt " and at + 24 <= len(head):
            _, channels, hz, _, _, bits = struct.unpack_from("<HHIIHH", head, at + 8)
            rate = hz * channels * (bits // 8)
        elif name == b"data":
            return size / rate if rate else None
        at += 8 + size + size % 2
    return None


@F.arrow_udf(T.DoubleType())
def wav_duration(heads: pa.Array) -> pa.Array:
    """Seconds of WAV clips; pass F.substring(bytes, 1, 128)."""
    return pa.array([wav_seconds(h) for h in heads.to_pylist()], pa.float64())


def container(data: Column) -> Column:
    """The audio container by its first bytes."""
    head = F.hex(F.substring(data, 1, 8))
    kinds = (("52494646", "wav"), ("664C6143", "flac"), ("4F676753", "ogg"), ("FFFB", "mp3"), ("FFF3", "mp3"), ("FFF2", "mp3"), ("494433", "mp3"), ("0000002066747970", "m4a"))
    out = F.concat(F.lit("unknown:"), F.lower(head))
    for magic, name in reversed(kinds):
        out = F.when(F.startswith(head, F.lit(magic)), F.lit(name)).otherwise(out)
    return out


def describe(df: DataFrame, n: int = 3, width: int = 160) -> dict:
    """Schema, row count and the first rows, bytes as their size and texts cut."""
    shown = [F.concat(F.lit("<"), F.length(f.name), F.lit(" bytes>")).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.substring(F.col(f.name).cast("string"), 1, width).alias(f.name) for f in df.schema.fields]
    return {"schema": df.schema.simpleString(), "rows": df.count(), "first": [r.asDict() for r in df.select(*shown).limit(n).collect()]}


def columnar(path: str) -> str:
    """The adapter for a columnar source, by its first file's name."""
    return "arrow" if "://" not in path and fragments(path)[0].endswith(".arrow") else "parquet"


def inspect(spark: SparkSession, path: str, adapter: str | None = None, split: str | None = None, n: int = 3) -> dict:
    """Files, schema, row count and first rows of a source."""
    adapter = adapter or columnar(path)
    if adapter in ("arrow", "parquet"):
        df = (arrow_of if adapter == "arrow" else parquet_of)(spark, path, split)
    else:
        df = READERS[adapter](spark, path)
    files = fragments(path, split) if adapter == "arrow" else sorted(df.inputFiles())
    return {"files": files} | describe(df.drop("_locator"), n)


def with_missing_audio(df: DataFrame) -> DataFrame:
    """df with _missing: whether the file that audio names isn't there; locators into a dataset's own files always are.

    The folders that are named are listed by Spark's reader, on executors, and joined by path.
    """
    plain = F.regexp_replace("audio", "^file:/*(?=/)", "")
    folders = [r[0] for r in df.filter(F.col("audio").isNotNull() & ~F.contains("audio", F.lit("#row="))).select(F.regexp_replace(plain, "/[^/]*$", "").alias("d")).distinct().collect()]
    spark, there = df.sparkSession, None
    for folder in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder or "/")
        if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
            listed = spark.read.format("binaryFile").load(at.toString()).select(F.regexp_replace("path", "^file:/*(?=/)", "").alias("_there"))
            there = listed if there is None else there.unionByName(listed)
    if there is None:
        return df.withColumn("_missing", F.col("audio").isNull() | ~F.contains("audio", F.lit("#row=")))
    found = df.withColumn("_at", plain).join(there.distinct(), F.col("_at") == F.col("_there"), "left")
    return found.withColumn("_missing", F.col("_there").isNull() & ~F.coalesce(F.contains("audio", F.lit("#row=")), F.lit(False))).drop("_at", "_there")


def wav_length(data: bytes) -> float:
    """Seconds of a whole WAV file, by decoding it."""
    import io
    import wave

    with wave.open(io.BytesIO(data)) as w:
        return w.getnframes() / w.getframerate()


READERS = {"jsonl": read_jsonl, "csv": read_csv, "tsv": read_tsv, "commonvoice": read_commonvoice, "trans": read_trans, "arrow": read_arrow, "parquet": read_parquet}
