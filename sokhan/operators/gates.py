"""The gate chain: the first gate that a row fails names its reason; null means kept."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sokhan.functions.text import strip

NUMBER = r"^[+-]?(?:[0-9](?:_?[0-9])*\.?(?:[0-9](?:_?[0-9])*)?|\.[0-9](?:_?[0-9])*)(?:[eE][+-]?[0-9]+)?$|^[+-]?(?i:nan|inf|infinity)$"


def as_number(c: Column, kind: T.DataType | None = None) -> Column:
    """A number from a number or numeric text; booleans and other text are null."""
    if isinstance(kind, T.BooleanType):
        return F.lit(None).cast("double")
    s = strip(c.cast("string"))
    return F.when(F.regexp_like(s, F.lit(NUMBER)), F.regexp_replace(s, "_", "").try_cast("double"))


def as_duration(c: Column, kind: T.DataType | None = None) -> Column:
    """As as_number, but zero is unknown."""
    return F.nullif(as_number(c, kind), F.lit(0.0))


def parse_bounds(minimum: list[str] = (), maximum: list[str] = ()) -> dict[str, tuple[float | None, float | None]]:
    """NAME=VALUE lists to bounds by name, in the order given."""
    out: dict[str, list[float | None]] = {}
    for k, specs in enumerate((minimum, maximum)):
        for spec in specs:
            name, sep, value = spec.partition("=")
            try:
                out.setdefault(name.strip(), [None, None])[k] = float(value)
            except ValueError:
                sep = ""
            if not (name.strip() and sep):
                raise ValueError(f"NAME=VALUE is wanted, not {spec!r}")
    return {n: tuple(b) for n, b in out.items()}


@dataclass(frozen=True)
class Gates:
    """Limits of the chain; ``build_order`` judges durations before texts are normalized."""

    drop_pattern: str | None = None
    bounds: dict = field(default_factory=dict)
    min_words: int = 2
    max_chars: int = 600
    min_duration: float | None = None
    max_duration: float | None = None
    build_order: bool = False


def first_of(*gates: tuple[Column, str | Column]) -> Column:
    """The name of the first condition that holds."""
    return F.coalesce(*(F.when(cond, name if isinstance(name, Column) else F.lit(name)) for cond, name in gates), F.lit(None).cast("string"))


def duration_gates(g: Gates, duration: Column) -> list[tuple[Column, str]]:
    out = []
    if g.min_duration is not None or g.max_duration is not None:
        out.append((duration.isNull(), "drop_duration_unknown"))
    if g.min_duration is not None:
        out.append((duration < g.min_duration, "drop_too_short_audio"))
    if g.max_duration is not None:
        out.append(((duration > g.max_duration) & ~F.isnan(duration), "drop_too_long_audio"))
    return out


def source_gate(g: Gates, text: Column, fields: dict[str, Column], error: Column | None = None, duration: Column | None = None) -> Column:
    """Gates that need no normalized text: errors, empty texts, a pattern, bounds of fields."""
    gates = [] if error is None else [(error.isNotNull(), error)]
    gates.append((F.coalesce(strip(text), F.lit("")) == "", "drop_empty_source"))
    if g.drop_pattern:
        gates.append((F.regexp_like(text, F.lit(g.drop_pattern)), "drop_text_pattern"))
    for name, (low, high) in g.bounds.items():
        v = fields[name]
        gates.append((v.isNull(), f"drop_{name}_missing"))
        inside = F.lit(True)
        if low is not None:
            inside &= (v >= low) | F.isnan(v)
        if high is not None:
            inside &= (v <= high) | F.isnan(v)
        gates.append((~inside, f"drop_{name}_out_of_range"))
    if g.build_order and duration is not None:
        gates += duration_gates(g, duration)
    return first_of(*gates)


def result_gate(g: Gates, norm_text: Column, n_words: Column, duration: Column | None = None, missing_audio: Column | None = None) -> Column:
    """Gates on the normalized text, then durations, then missing files."""
    gates = [(strip(norm_text) == "", "drop_empty_after_norm")]
    if g.min_words:
        gates.append((n_words < g.min_words, "drop_too_short"))
    if g.max_chars:
        gates.append((F.length(norm_text) > g.max_chars, "drop_too_long"))
    if duration is not None and not g.build_order:
        gates += duration_gates(g, duration)
    if missing_audio is not None:
        gates.append((missing_audio, "drop_missing_audio"))
    return first_of(*gates)


def with_gate(df: DataFrame, g: Gates, text_col: str, config=None, duration: str | None = None, fields: dict[str, str] | None = None, error: str | None = None, missing_audio: str | None = None) -> DataFrame:
    """df with norm and gate, in one pass. Rows that fail a source gate have no norm: they are not normalized.

    ``fields`` says which column holds a bounded field, if it isn't named alike.
    """
    from sokhan.normalizer import Config, normalized

    types = {f.name: f.dataType for f in df.schema.fields}
    d = as_duration(F.col(duration), types.get(duration)) if duration else None
    held = {n: (fields or {}).get(n, n) for n in g.bounds}
    values = {n: as_number(F.col(f"`{c}`"), types.get(c)) for n, c in held.items()}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    early = df.withColumn("gate", source_gate(g, text, values, F.col(error) if error else None, d))
    passed = "_passed"
    while passed in df.columns:
        passed = "_" + passed
    # A null text costs the rules nothing.
    rows = normalized(early.withColumn(passed, F.when(F.col("gate").isNull(), text)), passed, config or Config()).drop(passed)
    norm = F.when(F.col("gate").isNull(), F.col("norm"))
    late = result_gate(g, F.col("norm.text"), F.col("norm.n_words"), d, F.col(missing_audio) if missing_audio else None)
    return rows.withColumns({"norm": norm, "gate": F.coalesce("gate", late)})
