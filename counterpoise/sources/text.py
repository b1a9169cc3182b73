"""Text sources: KEEL (header + data) and plain labelled CSV lines.

Data lines are parsed with built-in expressions (``split``, ``trim``, casts,
``array_position``) — no per-row Python.  A field that does not parse becomes
NULL and its row goes to the ``rejected`` frame instead of failing the job.

KEEL header layout::

    @relation name
    @attribute f0 real [0.0, 1.0]
    @attribute n integer [1, 9]
    @attribute colour {red, green}
    @attribute class {0, 1}
    @inputs f0, n, colour
    @outputs class
    @data

Only the header (one line per attribute) is read on the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL, with_dim
from counterpoise.operators.index import with_content_id

_ATTR = re.compile(r"@attribute\s+('[^']*'|\S+)\s+(.*)$", re.IGNORECASE)
_RANGE = re.compile(r"^(real|integer|numeric)\s*(?:\[\s*([^,\]]+)\s*,\s*([^\]]+)\s*\])?\s*$", re.IGNORECASE)


@dataclass
class Attribute:
    name: str
    kind: str  # real | integer | nominal
    lo: float | None = None
    hi: float | None = None
    values: list[str] = field(default_factory=list)


@dataclass
class KeelHeader:
    relation: str
    attributes: list[Attribute]
    inputs: list[str]
    outputs: list[str]

    def attribute(self, name: str) -> Attribute:
        return next(a for a in self.attributes if a.name == name)

    @property
    def class_attribute(self) -> Attribute:
        return self.attribute(self.outputs[0]) if self.outputs else self.attributes[-1]

    @property
    def num_classes(self) -> int:
        """Size of the class attribute's nominal list (``getNumClassFromHeader``)."""
        return len(self.class_attribute.values)

    def lines(self) -> list[str]:
        out = [f"@relation {self.relation}"]
        for a in self.attributes:
            if a.kind == "nominal":
                out.append(f"@attribute {a.name} {{{', '.join(a.values)}}}")
            else:
                span = f" [{a.lo!r}, {a.hi!r}]" if a.lo is not None and a.hi is not None else ""
                out.append(f"@attribute {a.name} {a.kind}{span}")
        out.append(f"@inputs {', '.join(self.inputs)}")
        out.append(f"@outputs {', '.join(self.outputs)}")
        out.append("@data")
        return out


def parse_keel_header(lines: list[str]) -> KeelHeader:
    relation, attrs, inputs, outputs = "", [], [], []
    for raw in lines:
        line = raw.strip()
        low = line.lower()
        if not line or line.startswith("%"):
            continue
        if low.startswith("@data"):
            break
        if low.startswith("@relation"):
            relation = line.split(None, 1)[1] if " " in line else ""
        elif low.startswith("@attribute"):
            m = _ATTR.match(line)
            if not m:
                raise ValueError(f"bad attribute line: {raw!r}")
            name, spec = m.group(1).strip("'"), m.group(2).strip()
            if spec.startswith("{"):
                vals = [v.strip() for v in spec.strip("{}").split(",") if v.strip()]
                attrs.append(Attribute(name, "nominal", values=vals))
            else:
                r = _RANGE.match(spec)
                if not r:
                    raise ValueError(f"bad attribute type: {raw!r}")
                kind = "integer" if r.group(1).lower() == "integer" else "real"
                lo = float(r.group(2)) if r.group(2) else None
                hi = float(r.group(3)) if r.group(3) else None
                attrs.append(Attribute(name, kind, lo, hi))
        elif low.startswith("@inputs"):
            inputs = [v.strip() for v in line.split(None, 1)[1].split(",")]
        elif low.startswith("@outputs"):
            outputs = [v.strip() for v in line.split(None, 1)[1].split(",")]
    if not outputs and attrs:
        outputs = [attrs[-1].name]
    if not inputs:
        inputs = [a.name for a in attrs if a.name not in outputs]
    return KeelHeader(relation, attrs, inputs, outputs)


def read_keel_header(spark: SparkSession, path: str) -> KeelHeader:
    """The lines up to ``@data``.  ``take`` reads the file's first split in growing steps and stops there."""
    n = 64
    while True:
        lines = [r["value"] for r in spark.read.text(path).limit(n).collect()]
        if len(lines) < n or any(line.strip().lower().startswith("@data") for line in lines):
            return parse_keel_header(lines)
        n *= 4


def _value(field_col, a: Attribute, scale: bool):
    raw = F.trim(field_col)
    if a.kind == "nominal":
        pos = F.array_position(F.array(*[F.lit(v) for v in a.values]), raw)
        return F.when(pos > 0, (pos - 1).cast("double"))
    v = F.when(raw != "?", raw).try_cast("double")
    if scale and a.lo is not None and a.hi is not None:
        return (v - F.lit(a.lo)) / F.lit(a.hi - a.lo) if a.hi > a.lo else F.when(v.isNotNull(), F.lit(0.0))
    return v


def parse_keel_lines(df: DataFrame, header: KeelHeader, scale: bool = True, id_attribute: str | None = None,
                     value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(labelled, rejected)`` from a frame of KEEL data lines."""
    pos = {a.name: i for i, a in enumerate(header.attributes)}
    fields = F.split(F.col(value_col), ",")
    feats = [_value(fields[pos[n]], header.attribute(n), scale) for n in header.inputs if n != id_attribute]
    label = _value(fields[pos[header.class_attribute.name]], header.class_attribute, False)
    parsed = df.select(
        "*",
        F.array(*feats).alias(FEATURES),
        label.alias(LABEL),
        F.size(fields).alias("_n"),
        *([F.trim(fields[pos[id_attribute]]).try_cast("long").alias(ID)] if id_attribute else []),
    )
    ok = (F.col("_n") == len(header.attributes)) & F.col(LABEL).isNotNull()
    ok = ok & (F.size(F.filter(FEATURES, lambda x: x.isNull())) == 0)
    if id_attribute:
        ok = ok & F.col(ID).isNotNull()
    keep = [ID, LABEL, FEATURES] + [c for c in df.columns if c not in (value_col, ID)]
    return parsed.where(ok).select(*keep), parsed.where(~ok).select(*df.columns)


def read_keel(spark: SparkSession, header_path: str, data_path: str | None = None, scale: bool = True,
              id_attribute: str | None = None) -> tuple[DataFrame, DataFrame, KeelHeader]:
    """KEEL dataset -> ``(labelled, rejected, header)``.

    ``data_path`` defaults to the header file itself (data after ``@data``).
    Without ``id_attribute`` the id comes from the line's content (``with_content_id``).
    """
    header = read_keel_header(spark, header_path)
    lines = spark.read.text(data_path or header_path)
    v = F.trim("value")
    lines = lines.where((F.length(v) > 0) & ~v.startswith("@") & ~v.startswith("%"))
    if id_attribute is None:
        lines = with_content_id(lines, ID)
    good, bad = parse_keel_lines(lines, header, scale, id_attribute)
    return good, bad, header


def write_keel(df: DataFrame, header: KeelHeader, path: str, id_attribute: str | None = None) -> None:
    """Write ``path/header`` (one small file) and ``path/data`` (distributed text)."""
    spark = df.sparkSession
    spark.createDataFrame([(line,) for line in header.lines()], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/header")
    cls = header.class_attribute
    label = F.element_at(F.array(*[F.lit(v) for v in cls.values]), F.col(LABEL).cast("int") + 1)
    cols = ([F.col(ID).cast("string")] if id_attribute else []) + [
        F.col(FEATURES)[j].cast("string") for j in range(len(header.inputs) - (1 if id_attribute else 0))
    ]
    df.select(F.concat_ws(",", *cols, label).alias("value")).write.mode("overwrite").text(f"{path}/data")


def header_for(names: list[str], ranges: list[tuple[float, float]], relation: str = "table",
               id_attribute: str | None = None, id_range: tuple[float | None, float | None] = (None, None)) -> KeelHeader:
    attrs = ([Attribute(id_attribute, "integer", *id_range)] if id_attribute else []) + [
        Attribute(n, "real", lo, hi) for n, (lo, hi) in zip(names, ranges)
    ]
    attrs.append(Attribute("class", "nominal", values=["0", "1"]))
    inputs = ([id_attribute] if id_attribute else []) + list(names)
    return KeelHeader(relation, attrs, inputs, ["class"])


def parse_labelled_csv(df: DataFrame, num_fields: int, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Comma-separated doubles, label last -> ``(labelled, rejected)``; other columns are kept.

    Rows with another number of fields than ``num_fields`` (features and label), with a
    field that is no number or with a label other than 0 or 1 are rejected.
    """
    arr = F.transform(F.split(F.col(value_col), ","), lambda s: F.trim(s).try_cast("double"))
    parsed = df.withColumn("_a", arr).withColumn("_n", F.size("_a"))
    parsed = parsed.withColumn(LABEL, F.element_at("_a", -1))
    parsed = parsed.withColumn(FEATURES, F.slice("_a", 1, num_fields - 1))
    ok = (F.col("_n") == num_fields) & F.col(LABEL).isin(0.0, 1.0) & (F.size(F.filter(FEATURES, lambda x: x.isNull())) == 0)
    ok = F.coalesce(ok, F.lit(False))
    rest = [c for c in df.columns if c != value_col]
    good = parsed.where(ok).select(*rest, LABEL, with_dim(F.col(FEATURES), num_fields - 1))
    return good, parsed.where(~ok).select(*df.columns)


def read_labelled_csv(spark: SparkSession, path: str, num_fields: int) -> tuple[DataFrame, DataFrame]:
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return parse_labelled_csv(with_content_id(lines, ID), num_fields)
