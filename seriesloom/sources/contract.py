"""Declarative schema contracts: named column groups that become Spark schemas."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: type names of the contract; any other name means string
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def spark_type(name: str) -> T.DataType:
    return TYPES.get(name.lower(), T.StringType())


@dataclass(frozen=True)
class Contract:
    """Sensor column groups, target columns and the names of the time and tag columns."""

    groups: Mapping[str, Mapping[str, str]]
    target: Mapping[str, str]
    time: str = "dt"
    refined_time: str = "si_dt"
    tag: str = "source_type"
    keys: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, spec: Mapping[str, Mapping], target: Mapping[str, str], **names) -> Contract:
        """A contract from groups as configuration files give them: name to ``type`` and ``columns``. A group
        without a type is double; a column in two groups is an error."""
        groups = {g: dict.fromkeys(s["columns"], s.get("type", "double")) for g, s in spec.items()}
        columns = [c for cols in groups.values() for c in cols]
        if repeated := sorted({c for c in columns if columns.count(c) > 1}):
            raise ValueError(f"in more than one group: {repeated}")
        return cls(groups=groups, target=dict(target), **names)

    @property
    def sensors(self) -> list[str]:
        return [c for cols in self.groups.values() for c in cols]

    def schema(self, layer: str, with_tag: bool = False) -> T.StructType:
        """A new schema for ``sensors``, ``targets`` (raw, time as text) or ``silver`` (time parsed)."""
        sensor = {c: t for cols in self.groups.values() for c, t in cols.items()}
        layers = {
            "sensors": {self.time: "string", **sensor},
            "targets": {self.time: "string", **self.target},
            "silver": {self.refined_time: "timestamp", **self.target, **sensor},
        }
        fields = [T.StructField(c, spark_type(t), True) for c, t in {**self.keys, **layers[layer]}.items()]
        if with_tag:
            fields.append(T.StructField(self.tag, T.StringType(), True))
        return T.StructType(fields)


def check_contract(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences between a frame and a schema, in words; empty when the frame satisfies it."""
    have = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for f in schema.fields:
        if f.name not in have:
            found.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            found.append(f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return found


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with exactly the schema's columns: absent ones NULL, unreadable values NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )
