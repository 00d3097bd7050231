"""Declared table contracts: columns, partitioning, rules and governance tags.

The contracts ship as JSON files next to this module. A contract of one's own
can be given as a dict with the same keys, or as a YAML file if PyYAML is there.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

HERE = Path(__file__).parent
LAYERS = ("bronze", "silver", "gold", "entities")
USER_IDENTIFIER = "privacy:user_identifier"

# Contract type name -> Spark type.
_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "TEXT": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type of a contract type such as ``TIMESTAMP(6)`` or ``DECIMAL(10,2)``."""
    base, args = re.fullmatch(r"\s*(\w+)\s*(?:\(([\d\s,]+)\))?\s*", name.upper()).groups()
    if base in ("DECIMAL", "NUMERIC"):
        precision, scale = (int(a) for a in args.split(","))
        return T.DecimalType(precision, scale)
    return _TYPES[base]


def _columns(schema: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """The columns of a flat schema, or of the one table of a nested one."""
    tables = [c for c in schema if "properties" in c]
    if len(tables) > 1:
        raise ValueError("a contract describes one table")
    return tables[0]["properties"] if tables else schema


def _column(column: dict[str, Any]) -> dict[str, Any]:
    """``physicalType`` is another name of the type, ``unique`` another form of the rule."""
    column = {**column, "type": column.get("type") or column["physicalType"]}
    if column.get("unique"):
        column["quality"] = [*column.get("quality", ()), {"type": "uniqueness"}]
    return column


@dataclass(frozen=True)
class Contract:
    id: str
    columns: tuple[dict[str, Any], ...]
    partition_by: tuple[str, ...] = ()
    rules: tuple[dict[str, Any], ...] = ()
    servers: tuple[dict[str, Any], ...] = ()
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, spec: dict[str, Any]) -> Contract:
        columns = tuple(_column(c) for c in _columns(spec["schema"]))
        keyed = sorted(
            (c for c in columns if "partitionKeyPosition" in c),
            key=lambda c: c["partitionKeyPosition"],
        )
        return cls(
            id=spec["id"],
            columns=columns,
            partition_by=tuple(spec.get("partitioning") or [c["name"] for c in keyed]),
            rules=tuple(spec.get("quality", ())),
            servers=tuple(spec.get("servers", ())),
            properties={p["property"]: p["value"] for p in spec.get("customProperties", ())},
        )

    @cached_property
    def schema(self) -> T.StructType:
        """Columns as nullable Spark fields; ``required`` and tags are field metadata.

        The fields stay nullable so that a missing value reaches the rules
        instead of failing the read.
        """
        return T.StructType([
            T.StructField(
                c["name"],
                spark_type(c["type"]),
                True,
                {"required": bool(c.get("required")), "tags": list(c.get("tags", ()))},
            )
            for c in self.columns
        ])

    @property
    def names(self) -> list[str]:
        return [c["name"] for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c["name"] for c in self.columns if c.get("required")]

    def tagged(self, tag: str) -> list[str]:
        return [c["name"] for c in self.columns if tag in c.get("tags", ())]

    @property
    def primary_key(self) -> list[str]:
        return self.tagged("governance:primary_key")

    def server(self, kind: str) -> dict[str, Any]:
        for server in self.servers:
            if server["type"] == kind:
                return server
        raise KeyError(f"{self.id} declares no {kind!r} server")

    def property(self, name: str, default: str | None = None) -> str:
        if name in self.properties:
            return self.properties[name]
        if default is None:
            raise KeyError(f"{self.id} declares no property {name!r}")
        return default


def load(name: str) -> Contract:
    """Shipped contract by name, e.g. ``gold.user_360``."""
    path = HERE / f"{name}.json"
    if not path.exists():
        raise FileNotFoundError(f"no contract {name!r} in {HERE}")
    return Contract.from_dict(json.loads(path.read_text()))


def load_file(path: str | Path) -> Contract:
    """Contract from a JSON file, or from YAML when PyYAML is installed."""
    text = Path(path).read_text()
    if str(path).endswith(".json"):
        return Contract.from_dict(json.loads(text))
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML contracts needs PyYAML") from missing
    return Contract.from_dict(yaml.safe_load(text))


def all_contracts() -> dict[str, Contract]:
    return {p.stem: load(p.stem) for p in sorted(HERE.glob("*.json"))}


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns of the contract, in its order and types; absent ones become NULL."""
    present = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in contract.schema
    ])


def _keyed_digest(text: Column, secret: bytes) -> Column:
    """HMAC with SHA-256, as text."""
    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in key)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text.cast("binary")), 256))), 256)


def mask(df: DataFrame, contract: Contract, secret: bytes, tag: str = USER_IDENTIFIER) -> DataFrame:
    """Replace every column carrying ``tag`` by its digest under ``secret``.

    Ids are few enough to hash them all, so a digest without a key would hide
    nothing. Equal ids stay equal under one secret; keep it with the other secrets.
    """
    if not secret:
        raise ValueError("masking needs a secret")
    digests = {
        name: _keyed_digest(F.col(name).cast("string"), secret)
        for name in contract.tagged(tag)
        if name in df.columns
    }
    return df.withColumns(digests)


def breaking_changes(old: Contract, new: Contract) -> list[str]:
    """Why readers of ``old`` could not read ``new``; empty when compatible.

    A new optional column is compatible. A dropped or retyped column, a new
    required column and another partitioning are not.
    """
    before = {c["name"]: c for c in old.columns}
    after = {c["name"]: c for c in new.columns}
    problems = [f"dropped column {n}" for n in before if n not in after]
    for name, column in after.items():
        if name not in before:
            if column.get("required"):
                problems.append(f"new column {name} is required")
        elif spark_type(before[name]["type"]) != spark_type(column["type"]):
            problems.append(f"column {name} changed {before[name]['type']} to {column['type']}")
        elif column.get("required") and not before[name].get("required"):
            problems.append(f"column {name} became required")
    if old.partition_by != new.partition_by:
        problems.append("partitioning changed")
    return problems


def bootstrap(spark: SparkSession, root: str, contracts: dict[str, Contract] | None = None) -> list[str]:
    """Create the layer databases and their Parquet tables below ``root`` if absent.

    A contract's properties become table properties under ``contract.``, as some names belong to Spark.
    """
    created = []
    for name, contract in (contracts or all_contracts()).items():
        layer, table = name.split(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.schema)
        partitioned = f"PARTITIONED BY ({', '.join(contract.partition_by)})" if contract.partition_by else ""
        pairs = ", ".join("'contract.{}' = '{}'".format(*(str(x).replace("'", "\\'") for x in p)) for p in contract.properties.items())
        properties = f" TBLPROPERTIES ({pairs})" if pairs else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} "
            f"LOCATION '{root}/{layer}/{table}'{properties}"
        )
        created.append(name)
    return created
