"""Tables read by their descriptor.

A descriptor is a JSON document that lists tables (``resources``) with their
path, delimiter, fields, primary key and foreign keys. From it come the scan
(explicit schema, header checked) and the checks: rows whose key is not whole,
rows whose key occurs before, and rows without their parent.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import schemas

#: Types of the descriptor's fields; all others are read as text.
TYPES: dict[str, T.DataType] = {"integer": T.IntegerType(), "number": T.DoubleType()}
NAMES = {T.IntegerType(): "integer", T.LongType(): "integer", T.DoubleType(): "number"}


@dataclass(frozen=True)
class Parent:
    table: str
    fields: tuple[str, ...]   # of this table
    keys: tuple[str, ...]     # of the parent


@dataclass(frozen=True)
class Table:
    name: str
    path: str
    schema: T.StructType
    delimiter: str = schemas.DELIMITER
    key: tuple[str, ...] = ()
    parents: tuple[Parent, ...] = field(default_factory=tuple)


def _names(value: str | Sequence[str] | None) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value or ())


def parse(text: str) -> dict[str, Table]:
    """The tables of a descriptor, by name. A key or a parent that names no
    field or table is an error."""
    out = {}
    for res in json.loads(text)["resources"]:
        own = res["schema"]
        fields = T.StructType([T.StructField(f["name"], TYPES.get(f.get("type", "any"), T.StringType())) for f in own["fields"]])
        parents = tuple(Parent(k["reference"]["resource"], _names(k["fields"]), _names(k["reference"]["fields"])) for k in own.get("foreignKeys", ()))
        out[res["name"]] = Table(res["name"], res["path"], fields, res.get("dialect", {}).get("delimiter", schemas.DELIMITER), _names(own.get("primaryKey")), parents)
    for t in out.values():
        known = set(t.schema.names)
        for p in t.parents:
            if p.table not in out or not set(p.keys) <= set(out[p.table].schema.names) or len(p.keys) != len(p.fields):
                raise ValueError(f"{t.name}: no parent {p.table} with {', '.join(p.keys)}")
        if bad := {*t.key, *(f for p in t.parents for f in p.fields)} - known:
            raise ValueError(f"{t.name}: keys of unknown fields {', '.join(sorted(bad))}")
    return out


def render(tables: Sequence[Table]) -> str:
    """The descriptor of ``tables`` as JSON text."""
    def resource(t: Table) -> dict:
        own: dict = {"fields": [{"name": f.name, "type": NAMES.get(f.dataType, "string")} for f in t.schema.fields]}
        if t.key:
            own["primaryKey"] = list(t.key)
        if t.parents:
            own["foreignKeys"] = [{"fields": list(p.fields), "reference": {"resource": p.table, "fields": list(p.keys)}} for p in t.parents]
        return {"name": t.name, "path": t.path, "dialect": {"delimiter": t.delimiter}, "schema": own}

    return json.dumps({"resources": [resource(t) for t in tables]}, ensure_ascii=False)


def read_descriptor(spark: SparkSession, path: str) -> dict[str, Table]:
    """The tables of the descriptor file at ``path``, read through Spark."""
    return parse("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def read_described(spark: SparkSession, table: Table, base: str = "", columns: Sequence[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """The rows of a described table; its files' header must name the
    descriptor's fields in their order."""
    path = f"{base.rstrip('/')}/{table.path}" if base else table.path
    options = {"header": "true", "sep": table.delimiter, "encoding": encoding, "mode": "PERMISSIVE", "enforceSchema": "false"}
    rows = spark.read.schema(table.schema).options(**options).csv(path)
    return rows.select(*columns) if columns else rows


def without_parent(rows: DataFrame, parent: DataFrame, link: Parent) -> DataFrame:
    """The rows whose parent is missing. A row with a null among its fields of
    the key points nowhere and is not one of them. Parent keys are made
    distinct first, so that a repeated one does not multiply anything."""
    keys = parent.select(*[F.col(k).alias(f"_parent_{i}") for i, k in enumerate(link.keys)]).distinct()
    named = rows.where(" AND ".join(f"`{f}` IS NOT NULL" for f in link.fields))
    match = [F.col(f) == F.col(f"_parent_{i}") for i, f in enumerate(link.fields)]
    return named.join(keys, match, "left_anti")


def key_counts(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: n_rows, n_broken (a null in the key), n_repeated (rows beyond
    the first of each key). One grouped count with partial aggregation."""
    whole = " AND ".join(f"`{k}` IS NOT NULL" for k in key)
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.expr(f"NOT ({whole})"), F.col("_n"))), F.lit(0)).alias("n_broken"),
        F.coalesce(F.sum(F.when(F.expr(whole), F.col("_n") - 1)), F.lit(0)).alias("n_repeated"))


def check(spark: SparkSession, tables: dict[str, Table], base: str = "") -> DataFrame:
    """Per table: n_rows, n_broken, n_repeated of its key and n_orphans, rows
    without one of their parents (a row that lacks two counts twice)."""
    none, out = F.lit(0).cast("long"), None
    for t in tables.values():
        rows = read_described(spark, t, base, [f for f in t.schema.names if f in {*t.key, *(f for p in t.parents for f in p.fields)}])
        parts = [key_counts(rows, t.key).withColumn("n_orphans", none)]
        for p in t.parents:
            found = without_parent(rows, read_described(spark, tables[p.table], base, p.keys), p)
            parts.append(found.agg(F.count(F.lit(1)).alias("n_orphans")).select(none.alias("n_rows"), none.alias("n_broken"), none.alias("n_repeated"), "n_orphans"))
        for part in parts:
            part = part.select(F.lit(t.name).alias("table"), *[F.col(c).cast("long").alias(c) for c in part.columns])
            out = part if out is None else out.unionByName(part)
    return out.groupBy("table").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_broken", "n_repeated", "n_orphans")])


# The three tables of the accident statistics, with their keys.
ACCIDENT = Table("accident", "accident", schemas.ACCIDENT_SCHEMA, key=("Onnett_id",))
PARTY = Table("party", "party", schemas.PARTY_SCHEMA, key=("Onnett_id", "Osall_id"),
              parents=(Parent("accident", ("Onnett_id",), ("Onnett_id",)),))
PERSON = Table("person", "person", schemas.PERSON_SCHEMA, key=("Onnett_id", "Osall_id", "Henkilo_id"),
               parents=(Parent("accident", ("Onnett_id",), ("Onnett_id",)), Parent("party", ("Onnett_id", "Osall_id"), ("Onnett_id", "Osall_id"))))
