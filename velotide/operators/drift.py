"""Drift of the payload: fields nobody declared, and fields of another type than declared.

The decoder reads declared fields only, and a field of the wrong type becomes NULL.
So a feed that changes goes on loading, with less and less in its columns.  Here every
payload's own schema is taken (as a VARIANT), equal ones are counted, and what the
few different ones hold is compared with the declaration, path by path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide import schemas

UNKNOWN, RETYPED, MISSING, UNREADABLE = "unknown", "retyped", "missing", "unreadable"
#: Fields of the feed that are known and not used.
UNUSED = ("last_updated", "ttl", "version")
#: The types a payload may hold for each declared one; VOID is an explicit null.
FITTING = {
    "int": ["BIGINT"],
    "bigint": ["BIGINT"],
    "double": ["DOUBLE", "DECIMAL", "BIGINT"],
    "string": ["STRING"],
    "boolean": ["BOOLEAN"],
    "struct": ["OBJECT"],
    "array": ["ARRAY"],
}


def declared_paths(schema: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, type) of a declared schema; ``[]`` stands for the elements of an array."""
    own = [(path, schema.typeName() if isinstance(schema, T.StructType | T.ArrayType) else schema.simpleString())]
    if isinstance(schema, T.StructType):
        below = [declared_paths(f.dataType, f"{path}.{f.name}".lstrip(".")) for f in schema]
        return own + [p for paths in below for p in paths]
    if isinstance(schema, T.ArrayType):
        return own + declared_paths(schema.elementType, f"{path}[]")
    return own


def paths_of(shape: str) -> list[tuple[str, str]]:
    """(path, type) of the text that ``schema_of_variant`` gives for a value."""
    out: list[tuple[str, str]] = []

    def walk(at: int, path: str) -> int:
        kind = re.compile(r"[A-Z_]+").match(shape, at)[0]
        out.append((path, kind))
        at += len(kind)
        if kind == "OBJECT":
            at += 1
            while shape[at] != ">":
                name = re.compile(r"`(?:[^`]|``)*`|[^:]+").match(shape, at)[0]
                plain = name[1:-1].replace("``", "`") if name.startswith("`") else name
                at = walk(at + len(name) + 2, f"{path}.{plain}".lstrip("."))
                at += 2 if shape.startswith(", ", at) else 0
            return at + 1
        if kind == "ARRAY":
            return walk(at + 1, f"{path}[]") + 1
        return re.compile(r"(\([^)]*\))?").match(shape, at).end()

    walk(0, "")
    return out


def payload_shapes(payloads: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, shape, payloads): how many payloads have each schema; NULL for what is no JSON.

    Counted within tasks first, so little travels however many payloads there are.
    """
    parsed = F.try_parse_json(F.col("value").cast("string"))
    return payloads.groupBy(*by, F.schema_of_variant(parsed).alias("shape")).agg(F.count(F.lit(1)).alias("payloads"))


def schema_drift(
    payloads: DataFrame,
    by: Sequence[str] = (),
    schema: str = schemas.STATUS_PAYLOAD,
    unused: Sequence[str] = UNUSED,
) -> DataFrame:
    """(by, kind, path, declared, found, payloads): where payloads differ from the declaration.

    ``unknown``: a path that is neither declared nor ``unused`` (what is below
    an unused one is unused, too).  ``retyped``: a declared path with a value of a type that does not
    fit; VARIANT says that the elements of one payload's array differ in it.
    ``missing``: a declared path in no payload of its group.  ``unreadable``: no JSON.
    ``payloads`` counts those concerned.
    """
    declared = declared_paths(T.StructType.fromDDL(schema))[1:]
    known = dict(declared)
    shapes = payload_shapes(payloads, by)

    def flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A row per schema and path: a few, whatever the number of payloads.
        for batch in batches:
            found = [paths_of(s) if s else [("$", "")] for s in batch.pop("shape")]
            batch["at"] = found
            rows = batch.explode("at", ignore_index=True)
            rows["path"], rows["found"] = [p for p, _ in rows["at"]], [t for _, t in rows["at"]]
            yield rows.drop(columns="at")

    fields = [T.StructField("path", T.StringType()), T.StructField("found", T.StringType())]
    groups = [shapes.schema[c] for c in (*by, "payloads")]
    rows = shapes.select(*by, "payloads", "shape").mapInPandas(flatten, T.StructType([*groups, *fields]))
    counted = rows.where("path != ''").groupBy(*by, "path", "found").agg(F.sum("payloads").alias("payloads"))

    types = F.create_map(*[F.lit(x) for p in declared for x in p])
    fitting = F.create_map(*[x for t, own in FITTING.items() for x in (F.lit(t), F.array(*map(F.lit, own)))])
    counted = counted.withColumn("declared", types[F.col("path")])
    fits = (F.col("found") == "VOID") | F.coalesce(F.array_contains(fitting[F.col("declared")], F.col("found")), F.lit(False))
    passed_over = F.lit(False)
    for name in unused:
        passed_over = passed_over | F.col("path").rlike(rf"^{re.escape(name)}($|[.\[])")
    kind = (
        F.when(F.col("path") == "$", UNREADABLE)
        .when(F.col("declared").isNull() & ~passed_over, UNKNOWN)
        .when(F.col("declared").isNotNull() & ~fits, RETYPED)
    )
    columns = [*by, "kind", "path", "declared", "found", "payloads"]
    differing = counted.withColumn("kind", kind).where("kind IS NOT NULL").select(*columns)
    # What no payload of a group holds: the declared paths less those found.
    every = F.array(*map(F.lit, known))
    found = shapes.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")) if by else shapes.agg(F.count(F.lit(1)).alias("_n"))
    wanted = found.where("_n > 0").select(*by, F.explode(every).alias("path"))
    same = [wanted[c].eqNullSafe(counted[c]) for c in (*by, "path")]
    missing = wanted.join(counted, same, "left_anti").select(
        *by, F.lit(MISSING).alias("kind"), "path", types[F.col("path")].alias("declared"),
        F.lit(None).cast("string").alias("found"), F.lit(0).cast("bigint").alias("payloads"),
    )
    return differing.withColumn("found", F.nullif("found", F.lit(""))).unionByName(missing.select(*columns))
