"""Generic flattening of nested JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.parsers import EMPTY_JSON

_LINEAGE = ("source", "place_name", "ingest_date", "ingest_hour")


def payload_schema(records: DataFrame, payload: str = "payload") -> str:
    """Schema of all payloads together, as text for ``from_json``.

    The schema is merged by a distributed aggregate; only its text reaches the driver.
    Fields whose type differs between payloads are read as text.
    """
    merged = records.agg(F.schema_of_variant_agg(F.try_parse_json(payload)).alias("s")).first()["s"]
    text = merged.replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING").replace("VOID", "STRING")
    if not text.startswith("STRUCT<"):
        raise ValueError(f"Payloads are not JSON objects: {merged}")
    return _widen(T.DataType.fromDDL(text)).simpleString()


def _widen(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _widen(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_widen(kind.elementType))
    return T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def leaves(column: Column, kind: T.StructType, prefix: str = "") -> list[Column]:
    """One column per leaf, named by its dotted path. Arrays stay arrays."""
    found: list[Column] = []
    for field in kind.fields:
        value = column.getField(field.name)
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += leaves(value, field.dataType, f"{name}.")
        else:
            found.append(value.alias(name))
    return found


def flatten_payloads(records: DataFrame, schema: str | None = None, keep_payload: bool = False) -> DataFrame:
    """Payload leaves as dotted columns, then the four lineage columns. Empty payloads give no row."""
    records = records.where(F.col("payload").isNotNull() & ~F.col("payload").rlike(EMPTY_JSON))
    schema = schema or payload_schema(records)
    parsed = records.withColumn("_parsed", F.from_json("payload", schema))
    columns = leaves(F.col("_parsed"), parsed.schema["_parsed"].dataType)
    kept = ["payload"] if keep_payload else []
    return parsed.select(*columns, *_LINEAGE, *kept)


def flatten_paths(records: DataFrame, depth: int = 8) -> DataFrame:
    """Payload leaves in long form: ``path``, ``value`` and the four lineage columns, a row per leaf.

    Keys may differ from record to record: no schema is merged, and nothing reaches the driver. Arrays stay
    values, as JSON; so do objects more than ``depth`` levels down. Leaves that are null have a null
    value. Payloads that are empty or no JSON object give no row.
    """
    entry = "ARRAY<STRUCT<path: STRING, value: VARIANT>>"

    def is_object(value: Column) -> Column:
        return F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))

    def inner(path: Column, value: Column) -> Column:
        pairs = F.map_entries(value.cast("map<string, variant>"))
        return F.transform(
            pairs, lambda pair: F.struct(F.concat_ws(".", path, pair["key"]).alias("path"), pair["value"].alias("value"))
        ).cast(entry)

    def opened(found: Column) -> Column:
        one = F.when(is_object(found["value"]) & (F.schema_of_variant(found["value"]) != "OBJECT<>"), inner(found["path"], found["value"]))
        return F.coalesce(one, F.array(found).cast(entry))

    parsed = F.try_parse_json("payload")
    top = F.when(is_object(parsed), inner(F.lit(None).cast("string"), parsed))
    found = records.select(*_LINEAGE, top.alias("found")).where(F.col("found").isNotNull())
    for _ in range(depth - 1):
        found = found.withColumn("found", F.flatten(F.transform("found", opened)))
    leaf = F.col("leaf.value")
    return found.select(*_LINEAGE, F.explode("found").alias("leaf")).select(
        "leaf.path", F.coalesce(leaf.try_cast("string"), F.nullif(F.to_json(leaf), F.lit("null"))).alias("value"), *_LINEAGE
    )


def combine(frames: list[DataFrame]) -> DataFrame:
    """Union of partial frames; columns missing in one of them become null."""
    if not frames:
        raise ValueError("Nothing to combine")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
