"""Declared relations: schema, key, compared columns and row rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _B, _TS = T.StringType(), T.BooleanType(), T.TimestampType()
_IDS = T.ArrayType(T.StringType(), containsNull=False)


@dataclass(frozen=True)
class TableSpec:
    """What a keyed relation promises.

    `content` is what counts as a change; `reason` says whether authored rows
    must explain an update.
    """

    name: str
    key: tuple[str, ...]
    content: tuple[str, ...]
    types: dict[str, T.DataType] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    optional_text: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    reason: bool = True

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.key, *self.content)

    def authored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.types.get(c, _S), True) for c in self.columns])

    def stored_schema(self) -> T.StructType:
        stamps = ["validated_ts"] if "validated" in self.content else []
        extra = [T.StructField(c, _TS, True) for c in (*stamps, "insert_ts", "update_ts")]
        return T.StructType([*self.authored_schema().fields, *extra])

    def history_schema(self) -> T.StructType:
        return T.StructType([*self.stored_schema().fields, T.StructField("end_ts", _TS, True)])


_COMMON = ("notes", "update_reason")

RELATIONS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec(
            "systems", ("system",), ("description", *_COMMON),
            required=("system", "description"), optional_text=_COMMON,
        ),
        TableSpec(
            "data_sources", ("data_source_id",), ("owner", "description", *_COMMON),
            required=("owner", "description"), optional_text=_COMMON,
        ),
        TableSpec(
            "schemas", ("schema_id",), ("data_source_id", "schema_name", "description", *_COMMON),
            required=("description",), optional_text=_COMMON,
        ),
        TableSpec(
            "tables", ("table_id",), ("schema_id", "table_name", "description", *_COMMON),
            required=("table_name", "description"), optional_text=_COMMON,
        ),
        TableSpec(
            "columns", ("column_id",),
            ("table_id", "column_name", "data_type", "is_nullable", "is_primary_key", "ref_table_id",
             "description", *_COMMON),
            types={"is_nullable": _B, "is_primary_key": _B},
            required=("table_name", "column_name", "data_type", "is_nullable", "description"),
            optional_text=_COMMON, flags=("is_primary_key",),
        ),
        TableSpec(
            "deployment_tables", ("table_id", "system"),
            ("data_source_id", "physical_database_name", "physical_schema_name", "physical_table_name"),
            reason=False,
        ),
        TableSpec(
            "table_relationships", ("table_a_id", "table_b_id", "relationship_name"),
            ("join_condition", "cardinality", "use_when", "notes", "validated", "update_reason"),
            types={"validated": _B},
            required=("table_a_id", "table_b_id", "relationship_name", "join_condition"),
            optional_text=("cardinality", "use_when", *_COMMON), flags=("validated",),
        ),
        TableSpec(
            "column_mappings", ("source_column_id", "mapping_name"),
            ("target_tables_referenced", "target_expression", "use_when", "notes", "validated", "update_reason"),
            types={"target_tables_referenced": _IDS, "validated": _B},
            required=("source_column_id", "mapping_name"),
            optional_text=("target_expression", "use_when", *_COMMON), flags=("validated",),
        ),
        TableSpec(
            "concepts", ("concept_id",),
            ("label", "definition", "notes", "related_object_ids", "update_reason"),
            types={"related_object_ids": _IDS},
            required=("name", "definition"), optional_text=("label", *_COMMON),
        ),
    )
}

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.LongType(), False),
        T.StructField("commit_sha", _S, True),
        T.StructField("inserts", T.LongType(), False),
        T.StructField("updates", T.LongType(), False),
        T.StructField("deletes", T.LongType(), False),
        T.StructField("reset_history", _B, False),
        T.StructField("loaded_ts", _TS, False),
    ]
)

CONTRACT_AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.LongType(), False),
        T.StructField("table_name", _S, False),
        T.StructField("csv_sha256", _S, False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("loaded_ts", _TS, False),
    ]
)

# Row correspondences a relationship may record.
CARDINALITIES = ("one_to_one", "one_to_many", "many_to_one", "many_to_many")
FLIPPED_CARDINALITY = {
    "one_to_one": "one_to_one",
    "one_to_many": "many_to_one",
    "many_to_one": "one_to_many",
    "many_to_many": "many_to_many",
}

# Keys an authored record of each file type may carry.
RECOGNISED_KEYS: dict[str, tuple[str, ...]] = {
    "systems": ("system", "description", "notes", "update_reason"),
    "data_source": ("owner", "description", "notes", "update_reason"),
    "deployments": ("system", "database_name", "schemas"),
    "schema": ("description", "notes", "update_reason"),
    "tables": ("table_name", "description", "notes", "update_reason"),
    "columns": (
        "table_name", "column_name", "data_type", "is_nullable", "is_primary_key", "ref_table",
        "description", "notes", "update_reason",
    ),
    "table_relationships": (
        "table_a_id", "table_b_id", "relationship_name", "join_condition", "cardinality", "use_when",
        "notes", "validated", "update_reason",
    ),
    "column_mappings": (
        "source_column_id", "mapping_name", "target_expression", "use_when", "notes", "validated",
        "update_reason",
    ),
    "concepts": ("name", "label", "definition", "notes", "related_object_ids", "update_reason"),
}
DEPLOYMENT_SCHEMA_KEYS = ("name", "tables")
