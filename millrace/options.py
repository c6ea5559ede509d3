"""Every option of the engine, with its default."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields

#: Column names that always hold epoch milliseconds with a zone (fixed values).
TS_MS_FIELDS = ("__ts_ms", "__source_ts_ms")


def config_subset(config: dict[str, str], prefix: str) -> dict[str, str]:
    """The entries that begin with ``prefix``, without it."""
    return {k[len(prefix) :]: v for k, v in config.items() if k.startswith(prefix)}


def split_list(text: str) -> list[str]:
    """Comma-separated entries; a comma after a backslash or in parentheses is kept. Blanks are trimmed."""
    out, depth, word, escaped = [], 0, "", False
    for c in text:
        if escaped:
            word, escaped = word + c, False
        elif c == "\\":
            escaped = True
        elif c == "," and not depth:
            out.append(word)
            word = ""
        else:
            depth += (c == "(") - (c == ")")
            word += c
    return [w.strip() for w in [*out, word] if w.strip()]


@dataclass
class Options:
    warehouse: str = ""
    # mutation
    upsert: bool = False
    upsert_keep_deletes: bool = True
    upsert_use_dv: bool | None = None  # a storage detail, accepted and without effect on results
    upsert_op_field: str = "__op"
    upsert_dedup_column: str | None = None
    elide_predelete: bool = False
    # tables
    table_mapper: str = "default-mapper"
    destination_regexp: str = ""
    destination_regexp_replace: str = ""
    destination_uppercase_table_names: bool = False
    destination_lowercase_table_names: bool = False
    table_prefix: str = ""
    table_namespace: str = "default"
    catalog_name: str = "default"
    create_identifier_fields: bool = True
    partition_by: list[str] = field(default_factory=list)
    partition_by_table: dict[str, list[str]] = field(default_factory=dict)
    write_format_default: str = "parquet"
    format_version: int = 3
    io_impl: str | None = None
    target_rows_per_file: int = 0
    # schemas
    allow_field_addition: bool = True
    excluded_columns: list[str] = field(default_factory=list)
    preserve_required_property: bool = False
    nested_as_variant: bool = False
    # source
    format_key: str = "connect"
    format_value: str = "connect"
    key_schemas_enable: bool = True
    value_schemas_enable: bool = True
    time_precision_mode: str = "isostring"
    time_precision_mode_adaptive_allowed: bool = False
    decimal_handling_mode: str = "double"
    add_fields: list[str] = field(default_factory=lambda: ["op", "table", "source.ts_ms", "source.ts_ns", "db", "ts_ms", "ts_ns"])
    delete_mode: str = "rewrite"
    drop_tombstones: bool = True
    unwrap: bool = True
    heartbeat_pattern: str = r"__\w+-heartbeat.*"
    heartbeat_skip_consuming: bool = True
    transforms: list[str] = field(default_factory=list)
    transform_config: dict[str, dict[str, str]] = field(default_factory=dict)
    # state tables
    offset_table: str = "_offset_storage"
    history_table: str = "_schema_history_storage"
    offset_store: str = "table"
    history_store: str = "table"
    # passed on to Spark as they are: spark.sql.catalog.*, spark.hadoop.* and the like
    spark_config: dict[str, str] = field(default_factory=dict)
    # batches
    batch_size_wait: str = "NoBatchSizeWait"
    batch_size_wait_max_wait_ms: int = 300_000
    batch_size_wait_wait_interval_ms: int = 10_000
    max_batch_size: int = 2048
    concurrent_uploads: int = 1
    concurrent_uploads_timeout_minutes: int = 60
    lineage_enabled: bool = False

    def __post_init__(self):
        if self.format_key != self.format_value or self.format_value not in ("json", "connect"):
            raise ValueError(f"formats must both be json or connect, not {self.format_key} and {self.format_value}")
        mode = self.time_precision_mode.lower()
        if mode.startswith("adaptive") and not self.time_precision_mode_adaptive_allowed:
            raise ValueError(f"time precision mode {mode} isn't supported")
        self.write_format_default = self.write_format_default.lower()
        if self.write_format_default == "avro":
            raise ValueError("this Spark has no Avro source; use parquet or orc")
        if self.write_format_default not in ("parquet", "orc"):
            raise ValueError(f"unknown write format {self.write_format_default}")
        if self.batch_size_wait_wait_interval_ms >= self.batch_size_wait_max_wait_ms:
            raise ValueError("the wait interval must be less than the longest wait")

    @classmethod
    def from_properties(cls, config: dict[str, str]) -> Options:
        """Options from property names such as ``<any>.sink.<name>.upsert-keep-deletes``.

        Unknown names are ignored; they may belong to a catalog or a file system.
        """
        known = {f.name: f for f in fields(cls)}
        alias = {
            "write_format_default": "write_format_default", "upsert_use_deletion_vectors": "upsert_use_dv",
            "batch_size_wait": "batch_size_wait", "time_precision_mode_adaptive_allowed": "time_precision_mode_adaptive_allowed",
            "schemas_enable": "value_schemas_enable", "format_value_schemas_enable": "value_schemas_enable",
            "format_key_schemas_enable": "key_schemas_enable", "destination_regexp_replace": "destination_regexp_replace",
        }
        out: dict = {}
        per_table: dict[str, list[str]] = {}
        passed = {k: v for k, v in config.items() if k.startswith("spark.")}
        transforms: dict[str, dict[str, str]] = {}
        for key, value in config.items():
            if key in passed:
                continue
            if m := re.match(r"(?:[\w-]+\.)?transforms\.([\w-]+)\.(.+)$", key):
                transforms.setdefault(m[1], {})[m[2]] = value
                continue
            name = re.sub(r"^(?:[\w-]+\.)?(?:sink\.(?:[\w-]+\.)?|source\.)?", "", key, count=1) if "." in key else key
            if name.startswith("partition-by."):
                per_table[name.removeprefix("partition-by.")] = split_list(value)
                continue
            name = re.sub(r"[.-]", "_", name)
            name = alias.get(name, name)
            if name in known:
                out[name] = _typed(str(known[name].type), value)
        for own in transforms.values():  # what the flattening transform is told
            if own.get("type", "").endswith(("ExtractNewRecordState", "ExtractNewDocumentState")):
                of = {"add.fields": "add_fields", "delete.handling.mode": "delete_mode", "delete.tombstone.handling.mode": "delete_mode", "drop.tombstones": "drop_tombstones"}
                out |= {of[k]: _typed(str(known[of[k]].type), v) for k, v in own.items() if k in of}
        more = {"partition_by_table": per_table, "spark_config": passed, "transform_config": transforms}
        return cls(**out, **{k: v for k, v in more.items() if v})

    def partition_spec(self, destination: str) -> tuple[list[str], bool]:
        """The partition entries of a destination, and whether they are its own (then strict)."""
        if destination in self.partition_by_table:
            return self.partition_by_table[destination], True
        return self.partition_by, False


def _typed(kind: str, value):
    if not isinstance(value, str):
        return value
    if kind.startswith("bool"):
        return value.strip().lower() == "true"
    if kind == "int":
        return int(value)
    if kind.startswith("list"):
        return split_list(value)
    return value


def mask_secrets(options: dict[str, str]) -> dict[str, str]:
    """Options for a log: values of names that speak of secrets are hidden."""
    return {k: "*****" if re.search(r"password|secret|token|credential|access.?key", k, re.I) else v for k, v in options.items()}
