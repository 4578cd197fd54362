"""Declared tables: columns, all text, and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[str, ...]
    keys: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.fields])


DRIVER_HASHES = TableSpec("driver_hashes", ("sha256", "sha1", "md5", "driver_name", "category", "verified", "source_id", "created"), ("sha256",))
RMM_DOMAINS = TableSpec("rmm_domains", ("domain", "rmm_tool", "pattern", "regex"), ("pattern", "rmm_tool"))
SPECS = (DRIVER_HASHES, RMM_DOMAINS)
