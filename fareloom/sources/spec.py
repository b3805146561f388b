"""Declarative description of a source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

KINDS = ("csv", "parquet")


@dataclass(frozen=True)
class SourceSpec:
    """What a source is, where it lies and where its rows go.

    ``renames`` maps source headings to target names. ``primary_key`` is a target
    name. ``destination_path`` overrides the landing rule of its kind.
    """

    name: str
    kind: str
    source: str
    required_columns: tuple[str, ...] = ()
    primary_key: str | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    destination_table: str | None = None
    destination_path: str | None = None
    schema: str | None = None
    null_value: str | None = "N/A"

    def __post_init__(self) -> None:
        if self.kind.strip().lower() not in KINDS:
            raise ValueError(f"source {self.name!r}: unknown kind {self.kind!r}, use one of {KINDS}")
        if not self.source:
            raise ValueError(f"source {self.name!r}: no location given")


def load_specs(config: Mapping[str, Mapping]) -> dict[str, SourceSpec]:
    """Specs from a parsed configuration ``{"sources": {name: {...}}}``."""
    specs = {}
    for name, entry in (config.get("sources") or {}).items():
        specs[name] = SourceSpec(
            name=name,
            kind=str(entry.get("type", "")).strip().lower(),
            source=entry.get("source", ""),
            required_columns=tuple(entry.get("required_columns") or ()),
            primary_key=entry.get("primary_key"),
            renames=dict(entry.get("column_mapping") or {}),
            destination_table=entry.get("destination_table"),
            destination_path=entry.get("destination_path"),
            schema=entry.get("schema"),
        )
    return specs


def load_spec_file(path: str) -> dict[str, SourceSpec]:
    """Specs from a YAML or JSON file, whichever the suffix says."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            import json

            return load_specs(json.load(handle) or {})
        try:
            import yaml
        except ImportError as error:  # pragma: no cover - depends on the installation
            raise RuntimeError("reading YAML specs needs PyYAML; use a JSON file") from error
        return load_specs(yaml.safe_load(handle) or {})


def landing_path(spec: SourceSpec) -> str:
    """Relative landing folder: transactions for parquet, reference data for csv."""
    if spec.destination_path:
        return f"{spec.destination_path.rstrip('/')}/{spec.name}"
    prefix = "bronze/transactions" if spec.kind == "parquet" else "bronze/reference"
    return f"{prefix}/{spec.name}/{spec.name}"
