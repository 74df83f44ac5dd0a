"""What the columns of a labelled table mean."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Range:
    """Allowed interval of a numeric column; ``None`` leaves that end open."""

    low: float | None = None
    high: float | None = None
    low_inclusive: bool = True


@dataclass(frozen=True)
class Roles:
    """Columns grouped by how missing values and encodings treat them."""

    continuous: tuple[str, ...]
    binary: tuple[str, ...]
    categorical: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    key: str
    label: str
    classes: tuple[int, ...]
    continuous: tuple[str, ...] = ()
    ranges: Mapping[str, Range] = field(default_factory=dict)
    geo: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    binary_prefix: str = "has_"

    def features(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in (self.key, self.label)]

    def binary_columns(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c.startswith(self.binary_prefix)]

    def geo_columns(self, df: DataFrame) -> list[str]:
        return [c for c in self.geo if c in df.columns]

    def domain_of(self, df: DataFrame) -> dict[str, tuple]:
        """Allowed values per present column: listed categories, then 0/1 flags."""
        found = {c: tuple(v) for c, v in self.domains.items() if c in df.columns}
        found.update({c: (0, 1) for c in self.binary_columns(df)})
        return found

    def roles(self, df: DataFrame) -> Roles:
        """Roles read from name prefix and type; geo ids count as continuous here."""
        types = {f.name: f.dataType for f in df.schema.fields}
        binary = tuple(c for c in self.features(df) if c.startswith(self.binary_prefix))
        rest = [c for c in self.features(df) if c not in binary]
        return Roles(
            continuous=tuple(c for c in rest if isinstance(types[c], T.NumericType)),
            binary=binary,
            categorical=tuple(c for c in rest if isinstance(types[c], T.StringType)),
        )


# The published column contract of the building survey.
BUILDINGS = TableSpec(
    key="building_id",
    label="damage_grade",
    classes=(1, 2, 3),
    continuous=(
        "age",
        "area_percentage",
        "height_percentage",
        "count_floors_pre_eq",
        "count_families",
    ),
    ranges={
        "age": Range(0, 800),
        "count_floors_pre_eq": Range(0, 15, low_inclusive=False),
        "area_percentage": Range(0, 100, low_inclusive=False),
        "height_percentage": Range(0, 100, low_inclusive=False),
        "count_families": Range(0, None),
    },
    geo={
        "geo_level_1_id": (0, 30),
        "geo_level_2_id": (0, 1427),
        "geo_level_3_id": (0, 12567),
    },
    domains={
        "land_surface_condition": ("n", "o", "t"),
        "foundation_type": ("h", "i", "r", "u", "w"),
        "roof_type": ("n", "q", "x"),
        "ground_floor_type": ("f", "m", "v", "x", "z"),
        "other_floor_type": ("j", "q", "s", "x"),
        "position": ("j", "o", "s", "t"),
        "plan_configuration": ("a", "c", "d", "f", "m", "n", "o", "q", "s", "u"),
        "legal_ownership_status": ("a", "r", "v", "w"),
    },
)
