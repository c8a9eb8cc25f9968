"""Settings as immutable values: defaults, then mappings laid over them, then the environment.  Nothing global is changed, so
plans with different settings run side by side."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path


# --- fixed values: names of settings and their defaults -----------------------------------------------------------


@dataclass(frozen=True)
class Runtime:
    output_dir: str = "output"
    dpi: int = 200
    start_page: int = 1
    end_page: int = 0
    skip_vlm: bool = False
    skip_picture_triage: bool = False
    photo_summaries: bool = False
    divider_reorder: bool = True
    refine_mode: str = "auto"


@dataclass(frozen=True)
class Models:
    base_url: str = ""
    model: str = ""
    triage_model: str = ""
    temperature: float = 0.0
    num_ctx: int = 8192
    num_predict: int = 1200
    auto_num_ctx: bool = False
    triage_num_predict: int = 64
    triage_confidence: float = 0.65
    photo_skip_confidence: float = 0.8
    vlm_concurrency: int = 1
    vlm_page_image_max_px: int = 1536
    ca_bundle: str = ""


@dataclass(frozen=True)
class Pictures:
    min_area_ratio: float = 0.01
    embed_overlap_min: float = 0.5
    symbol_max_chars: int = 40
    decorative_max_area_ratio: float = 0.05
    table_min_area_ratio: float = 0.08
    nearby_block_distance: float = 0.12
    crop_neighbor_gap: float = 0.03
    crop_margin: float = 0.02
    summary_dup_min_tokens: int = 12
    summary_dup_coverage: float = 0.9


@dataclass(frozen=True)
class Tables:
    min_cells: int = 6
    min_columns: int = 2
    min_column_members: int = 3
    min_aligned_rows: int = 3
    column_x_tolerance: float = 0.025
    row_y_tolerance: float = 0.02
    score_threshold: float = 0.55
    regions_max_per_page: int = 3
    numeric_coverage_min: float = 0.9
    word_coverage_min: float = 0.8


@dataclass(frozen=True)
class ReadingOrder:
    max_depth: int = 4
    edge_eps: float = 0.006
    boundary_nudge: float = 0.002
    boundary_min_spacing: float = 0.01
    h_divider_min_span: float = 0.6
    v_divider_min_span: float = 0.35
    band_gap: float = 0.05
    column_gutter: float = 0.035
    structured_column_gutter: float = 0.02


@dataclass(frozen=True)
class Config:
    runtime: Runtime = field(default_factory=Runtime)
    models: Models = field(default_factory=Models)
    pictures: Pictures = field(default_factory=Pictures)
    tables: Tables = field(default_factory=Tables)
    reading_order: ReadingOrder = field(default_factory=ReadingOrder)


# --- end of fixed values ----------------------------------------------------------------------------------------------

#: Fractions: keys of these endings lie between 0 and 1.
_FRACTIONS = ("ratio", "confidence", "coverage", "coverage_min", "overlap_min", "threshold", "span", "gap", "tolerance", "distance", "gutter", "nudge")
REFINE_MODES, VISUAL_MODES = ("always", "auto"), ("off", "audit", "enforce")
PREFIX = "PAGEMILL_"


def flag(text: str, name: str = "value") -> bool:
    """A flag from its text; anything but the usual words is an error."""
    word = text.strip().lower()
    if word not in ("1", "true", "yes", "on", "0", "false", "no", "off"):
        raise ValueError(f"{name} must be true or false")
    return word in ("1", "true", "yes", "on")


def _typed(kind: type, value: object, name: str) -> object:
    if kind is bool:
        if isinstance(value, bool):
            return value
        if isinstance(value, str):
            return flag(value, name)
    elif kind is float and isinstance(value, int | float | str) and not isinstance(value, bool):
        value = float(value)
        if name.endswith(_FRACTIONS) and not 0 <= value <= 1:
            raise ValueError(f"{name} must lie between 0 and 1")
        return value
    elif kind is int and isinstance(value, int | str) and not isinstance(value, bool):
        return int(value)
    elif kind is str and isinstance(value, str):
        return value
    raise ValueError(f"{name} must be of type {kind.__name__}")


def build(kind: type, values: Mapping, name: str = "config"):
    """A settings value from a mapping; unknown keys and wrong types are errors that name the key."""
    known = {f.name: f for f in fields(kind)}
    if unknown := sorted(set(values) - set(known)):
        raise ValueError(f"{name} has unknown keys: {', '.join(unknown)}")
    default = kind()
    made = {}
    for key, value in values.items():
        current = getattr(default, key)
        made[key] = build(type(current), value, f"{name}.{key}") if is_dataclass(current) else _typed(type(current), value, f"{name}.{key}")
    if kind is Runtime and made.get("refine_mode", "auto") not in REFINE_MODES:
        raise ValueError(f"{name}.refine_mode must be one of {', '.join(REFINE_MODES)}")
    return kind(**made)


def read_yaml(path: str | Path) -> dict:
    """A settings file as a mapping; an empty one has nothing to say."""
    import yaml

    values = yaml.safe_load(Path(path).expanduser().read_text(encoding="utf-8")) or {}
    if not isinstance(values, dict):
        raise ValueError(f"{path} must be a mapping of sections")
    return values


def merge(base: Mapping, over: Mapping) -> dict:
    out = dict(base)
    for key, value in over.items():
        out[key] = merge(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else value
    return out


def load(*mappings: Mapping | str | Path, environment: Mapping[str, str] | None = None) -> Config:
    """Defaults, mappings or YAML files in order, then PAGEMILL_<SECTION>_<KEY> of the environment."""
    environment = os.environ if environment is None else environment
    values = asdict(Config())
    for m in mappings:
        values = merge(values, m if isinstance(m, Mapping) else read_yaml(m))
    for section, keys in asdict(Config()).items():
        for key in keys:
            if (raw := environment.get(f"{PREFIX}{section.upper()}_{key.upper()}")) is not None:
                values[section][key] = raw
    return build(Config, values)
