"""Run settings from a YAML mapping: nested keys, letter case ignored, unknown keys reported."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from typing import Any

from pavelens.operators.evaluate import Weights

METRICS = ("SM4L_M", "SM4L_A", "MSPT", "MSPH", "RISS", "AFLI", "OFS")
# Default norm factors (1.5 value, warning value, threshold) by construction, class and metric.
_EVEN = {"SM4L_M": {"A": (4, 12, 16), "B": (4, 16, 25)}, "SM4L_A": {"A": (1, 2.5, 3.5), "B": (1, 3.5, 5)}, "MSPT": {"A": (4, 15, 25), "B": (4, 15, 25)}, "MSPH": {"A": (0.1, 4, 6), "B": (0.1, 4, 6)}}
DEFAULT_FACTORS = {
    "A": _EVEN | {"RISS": {"A": (1, 15, 25), "B": (5, 20, 33), "N": (5, 20, 33)}, "AFLI": {"A": (1, 15, 25), "B": (5, 20, 33), "N": (5, 20, 33)}, "OFS": {"A": (1, 15, 25), "B": (10, 33, 50), "N": (10, 33, 50)}},
    "P": _EVEN | {"OFS": {"A": (1, 15, 25), "B": (5, 25, 40), "N": (5, 25, 40)}},
}


def lookup(tree: Any, path: str, *default: Any) -> Any:
    """Value at a dotted path, letter case ignored. Missing and empty values give the default, or an error without one."""
    at = tree
    for key in path.split("."):
        found = {str(k).upper(): v for k, v in at.items()} if isinstance(at, dict) else {}
        at = found.get(key.upper())
        if at is None:
            if default:
                return default[0]
            raise ValueError(f"{path} is missing")
    return at


def crs_name(value: Any) -> str:
    """'epsg:<number>' of an EPSG number in any common spelling."""
    m = re.fullmatch(r"\s*(?:epsg\s*:?\s*)?(\d{4,6})\s*", str(value), re.IGNORECASE)
    if not m:
        raise ValueError(f"{value!r} names no EPSG code")
    return f"epsg:{m[1]}"


@dataclass(frozen=True)
class RecordingFields:
    id: str
    time: str
    direction: str
    height: str
    path: str | None = None
    mask: str | None = None
    pitch: str | None = None
    roll: str | None = None
    id_base: int = 36


@dataclass(frozen=True)
class Thresholds:
    tile_bad_mid: float = 0.02
    tile_bad: float = 0.3
    tile_mid: float = 0.2
    marking_mid: float = 0.25
    marking_bad: float = 0.25


# Types of markings in the order of their numbers from 1 on; NULL has no weight.
MARKING_TYPES = ("LINIE_DUENN", "LINIE_DUENN_GESTRICHELT", "LINIE_BREIT", "LINIE_BREIT_GESTRICHELT", "LINIE_EXTRABREIT", "NULL", "PFEILE", "SYMBOLE", "SPERRFLAECHEN")
# What panoramas may be centred on.
CENTERINGS = ("Geographic", "Grid", "Recording_Direction", "Recording_Direction_Grid")
CONDITIONS = ("GUT", "MITTEL", "SCHLECHT")


def marking_factors(tree: Any) -> dict[tuple[int, int], float]:
    """(condition from 1, type from 1) → condition factor × type factor; 1 where none is given, 0 for the type NULL."""
    cond = [float(lookup(tree, f"condition.{c}", 1)) for c in CONDITIONS]
    kind = [0.0 if t == "NULL" else float(lookup(tree, f"type.{t}", 1)) for t in MARKING_TYPES]
    return {(i + 1, k + 1): a * b for i, a in enumerate(cond) for k, b in enumerate(kind)}


def weights_of(tree: Any) -> Weights:
    """Weights of the partial values; what isn't given keeps its default. Keys: evenness, substance, paved_evenness, veto."""
    base = Weights()
    part = lambda name, default: {k: float(lookup(tree, f"{name}.{k}", v)) for k, v in default.items()}
    paved = part("paved_evenness", base.evenness)
    return Weights(part("evenness", base.evenness), part("substance", base.substance), float(lookup(tree, "veto", base.veto)), paved)


@dataclass(frozen=True)
class Settings:
    epsg: str = "epsg:25832"
    tile_size: int = 50
    id_mode: str = "coordinates"  # or "numbered"
    delimiter: str = "_"
    factors: dict = field(default_factory=lambda: DEFAULT_FACTORS)
    thresholds: Thresholds = Thresholds()
    recordings: RecordingFields | None = None
    weights: Weights = Weights()
    marking_factors: dict = field(default_factory=lambda: marking_factors({}))
    centering: str = "Geographic"

    def factor_rows(self) -> list[tuple]:
        """(bw, metric, fk, f1, f2, f3) of every factor."""
        return [(bw, m, fk, *map(float, f)) for bw, ms in self.factors.items() for m, by in ms.items() for fk, f in by.items()]


def parse(tree: dict) -> Settings:
    """Settings of a mapping with the keys epsg, tile_size, id_mode, delimiter, thresholds, recordings, factors, weights, marking_factors and centering."""
    known = {"EPSG", "TILE_SIZE", "ID_MODE", "DELIMITER", "FACTORS", "THRESHOLDS", "RECORDINGS", "WEIGHTS", "MARKING_FACTORS", "CENTERING"}
    for k in tree:
        if str(k).upper() not in known:
            warnings.warn(f"unknown setting {k}", stacklevel=2)
    mode = str(lookup(tree, "id_mode", "coordinates")).lower()
    if mode not in ("coordinates", "numbered"):
        raise ValueError("id_mode is coordinates or numbered")
    factors = {bw: {m: dict(by) for m, by in ms.items()} for bw, ms in DEFAULT_FACTORS.items()}
    for bw, ms in factors.items():
        for m, by in ms.items():
            for fk in by:
                by[fk] = tuple(lookup(tree, f"factors.{bw}.{m}.{fk}", by[fk]))
                if len(by[fk]) != 3 or not by[fk][0] < by[fk][1] < by[fk][2]:
                    raise ValueError(f"factors.{bw}.{m}.{fk}: three rising numbers are needed")
    rec = lookup(tree, "recordings", None)
    fields = None
    if rec is not None:
        fields = RecordingFields(*(lookup(rec, k) for k in ("id", "time", "direction", "height")), *(lookup(rec, k, None) for k in ("path", "mask", "pitch", "roll")), int(lookup(rec, "id_base", 36)))
    limits = Thresholds(**{k: float(lookup(tree, f"thresholds.{k}", v)) for k, v in vars(Thresholds()).items()})
    centering = str(lookup(tree, "centering", "Geographic"))
    if centering not in CENTERINGS:
        raise ValueError(f"centering is one of {', '.join(CENTERINGS)}")
    head = crs_name(lookup(tree, "epsg", "25832")), int(lookup(tree, "tile_size", 50)), mode, str(lookup(tree, "delimiter", "_"))
    return Settings(*head, factors, limits, fields, weights_of(lookup(tree, "weights", {})), marking_factors(lookup(tree, "marking_factors", {})), centering)


def load(path: str) -> Settings:
    import yaml

    with open(path) as f:
        return parse(yaml.safe_load(f) or {})
