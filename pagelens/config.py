"""Settings of a run. The clock is a parameter, so that a run can be repeated."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import datetime


@dataclass(frozen=True)
class Settings:
    """Defaults of a run; from_mapping reads them from text as an environment gives them."""

    as_of: datetime = datetime(2026, 1, 1)
    static_ttl_days: int = 30
    psi_ttl_days: int = 14
    map_ttl_days: int = 14
    places_ttl_days: int = 30
    impressum_ttl_days: int = 7
    places_daily_quota: int = 200
    b3_enrichment: bool = False
    impressum_scraper: bool = True
    dns_probe: bool = False
    max_leads: int = 100
    plz_fallback: str = "permissive"

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> Settings:
        """Values by upper-case field name; an empty text counts as unset; booleans are true, false, 1 or 0."""
        out = {}
        for f in fields(cls):
            raw = values.get(f.name.upper())
            if raw is None or raw == "":
                continue
            if f.type == "bool":
                if raw.lower() not in ("true", "false", "1", "0"):
                    raise ValueError(f"{f.name.upper()} has to be true or false, not {raw!r}")
                out[f.name] = raw.lower() in ("true", "1")
            elif f.type == "int":
                out[f.name] = int(raw)
            elif f.type == "datetime":
                out[f.name] = datetime.fromisoformat(raw)
            else:
                out[f.name] = raw
        return cls(**out)


def plz_mode(raw: str | None) -> str:
    """The fallback mode of an option; unset is permissive."""
    if not raw:
        return "permissive"
    if raw not in ("strict", "permissive", "off"):
        raise ValueError(f"invalid fallback {raw!r}: strict, permissive or off")
    return raw
