"""The configuration of a sample: read, checked, frozen."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

#: What a configuration may ask for.
FIELDS = ("title", "abstract", "publication_date", "publication_venue")
MOST_PAGE, API_CAP = 100, 10_000
DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


class ConfigError(ValueError):
    """A configuration that can't be used."""


@dataclass(frozen=True)
class FetchConfig:
    count: int
    from_publication_date: str
    to_publication_date: str | None
    work_type: str
    language: str
    domain: str
    field: str
    subfield: str
    topic: str
    field_match: str
    sample_seed: int | None
    required_fields: tuple[str, ...]
    fields: tuple[str, ...]
    output_path: str
    per_page: int
    require_english_text: bool
    require_clean_text: bool
    api_key: str | None = None

    def public(self) -> dict[str, Any]:
        """For outputs: everything but the key."""
        return {f.name: list(v) if isinstance(v := getattr(self, f.name), tuple) else v for f in fields(self) if f.name != "api_key"}


_TEXTS = ("from_publication_date", "work_type", "language", "domain", "field", "subfield", "topic", "field_match", "output_path")


def make_config(values: dict[str, Any], *, api_key: str | None = None, most: int | None = API_CAP) -> FetchConfig:
    """A checked configuration from its values; ``most`` is the greatest count, None for no limit."""
    names = [f.name for f in fields(FetchConfig) if f.name not in ("api_key", "require_english_text", "require_clean_text")]
    if missing := [n for n in names if n not in values]:
        raise ConfigError(f"missing config keys: {', '.join(missing)}")
    known = {f.name: values[f.name] for f in fields(FetchConfig) if f.name in values and f.name != "api_key"}
    known = {"require_english_text": known["language"] == "en", "require_clean_text": True} | known
    for name in ("fields", "required_fields"):
        if not isinstance(known[name], (list, tuple)) or not all(isinstance(x, str) for x in known[name]):
            raise ConfigError(f"{name} must be a list of strings")
        known[name] = tuple(known[name])
    config = FetchConfig(**known, api_key=api_key)
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool)
    checks = [
        (whole(config.count) and config.count > 0 and (most is None or config.count <= most), f"count must be from 1 to {most or 'any number'}"),
        (all(isinstance(getattr(config, n), str) and getattr(config, n).strip() for n in _TEXTS), "text settings must not be blank"),
        (is_date(config.from_publication_date), "from_publication_date must be YYYY-MM-DD"),
        (config.to_publication_date is None or is_date(config.to_publication_date), "to_publication_date must be YYYY-MM-DD"),
        (config.field_match == "primary", "field_match must be primary"),
        (config.sample_seed is None or whole(config.sample_seed), "sample_seed must be a whole number"),
        (whole(config.per_page) and 1 <= config.per_page <= MOST_PAGE, f"per_page must be from 1 to {MOST_PAGE}"),
        (bool(config.fields) and set(config.fields) <= set(FIELDS), f"fields must be among {', '.join(FIELDS)}"),
        (set(config.required_fields) <= set(FIELDS), f"required_fields must be among {', '.join(FIELDS)}"),
        (set(config.required_fields) <= set(config.fields), "required_fields must be among fields"),
        (all(isinstance(x, bool) for x in (config.require_english_text, config.require_clean_text)), "require_ settings must be true or false"),
    ]
    for holds, message in checks:
        if not holds:
            raise ConfigError(message)
    return config


def is_date(value: Any) -> bool:
    return isinstance(value, str) and bool(DATE.match(value))


def load_config(path: str | Path, **options: Any) -> FetchConfig:
    try:
        values = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ConfigError(f"can't read {path}: {e}") from e
    if not isinstance(values, dict):
        raise ConfigError("a config must be a JSON object")
    return make_config(values, **options)


def api_key(name: str, env_file: str | Path | None = None) -> str | None:
    """A key from the environment or else from an env file; blank is none."""
    value = os.environ.get(name)
    if value is None and env_file and Path(env_file).exists():
        pairs = (line.split("=", 1) for line in Path(env_file).read_text().splitlines() if "=" in line and not line.lstrip().startswith("#"))
        value = {k.strip(): v.strip().strip("\"'") for k, v in pairs}.get(name)
    return value.strip() or None if value else None
