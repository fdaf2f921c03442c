"""Settings of an ingesting service, from environment variables that are checked by the type of their default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

# Fixed values.
TRUE, FALSE = ("1", "true", "yes", "on"), ("0", "false", "no", "off")


@dataclass(frozen=True)
class Settings:
    """source: folder of reports; state: folder of all tables. Whole numbers are above zero."""

    source: str = "reports"
    state: str = "state"
    poll_seconds: int = 60
    max_file_bytes: int = 16 * 1024 * 1024
    lease_seconds: int = 15 * 60
    split_salt: str = "quillspark-v1"
    min_new_examples: int = 500
    max_new_examples: int = 500
    replay_ratio_percent: int = 25
    rights_attested: bool = False
    auto_propose_run: bool = False

    @classmethod
    def from_env(cls, prefix: str = "QUILLSPARK_", env: Mapping[str, str] | None = None) -> Settings:
        """Values of <prefix><FIELD>, defaults for those that aren't set; ValueError names a variable that doesn't fit."""
        env = os.environ if env is None else env
        found = {f.name: prefix + f.name.upper() for f in fields(cls) if prefix + f.name.upper() in env}
        return cls(**{name: _typed(variable, env[variable], getattr(cls, name)) for name, variable in found.items()})


def _typed(name: str, raw: str, default):
    if isinstance(default, bool):
        word = raw.strip().lower()
        if word not in TRUE + FALSE:
            raise ValueError(f"{name} must be true or false")
        return word in TRUE
    if isinstance(default, int):
        try:
            number = int(raw)
        except ValueError:
            raise ValueError(f"{name} must be an integer") from None
        if number < 1:
            raise ValueError(f"{name} must be positive")
        return number
    return raw
