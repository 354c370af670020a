"""Checks of step configurations (plain dicts, as loaded from YAML or JSON)."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from millrace.errors import ConfigError


def section(step: str, config: Mapping[str, Any] | None, allowed: Mapping[str, Any]) -> dict[str, Any]:
    """Return ``config`` completed with the defaults in ``allowed``.

    A field that ``allowed`` does not list is an error, and so is a value whose
    type differs from that of a non-None default. ``None`` means "not set".
    """
    config = dict(config or {})
    unknown = sorted(set(config) - set(allowed))
    if unknown:
        raise ConfigError(f"{step}: unknown field(s) {', '.join(unknown)}")
    result = dict(allowed)
    for name, value in config.items():
        if value is None:
            continue
        default = allowed[name]
        if isinstance(default, bool):
            ok = isinstance(value, bool)
        elif isinstance(default, int):
            ok = isinstance(value, int) and not isinstance(value, bool)
        elif isinstance(default, float):
            ok = isinstance(value, (int, float)) and not isinstance(value, bool)
        elif isinstance(default, (str, list, dict)):
            ok = isinstance(value, (list, tuple) if isinstance(default, list) else type(default))
        else:
            ok = True
        if not ok:
            raise ConfigError(
                f"{step}: field {name} must be {type(default).__name__}, got {type(value).__name__}"
            )
        result[name] = list(value) if isinstance(default, list) else value
    return result


def require(step: str, config: Mapping[str, Any], *names: str) -> None:
    """Every named field must be present and not empty."""
    for name in names:
        if config.get(name) in (None, "", [], {}):
            raise ConfigError(f"{step} requires {name}")


def enum(step: str, value: Any, prefix: str, members: tuple[str, ...]) -> str:
    """Normalise an enum value: ``PREFIX_NAME`` and ``name`` are the same."""
    text = str(value).upper()
    if text.startswith(prefix):
        text = text[len(prefix):]
    if text not in members:
        raise ConfigError(f"{step}: {value!r} is not one of {', '.join(m.lower() for m in members)}")
    return text


def non_negative(step: str, config: Mapping[str, Any], *names: str) -> None:
    for name in names:
        if config.get(name) is not None and config[name] < 0:
            raise ConfigError(f"{step}: {name} must not be negative")


def one_char(step: str, name: str, value: str | None, default: str) -> str:
    """First character of a setting, or the default when it is empty."""
    if not value:
        return default
    if ord(value[0]) > 127:
        raise ConfigError(f"{step}: {name} must be an ASCII character")
    return value[0]
