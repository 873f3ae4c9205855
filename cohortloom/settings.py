"""Options with overrides."""

from __future__ import annotations

from dataclasses import fields, replace


def parse_overrides(text: str | None) -> dict:
    """``a:1,b:x`` to {"a": 1.0, "b": "x"}."""
    out = {}
    for part in (text or "").split(","):
        if ":" in part:
            k, v = part.split(":", 1)
            try:
                out[k.strip()] = float(v)
            except ValueError:
                out[k.strip()] = v.strip()
    return out


def with_overrides(options, overrides: dict | str | None):
    """Copy of an options object with the given fields replaced; unknown names are an error."""
    given = parse_overrides(overrides) if isinstance(overrides, str) or overrides is None else dict(overrides)
    known = {f.name: f for f in fields(options)}
    unknown = set(given) - set(known)
    if unknown:
        raise KeyError(f"unknown options: {sorted(unknown)}")
    return replace(options, **{k: type(getattr(options, k))(v) if isinstance(getattr(options, k), (int, float)) and not isinstance(v, tuple) else v for k, v in given.items()})


def merge(base: dict, extra: dict) -> dict:
    """Nested merge; values of ``extra`` win."""
    out = dict(base)
    for k, v in extra.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
