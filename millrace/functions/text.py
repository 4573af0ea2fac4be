"""Settings as people write them: sizes, durations, environment references, versions, back-off."""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Mapping

#: Units of sizes and durations.
SIZE_UNITS = {"": 1, "b": 1, "kb": 10**3, "mb": 10**6, "gb": 10**9, "tb": 10**12, "kib": 1 << 10, "mib": 1 << 20, "gib": 1 << 30, "tib": 1 << 40}
TIME_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}
REFERENCE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


def parse_size(text: str | int) -> int:
    """Bytes of ``5MiB`` (binary units), ``64KB`` (decimal ones) or a plain number."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m[2].lower() not in SIZE_UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(float(m[1]) * SIZE_UNITS[m[2].lower()])


def format_size(n: int) -> str:
    """The largest unit that divides n."""
    for unit, size in (("TiB", 1 << 40), ("GiB", 1 << 30), ("MiB", 1 << 20), ("KiB", 1 << 10)):
        if n >= size and n % size == 0:
            return f"{n // size}{unit}"
    return f"{n}B"


def parse_duration(text: str) -> float:
    """Seconds of ``500ms``, ``1h30m`` and the like."""
    parts = re.findall(r"(\d+(?:\.\d+)?)(ns|us|µs|ms|s|m|h)", text.strip())
    if not parts or "".join(a + b for a, b in parts) != text.strip():
        raise ValueError(f"not a duration: {text!r}")
    return sum(float(a) * TIME_UNITS[b] for a, b in parts)


def expand(text: str, env: Mapping[str, str]) -> str:
    """``${NAME}`` and ``${NAME:-default}`` from env; all missing names are reported at once."""
    missing = sorted({m[1] for m in REFERENCE.finditer(text) if m[1] not in env and m[2] is None})
    if missing:
        raise ValueError(f"not set in the environment: {', '.join(missing)}")
    return REFERENCE.sub(lambda m: env.get(m[1], m[2] or ""), text)


def version_at_least(found: str, wanted: str) -> bool:
    """Compares dotted numbers; a suffix after the numbers does not count."""
    numbers = lambda v: [int(x) for x in (re.match(r"[0-9.]*", v)[0].strip(".") or "0").split(".") if x]
    a, b = numbers(found), numbers(wanted)
    size = max(len(a), len(b))
    return a + [0] * (size - len(a)) >= b + [0] * (size - len(b))


def backoff(attempt: int, base: float = 0.2, cap: float = 30.0, jitter: Callable[[], float] = random.random) -> float:
    """Seconds to wait before an attempt: doubled each time up to the cap, plus up to half at random."""
    wait = min(cap, base * 2**attempt)
    return wait + wait / 2 * jitter()


def shorten(text: str, limit: int) -> str:
    return text if len(text) <= limit else text[:limit] + "…"
