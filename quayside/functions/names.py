"""Column-name cleaning. Works on schema metadata only, never on rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable


def clean_name(name: str) -> str:
    """Lower-case, spell out ``#`` and ``%``, and keep only ``a-z 0-9 _``."""
    spelled = name.strip().lower().replace("#", "_num").replace("%", "pct")
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "_", spelled)).strip("_")


def require_unique(names: Iterable[str], where: str) -> None:
    """Raise when two names are the same, ignoring case as Spark does."""
    repeated = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if repeated:
        raise ValueError(f"duplicate column names {repeated} in {where}")


def quoted(name: str) -> str:
    """Back-quote a column name so that dots in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"
