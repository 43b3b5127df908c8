"""Plan inspection and small frames."""

from __future__ import annotations

import contextlib
import io


def plan(df, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def column(df, name: str) -> list:
    return [r[name] for r in df.collect()]


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
