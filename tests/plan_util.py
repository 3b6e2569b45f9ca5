"""Read a physical plan as text, the way a user reads ``explain``."""

from __future__ import annotations

import io
from contextlib import redirect_stdout


def plan(df, mode: str | None = None) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        if mode:
            df.explain(mode)
        else:
            df.explain()
    return buf.getvalue()
