from __future__ import annotations

import re
from datetime import date


def parse_day(text: str) -> date:
    """The day a job is for, given as yyyy-MM-dd."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text, re.ASCII):
        raise ValueError(f"not a day of the form yyyy-MM-dd: {text!r}")
    return date.fromisoformat(text)
