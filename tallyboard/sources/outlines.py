"""Outlines of JSON bodies of unknown shape: one line a key, with samples."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_KEYS, SAMPLE = 40, 28


def _value(x, sample: int) -> str:
    """A value in a few characters; containers by their size."""
    if isinstance(x, list):
        return f"[{len(x)}]"
    if isinstance(x, dict):
        return f"{{{len(x)}}}"
    if isinstance(x, str) and len(x) > sample:
        x = x[:sample] + "…"
    if isinstance(x, float) and x.is_integer() and abs(x) < 1e21:
        x = int(x)
    return json.dumps(x, ensure_ascii=False)


def outline_of(text: str | None, most_keys: int = MOST_KEYS, sample: int = SAMPLE) -> list[str] | None:
    """Lines of one body. A list is shown by its first element; what is no list or object has no outline.

    Open containers lie on a stack, so depth is bounded by memory and not by calls.
    """
    try:
        body = json.loads(text or "")
    except (ValueError, RecursionError):
        return None
    if not isinstance(body, (list, dict)):
        return None
    lines, todo = [], [("", body)]
    while todo:
        path, x = todo.pop()
        if isinstance(x, str) and path is None:
            lines.append(x)
        elif isinstance(x, list):
            lines.append(f"{path or '(root)'}: array of {len(x)}")
            todo += [(f"{path}[0]", x[0])] if x else []
        elif isinstance(x, dict):
            lines.append(f"{path or '(root)'}: object, {len(x)} key(s)")
            inner = []
            for key, held in list(x.items())[:most_keys]:
                # Only lists of objects, or of lists, go on; an object within an object is a value.
                if isinstance(held, list) and held and (held[0] is None or isinstance(held[0], (list, dict))):
                    inner.append((f"{path}.{key}[0]", held[0]))
                else:
                    inner.append((None, f"  {path}{'.' if path else ''}{key} = {_value(held, sample)}"))
            if len(x) > most_keys:
                inner.append((None, f"  … and {len(x) - most_keys} more key(s)"))
            todo += reversed(inner)
        else:
            lines.append(f"{path}: {_value(x, sample)}")
    return lines


def outline(body: Column, most_keys: int = MOST_KEYS, sample: int = SAMPLE) -> Column:
    """array<string>: the outline of a JSON text, null for what is no JSON list or object. A walk of unknown depth is no column expression."""

    @F.pandas_udf("array<string>")
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: outline_of(t, most_keys, sample))

    return walk(body)
