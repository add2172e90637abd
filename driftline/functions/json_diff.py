"""Partial updates of JSON documents, as a row-based change log carries them."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LEG = re.compile(r'\.(?:"((?:[^"\\]|\\.)*)"|([^."\[\]\s]+))|\[(\d+)\]')


def legs(path: str) -> list[str | int]:
    """``$.a."b c"[2]`` as its keys and places."""
    if not path.startswith("$"):
        raise ValueError(f"not a JSON path: {path}")
    out, at = [], 1
    while at < len(path):
        m = LEG.match(path, at)
        if not m:
            raise ValueError(f"not a JSON path: {path}")
        out.append(int(m[3]) if m[3] is not None else m[2] if m[2] is not None else json.loads(f'"{m[1]}"'))
        at = m.end()
    return out


def changed(root, op: str, path: str, value):
    """``root`` after one change. ``replace`` and ``remove`` need their place's parent, ``replace`` the place too; an ``insert`` that has nowhere to go does nothing."""
    *way, last = legs(path) or [None]
    if last is None:
        return None if op == "remove" else value
    parent = root
    for leg in way:
        fits = leg in parent if isinstance(parent, dict) and isinstance(leg, str) else isinstance(parent, list) and isinstance(leg, int) and leg < len(parent)
        if not fits:
            if op == "insert":
                return root
            raise ValueError(f"no parent for {path}")
        parent = parent[leg]
    if not isinstance(parent, dict if isinstance(last, str) else list):
        if op == "insert":
            return root
        raise ValueError(f"{path} leads into another kind of value")
    held = last in parent if isinstance(last, str) else last < len(parent)
    if op == "replace":
        if not held:
            raise ValueError(f"nothing to replace at {path}")
        parent[last] = value
    elif op == "remove":
        if held:
            del parent[last]
    elif isinstance(last, str):
        parent.setdefault(last, value)
    else:
        parent.insert(min(last, len(parent)), value)
    return root


def apply_diffs(document: Column, diffs: Column) -> Column:
    """JSON text after ``diffs``, an array of (op, path, value as JSON text) in order. NULL is the document null; NULL diffs leave it as it is."""

    @F.pandas_udf("string")
    def run(documents: pd.Series, changes: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(documents, changes):
            if own is None:
                out.append(text)
                continue
            value = None if text is None else json.loads(text)
            for d in own:
                if d["op"] not in ("replace", "insert", "remove") or (d["op"] == "remove") != (d["value"] is None):
                    raise ValueError(f"not a change: {d}")
                value = changed(value, d["op"], d["path"], None if d["value"] is None else json.loads(d["value"]))
            out.append(json.dumps(value, separators=(",", ":"), ensure_ascii=False))
        return pd.Series(out, dtype=object)

    return run(document, diffs)
