"""Two JSON objects as one, without overwriting what the first one says."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MERGED = "merged string, conflicts array<string>"


def merged(first: Column, second: Column) -> Column:
    """struct(merged, conflicts) of two JSON texts: the recursive union of their objects by path; the first one goes first.

    A null, a blank text and an empty array say nothing, so the other side's value is taken; where both sides say
    something and at least one of them is no object, the first one's stays, and if they differ the path ($.a.b) is a
    conflict, arrays as wholes. Keys keep the first one's order, new ones follow. A text that is no JSON object counts as
    an empty one; two such give null.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def parsed(text):
            try:
                value = json.loads(text) if text is not None else None
            except (ValueError, RecursionError):
                value = None
            return value if isinstance(value, dict) else None

        def silent(v) -> bool:
            return v is None or v == [] or (isinstance(v, str) and not v.strip())

        def union(a, b):
            if a is None and b is None:
                return None, []
            out, conflicts = {}, []
            open_ = [(out, a or {}, b or {}, "$")]
            while open_:
                into, x, y, path = open_.pop()
                for key in [*x, *(k for k in y if k not in x)]:
                    own, other = x.get(key), y.get(key)
                    if isinstance(own, dict) and (isinstance(other, dict) or silent(other)):
                        into[key] = {}
                        open_.append((into[key], own, other or {}, f"{path}.{key}"))
                    elif silent(own):
                        into[key] = own if silent(other) and key in x else other
                    else:
                        into[key] = own
                        if not silent(other) and (type(own), own) != (type(other), other):
                            conflicts.append(f"{path}.{key}")
            return json.dumps(out, ensure_ascii=False), sorted(conflicts)

        for left, right in batches:
            rows = [union(parsed(a), parsed(b)) for a, b in zip(left, right)]
            yield pd.DataFrame({"merged": [r[0] for r in rows], "conflicts": [r[1] for r in rows]})

    return F.pandas_udf(run, MERGED)(first, second)
