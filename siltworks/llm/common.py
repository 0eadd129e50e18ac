"""Helpers shared by the operators: Arrow batches in and out, and comment headers of source files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: Bytes of a batch that are turned into Python objects at once, about.
MOST = 16 << 20


def batches(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: T.StructType | str) -> DataFrame:
    """Apply a function of columns (lists) to columns, batch by batch.

    ``make`` runs once in each task and returns that function, so tables, automata and
    caches are set up once and live as long as the task.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(parts: Iterable[pa.RecordBatch]):
        fn = None
        for part in parts:
            if part.num_rows == 0:
                continue
            fn = fn or make()
            step = max(1, int(part.num_rows * MOST / max(MOST, part.nbytes)))
            for k in range(0, part.num_rows, step):  # long texts go in pieces of few rows
                piece = part.slice(k, step)
                out = fn({name: piece.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


_OPEN = re.compile(r"\s*(?:/\*+!?|<!--|\(\*|\"\"\"|''')")
_LINE = re.compile(r"\s*(?://+!?|#+!?(?!\s*(?:include|define|undef|if|ifdef|ifndef|elif|else|endif|pragma|error|region)\b|\[)|--+|;+|%+|\*+(?!/)|'(?!''))\s?(.*)", re.S)
_SKIP = re.compile(r"\s*(?:#!.*|<\?(?:php|xml)\b.*|<!DOCTYPE.*|set -\w+|'use strict';?|\"use strict\";?)?\s*$", re.I)


def leading_comment(text: str) -> list[str]:
    """Lines of the comment a file begins with, without comment signs.

    Line ends may be mixed. A shebang, an XML or PHP opening and blank lines may come first;
    the comment ends at the first line of code.
    """
    out: list[str] = []
    close = None
    start = 1 if text[:1] == "﻿" else 0
    size = len(text)
    while start <= size:
        end = text.find("\n", start)
        if end < 0:
            end = size
        line = text[start:end].rstrip("\r")
        start = end + 1
        for part in line.split("\r") if "\r" in line else (line,):
            if close:
                at = part.find(close)
                if at < 0:
                    out.append(part.strip().lstrip("*").strip())
                    continue
                out.append(part[:at].strip().lstrip("*").strip())
                close = None
                continue
            if _SKIP.match(part):
                continue
            m = _OPEN.match(part)
            if m:
                sign = m[0].strip()
                close = {"/": "*/", "<": "-->", "(": "*)"}.get(sign[0], sign)
                rest = part[m.end():]
                at = rest.find(close)
                if at >= 0:
                    out.append(rest[:at].strip())
                    close = None
                else:
                    out.append(rest.strip())
                continue
            m = _LINE.match(part)
            if not m:
                return out
            out.append(m[1].strip())
    return out
