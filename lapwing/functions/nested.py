"""Recursive descent into JSON of unknown shape, as table functions."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = T.StringType()


def _row(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def walk(node, path: str = "$") -> Iterator[tuple[str, object]]:
    """Every node with its path, depth first, in document order; JSON inside
    strings is entered too."""
    yield path, node
    if isinstance(node, dict):
        for k, v in node.items():
            yield from walk(v, f"{path}.{k}")
    elif isinstance(node, list):
        for i, v in enumerate(node):
            yield from walk(v, f"{path}[{i}]")
    elif isinstance(node, str) and node[:1] in "{[" and node[:1]:
        try:
            inner = json.loads(node)
        except ValueError:
            return
        yield from walk(inner, f"{path}()")


def _parsed(text: str | None):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


@F.udtf(returnType=_row(path=_TEXT, kind=_TEXT, value=_TEXT))
class JsonNodes:
    """All nodes of a JSON text: ``path, kind, value``."""

    def eval(self, text: str):
        node = _parsed(text)
        if node is None:
            return
        for path, n in walk(node):
            yield path, type(n).__name__, json.dumps(n, ensure_ascii=False, sort_keys=True)


@F.udtf(returnType=_row(id=_TEXT, item=_TEXT))
class JsonItems:
    """Objects anywhere in a JSON text whose ``key`` field is a plain number."""

    def eval(self, text: str, key: str):
        node = _parsed(text)
        for _, n in walk(node) if node is not None else ():
            if isinstance(n, dict) and isinstance(n.get(key), (str, int)) and re.fullmatch(r"\d+", str(n[key])):
                yield str(n[key]), json.dumps(n, ensure_ascii=False, sort_keys=True)


@F.udtf(returnType=_row(detector_box=T.ArrayType(T.DoubleType()), text=_TEXT, score=T.DoubleType()))
class DetectorRows:
    """Detections in whatever nesting: ``[points, [text, score]]`` leaves, or
    objects with parallel arrays of boxes, texts and scores."""

    def eval(self, text: str):
        yield from self._flat(_parsed(text))

    def _flat(self, node):
        if isinstance(node, dict) and "boxes" in node:
            for box, text, score in zip(node["boxes"], node.get("texts", []), node.get("scores", [])):
                yield [float(v) for p in box for v in p], text, float(score)
        elif isinstance(node, list) and len(node) == 2 and isinstance(node[1], list) and len(node[1]) == 2 and isinstance(node[1][0], str):
            yield [float(v) for p in node[0] for v in p], node[1][0], float(node[1][1])
        elif isinstance(node, list):
            for n in node:
                yield from self._flat(n)


def first_url(text, key: str = "url"):
    """First address in free text, trailing punctuation removed."""
    return F.rtrim(F.regexp_extract(text, r"(https?://[^\s\"'<>]+)", 1), F.lit(".,);"))
