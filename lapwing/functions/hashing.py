"""Keys, canonical addresses and digests."""

from __future__ import annotations

import hashlib
import hmac
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_url(url: Column) -> Column:
    """Scheme and host in lower case, one slash at either end of the path; query
    and fragment go."""
    raw = F.trim(url)
    scheme = F.lower(F.regexp_extract(raw, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    host = F.lower(F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.btrim(F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))
    return F.concat(F.when(scheme == "", "https").otherwise(scheme), F.lit("://"), host, F.when(path == "", "/").otherwise(F.concat(F.lit("/"), path, F.lit("/"))))


def strict_url(url: Column, hosts: list[str]) -> Column:
    """https, no ``www.``, single slashes, no trailing punctuation; NULL for hosts
    that are not of ``hosts`` or below them."""
    raw = F.rtrim(F.trim(url), F.lit(".,;!?)]}"))
    host = F.regexp_replace(F.lower(F.regexp_extract(raw, r"(?i)^https?://([^/?#:]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(raw, r"(?i)^https?://[^/?#]*([^?#]*)", 1), "/{2,}", "/")
    own = host.rlike("^(?:.*\\.)?(?:" + "|".join(h.replace(".", "\\.") for h in hosts) + ")$")
    return F.when(own, F.concat(F.lit("https://"), host, F.rtrim(F.when(path == "", "/").otherwise(path), F.lit("/")), F.lit("/")))


def cache_key(url: Column, profile: Column) -> Column:
    return F.substring(F.sha2(F.concat(url, F.lit("\n"), profile), 256), 1, 32)


def source_id(url: Column, prefix: str = "source-") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(url, 256), 1, 12))


def slug(text: Column, longest: int = 80, default: str = "item") -> Column:
    s = F.btrim(F.regexp_replace(text, "[^0-9A-Za-z._-]+", "-"), F.lit("-._"))
    return F.substring(F.when(s == "", default).otherwise(s), 1, longest)


def object_id(bucket: Column, name: Column, generation: Column) -> Column:
    """Readable stem of a name and a digest of the exact object generation."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")
    return F.concat(slug(stem), F.lit("-"), F.substring(F.sha2(F.concat(bucket, F.lit("/"), name, F.lit("#"), generation), 256), 1, 12))


def state_key(url: Column, key: Column) -> Column:
    """A given key's safe characters, else a digest of the address."""
    given = F.trim(F.coalesce(key, F.lit("")))
    own = F.when(given == "", F.substring(F.sha1(F.trim(url)), 1, 16)).otherwise(given)
    safe = F.substring(F.regexp_replace(own, "[^0-9A-Za-z_-]", ""), 1, 80)
    return F.when(safe == "", "default").otherwise(safe)


def artifact(root: Column, version: Column, source: Column, name: str) -> Column:
    return F.concat_ws("/", F.rtrim(root, F.lit("/")), slug(version), source, F.lit(name))


def signature(secret: bytes):
    """A pandas UDF for the unpadded URL-safe HMAC-SHA256 of ``uri\\nexpires``."""

    def sign(uri: pd.Series, expires: pd.Series) -> pd.Series:
        import base64

        one = lambda u, e: base64.urlsafe_b64encode(hmac.new(secret, f"{u}\n{e}".encode(), hashlib.sha256).digest()).decode().rstrip("=")
        return pd.Series([one(u, e) for u, e in zip(uri, expires)])

    sign.__annotations__ = {"uri": pd.Series, "expires": pd.Series, "return": pd.Series}
    return F.pandas_udf(sign, T.StringType())


def canonical_json(text: str) -> str | None:
    """Keys sorted, no spaces, shortest escapes; NULL for duplicate keys, NaN and
    what is no JSON."""

    def unique(pairs):
        keys = [k for k, _ in pairs]
        if len(set(keys)) != len(keys):
            raise ValueError("duplicate key")
        return dict(pairs)

    def refuse(_):
        raise ValueError("not a number")

    try:
        value = json.loads(text, object_pairs_hook=unique, parse_constant=refuse)
    except (ValueError, TypeError, RecursionError):
        return None
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def same_json(a: str, b: str) -> bool:
    """Deep equality that tells 1 from true and from 1.0."""

    def same(x, y) -> bool:
        if type(x) is not type(y):
            return False
        if isinstance(x, dict):
            return x.keys() == y.keys() and all(same(x[k], y[k]) for k in x)
        if isinstance(x, list):
            return len(x) == len(y) and all(map(same, x, y))
        return x == y

    try:
        return same(json.loads(a), json.loads(b))
    except (ValueError, TypeError):
        return False


def _udf(fn, kind: T.DataType):
    def run(values):
        return values.map(lambda v: None if v is None else fn(v))

    run.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind)


canonical = _udf(canonical_json, T.StringType())


def _same(a, b):
    return pd.Series([same_json(x, y) for x, y in zip(a, b)])


_same.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
same_document = F.pandas_udf(_same, T.BooleanType())
