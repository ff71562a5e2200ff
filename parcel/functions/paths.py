"""Path and name functions over inventory columns.

All of them return ``Column`` expressions built from Spark built-ins, so they
run inside whole-stage codegen. Only the glob translation happens on the
driver (a pattern is a parameter, not data).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: shard file names look like  name_YYYYMMDD-<digits>.<ext>
# (spelled with character classes, so one text serves Java's and DuckDB's regexes)
SHARD_NAME_PATTERN = r"^(.+?)_([0-9]{8})-[0-9]+[.]"

_URI = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)(/(.*))?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_uri(uri, strict: bool = False, scheme: str | None = None) -> Column:
    """``scheme://bucket/key`` -> ``struct(scheme, bucket, key)``.

    Tolerant form: a URI without a path gives ``key = ''``. Strict form: a
    path separator after the bucket is required. A URI with another scheme
    than ``scheme`` (when given), or none at all, fails the query with an
    error naming the value, as the reference raises on it.
    """
    u = _c(uri)
    scheme_ok = F.regexp_extract(u, _URI, 1)
    valid = u.rlike(_URI)
    if scheme is not None:
        valid = valid & (scheme_ok == F.lit(scheme))
    if strict:
        valid = valid & (F.regexp_extract(u, _URI, 3) != F.lit(""))
    label = "Invalid URI format: " if strict else "Invalid URI: "
    parsed = F.struct(
        scheme_ok.alias("scheme"),
        F.regexp_extract(u, _URI, 2).alias("bucket"),
        F.regexp_extract(u, _URI, 4).alias("key"),
    )
    return F.when(u.isNull(), F.lit(None)).when(valid, parsed).otherwise(
        F.raise_error(F.concat(F.lit(label), u))
    )


def basename(key) -> Column:
    """Text after the last ``/`` ('' for a trailing slash)."""
    return F.substring_index(_c(key), "/", -1)


def is_dir_marker(key) -> Column:
    """Object-store folder markers end with ``/``."""
    return _c(key).endswith("/")


def layout(key) -> Column:
    """``export/date/.../file`` -> ``struct(export_name, folder_date)``;
    null when the key has fewer than three parts. The date part is text."""
    k = _c(key)
    upto_second = F.substring_index(k, "/", 2)  # the whole key when it has < 2 slashes
    return F.when(
        upto_second != k,
        F.struct(F.substring_index(k, "/", 1).alias("export_name"),
                 F.substring_index(upto_second, "/", -1).alias("folder_date")),
    )


def shard_fields(filename) -> Column:
    """``name_YYYYMMDD-N.ext`` -> ``struct(export_name, folder_date)``;
    null when the name does not match."""
    f = _c(filename)
    return F.when(
        f.rlike(SHARD_NAME_PATTERN),
        F.struct(
            F.regexp_extract(f, SHARD_NAME_PATTERN, 1).alias("export_name"),
            F.regexp_extract(f, SHARD_NAME_PATTERN, 2).alias("folder_date"),
        ),
    )


def _glob_set(body: str) -> str:
    """The inside of ``[...]`` as a Java character class. Java gives ``[``,
    ``&``, ``^`` and more a meaning there, so every literal is escaped."""
    negated, body = body[:1] == "!", body[1:] if body[:1] == "!" else body
    out, i = [], 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            low, high = body[i], body[i + 2]
            if low <= high:  # an empty range matches nothing
                out.append(f"{_literal(low)}-{_literal(high)}")
            i += 3
        else:
            out.append(_literal(body[i]))
            i += 1
    if not out:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(out)}]"


def _literal(char: str) -> str:
    return char if char.isalnum() else f"\\x{{{ord(char):x}}}"


def glob_to_regex(pattern: str) -> str:
    """I4 helper: a case-sensitive shell glob (``* ? [seq] [!seq]``) as an
    anchored Java regex for ``rlike``. A ``[`` that is never closed is itself."""
    out, i = [], 0
    while i < len(pattern):
        char = pattern[i]
        i += 1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif char == "[":
            first = i + (pattern[i : i + 1] == "!")
            close = pattern.find("]", first + 1)  # a ']' that comes first is a member
            if close < 0:
                out.append(_literal(char))
            else:
                out.append(_glob_set(pattern[i:close]))
                i = close + 1
        else:
            out.append(_literal(char))
    return f"(?s)\\A{''.join(out)}\\z"


@dataclass(frozen=True)
class ListingRule:
    """I4: where a listing starts and which objects it keeps. Only ``*`` makes
    a glob of a prefix; ``[ { ?`` are then part of the glob, and are plain
    characters in a prefix without one."""

    prefix: str
    glob: str | None

    @classmethod
    def parse(cls, text: str, pattern: str | None = None) -> "ListingRule":
        literal, star, _ = text.partition("*")
        if not star:
            return cls(text, pattern)
        folder = literal[: literal.rindex("/") + 1] if "/" in literal else ""
        return cls(folder, text.removeprefix(folder))

    @property
    def folder(self) -> str:
        """The deepest folder that the prefix names in full."""
        return self.prefix[: self.prefix.rfind("/")] if "/" in self.prefix else ""


def glob_match(filename, pattern: str) -> Column:
    return _c(filename).rlike(glob_to_regex(pattern))


def location(bucket, key) -> Column:
    """Full location of an inventory object: ``bucket`` (a listing root URI)
    joined to ``key`` with exactly one separator."""
    return F.concat(F.regexp_replace(_c(bucket), "/+$", ""), F.lit("/"), _c(key))


def object_uri(scheme: str, bucket, key) -> Column:
    """``scheme://bucket/key`` from inventory columns."""
    return F.concat(F.lit(f"{scheme}://"), _c(bucket), F.lit("/"), _c(key))


def target_dir(base: str, date: str | None = None, export_name: str | None = None) -> str:
    """``base[/date][/export]`` (driver-side parameter)."""
    out = base.rstrip("/") or "/"
    for part in (date, export_name):
        if part:
            out = f"{out.rstrip('/')}/{part}"
    return out
