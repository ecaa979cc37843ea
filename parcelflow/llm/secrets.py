"""Secrets in texts, and credentials whose parts stand in several places.

Strong parts are found by form alone: assignments of secret-like names, access identifiers
and long hexadecimal runs. Two weak forms, a bare 40-character key (``key``) and an address
of a service (``endpoint``), mean nothing alone. An interval join per document decides about
them: every part opens a scope of ``REACH`` code points to both sides, cut at blank lines, and
a weak part is reported only when a complementary part lies in its scope: a key next to an
access identifier, an endpoint next to an access identifier together with a secret, or next to
an assigned secret.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import batches, texts

#: Code points that a scope reaches to both sides of a part.
REACH = 400

KINDS = ("assign", "access", "hex", "key", "endpoint")
BASE = KINDS[:3]

# The forms of the parts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEY = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"(?:https?|s3|jdbc:[a-z]+|amqps?|redis|mongodb|postgres(?:ql)?)://[^\s\"'<>]+")
BLANK = re.compile(r"\n[^\S\n]*\n")

Part = tuple[int, int, str]


def base_parts(text: str) -> list[Part]:
    """(start, end, kind) of the parts found by form alone, in order of start, then kind."""
    found: list[Part] = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                found.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                found.append((m.start(), m.end(), "access"))
    # The longest runs of 32 and more are all runs that pass the length.
    found.extend((m.start(), m.end(), "hex") for m in HEX.finditer(text))
    return in_order(found)


def weak_parts(text: str) -> list[Part]:
    found = [
        (m.start(), m.end(), "key")
        for m in KEY.finditer(text)
        if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])
    ]
    if "://" in text:
        found.extend((m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text))
    return in_order(found)


def in_order(parts: list[Part]) -> list[Part]:
    return sorted(parts, key=lambda p: (p[0], KINDS.index(p[2]), p[1]))


class Scopes:
    """The parts of one kind of a document, sorted, for joins by overlapping intervals."""

    def __init__(self, parts: list[Part], breaks: list[int]):
        self.parts = sorted(parts)
        self.starts = [p[0] for p in self.parts]
        self.breaks = breaks
        # Starts rise and parts of one kind don't overlap, so their ends rise too.
        self.ends = [p[1] for p in self.parts]

    def nearest(self, part: Part, reach: int) -> Part | None:
        """The closest part in the scope of ``part``; of two, the earlier."""
        low, high = self.scope(part, reach)
        first, last = bisect_right(self.ends, low), bisect_left(self.starts, high)
        if first >= last:
            return None
        at = bisect_left(self.starts, part[0], first, last)
        near = self.parts[max(first, at - 1) : min(last, at + 1)]
        return min(near, key=lambda p: (max(p[0] - part[1], part[0] - p[1], 0), p[0]), default=None)

    def scope(self, part: Part, reach: int) -> tuple[int, int]:
        before, after = bisect_right(self.breaks, part[0]), bisect_left(self.breaks, part[1])
        low = max(part[0] - reach, self.breaks[before - 1] if before else 0)
        high = min(part[1] + reach, self.breaks[after] if after < len(self.breaks) else part[1] + reach)
        return low, high


class Cover:
    """The code points that some part covers, as disjoint intervals."""

    def __init__(self, parts: list[Part]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end, _ in sorted(parts):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, part: Part) -> bool:
        at = bisect_left(self.starts, part[1])
        return at > 0 and self.ends[at - 1] > part[0]


def linked(text: str, base: list[Part], reach: int = REACH) -> tuple[list[Part], list[list[Part]]]:
    """The weak parts that have their complement in scope, and the credentials: for each access
    identifier with a secret, and each assigned secret with an endpoint, its parts."""
    access = [p for p in base if p[2] == "access"]
    assign = [p for p in base if p[2] == "assign"]
    if not access and not assign:
        return [], []
    # A key or an endpoint within a base part is that part again.
    taken = Cover(base)
    weak = [p for p in weak_parts(text) if not taken.meets(p)]
    breaks = [m.start() for m in BLANK.finditer(text)]
    of = {kind: Scopes([p for p in [*base, *weak] if p[2] == kind], breaks) for kind in KINDS}
    shown: set[Part] = set()
    credentials: list[list[Part]] = []

    def secret_near(part: Part) -> Part | None:
        near = [of[k].nearest(part, reach) for k in ("key", "assign", "hex")]
        return next((p for p in near if p), None)

    for key in of["key"].parts:
        if of["access"].nearest(key, reach):
            shown.add(key)
    armed: list[Part] = []
    for part in access:
        secret = secret_near(part)
        if secret:
            armed.append(part)
            place = of["endpoint"].nearest(part, reach)
            credentials.append([p for p in (part, secret, place) if p])
    with_secret = Scopes(armed, breaks)
    for place in of["endpoint"].parts:
        if of["assign"].nearest(place, reach) or with_secret.nearest(place, reach):
            shown.add(place)
    used = {p for c in credentials for p in c}
    for part in assign:
        place = of["endpoint"].nearest(part, reach)
        if place and part not in used:
            credentials.append([part, place])
    return in_order(list(shown)), credentials


def _span_type() -> pa.DataType:
    return pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``spans`` (arrays of kind, start and
    end in code points, end exclusive) and ``credentials`` (an array of linked parts each).

    ``spans`` holds all of ``base`` and the weak parts that were linked. Null and empty texts have
    no spans; ids may be null or repeat.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("base", pa.list_(_span_type())),
            ("spans", pa.list_(_span_type())),
            ("credentials", pa.list_(pa.list_(_span_type()))),
        ]
    )

    def spans(parts: list[Part]) -> list[dict]:
        return [{"kind": k, "start": s, "end": e} for s, e, k in parts]

    def rows(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                base = base_parts(text)
                weak, credentials = linked(text, base, reach)
                yield doc_id, spans(base), spans(in_order(base + weak)), [spans(c) for c in credentials]

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return texts(docs).mapInArrow(
        lambda incoming: batches(rows(incoming), schema),
        f"doc_id bigint, base {span}, spans {span}, credentials array<{span}>",
    )


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``find_secrets``."""

    def joined(column: str):
        each = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(each, ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(k) for k in BASE),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.size("credentials").cast("bigint").alias("n_credentials"),
    )


def digest_of(parts: list[Part]) -> str:
    """The digest of ``span_digests`` for parts at hand."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in parts).encode()).hexdigest()
