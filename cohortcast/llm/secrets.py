"""Secret scan with multipart credential linking.

Parts are spans of the text.  Strong parts stand for themselves:

* ``assign``  a named value (``password = ...``), value of 6 or more characters;
* ``access``  an access identifier (``AKIA...``) of 20 or more characters;
* ``hex``     a run of 24 or more lower-case hex digits.

Weak parts mean little alone:

* ``key``       a run of exactly 40 base64 characters with upper case, lower
  case and a digit: the shape of a secret half without its name;
* ``user``      a named account (``user = ...``);
* ``endpoint``  a URL or a ``host = ...`` value.

A credential has three complementary parts: an identifier (``access``,
``user``), a secret (``assign``, ``hex``, ``key``) and an endpoint.  Weak parts
are joined by interval with the other parts of their scope, a stretch of
``SCOPE_CHARS`` code points on either side, and reported

* beside a strong complement: a key beside an ``access``, a user beside an
  ``assign`` or ``hex``;
* beside a weak complement that a strong one vouches for in this way: a key
  beside such a user, a user beside such a key;
* as a triple of weak parts: user, key and endpoint where the scope of one of
  them holds the two others;
* an endpoint also beside an identifier and a secret that are reported.

A text's parts are sorted once; whether a sort of part lies in a scope is a
binary search in the prefix maxima of its ends (:class:`Beside`), so a text of
n parts takes n log n steps.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortcast.llm.common import sliced

# ---------------------------------------------------------------------------
# Kinds in the order of reports, their patterns and lengths.
# ---------------------------------------------------------------------------
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "user", "endpoint")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KEY = r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
USER = r"""(?:user|username|login|account|client_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,}"""
ENDPOINT = r"""https?://[A-Za-z0-9][^\x00-\x20"'<>]*|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"""
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Code points on either side of a weak part that make up its scope.
SCOPE_CHARS = 400
SLICE_BYTES = 4_000_000

_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def find_parts(text: str) -> list[tuple[int, int, int]]:
    """All parts of a text as (start, number of the kind, end), ascending."""
    found = []
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= MIN_ASSIGN:
            found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # the runs of a greedy [0-9a-f]+ that are long enough
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for m in _KEY.finditer(text):
        s = m[0]
        if any(c.isupper() for c in s) and any(c.islower() for c in s) and any(c.isdigit() for c in s):
            found.append((m.start(), 3, m.end()))
    if ":" in text or "=" in text:
        found += [(m.start(), 4, m.end()) for m in _USER.finditer(text)]
        found += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    return sorted(found)


_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(HEX[:-1] + "{%d,}" % MIN_HEX)
_KEY = re.compile(KEY)
_USER = re.compile(USER, re.I | re.A)
_ENDPOINT = re.compile(ENDPOINT, re.I | re.A)


class Beside:
    """Tells whether one of ``spans (start, kind, end)``, ascending, lies in a
    scope: of those that begin before its end, the furthest end decides."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s[0] for s in spans]
        self.furthest = list(itertools.accumulate((s[2] for s in spans), max))

    def __call__(self, span: tuple[int, int, int]) -> bool:
        n = bisect.bisect_right(self.starts, span[2] + SCOPE_CHARS)
        return n > 0 and self.furthest[n - 1] + SCOPE_CHARS >= span[0]

    def of(self, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        return [s for s in spans if self(s)]


def link(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The parts of a text that are reported, of all (start, kind, end) in
    ascending order."""
    kind = lambda *names: [p for p in found if KINDS[p[1]] in names]
    access, named, key, user, endpoint = kind("access"), kind("assign", "hex"), kind("key"), kind("user"), kind("endpoint")
    if not (key or user or endpoint):
        return found
    # beside a strong part, or a weak one that a strong one vouches for
    strong_key, strong_user = Beside(access).of(key), Beside(named).of(user)
    users = set(Beside(sorted([*named, *strong_key])).of(user))
    keys = set(Beside(sorted([*access, *strong_user])).of(key))
    # triples: the part whose scope holds the two others, and these
    near = {"key": Beside(key), "user": Beside(user), "endpoint": Beside(endpoint)}
    centre = {name: [p for p in spans if all(near[o](p) for o in near if o != name)]
              for name, spans in (("key", key), ("user", user), ("endpoint", endpoint))}
    of_triples = {name: {*centre[name], *[p for o in near if o != name for p in Beside(centre[o]).of(spans)]}
                  for name, spans in (("key", key), ("user", user), ("endpoint", endpoint))}
    users, keys = users | of_triples["user"], keys | of_triples["key"]
    ident, secret = Beside(sorted([*access, *users])), Beside(sorted([*named, *keys]))
    ends = {e for e in endpoint if ident(e) and secret(e)} | of_triples["endpoint"]
    return sorted([*access, *named, *users, *keys, *ends])


def _spans(docs: DataFrame, id_col: str, text_col: str, name: str, of: Callable[[str], list[tuple[int, int, int]]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for batch in sliced(whole, 1, SLICE_BYTES):
                found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in of(t or "")]
                         for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, shape)], names=[id_col, name])

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return narrow.mapInArrow(run, T.StructType([narrow.schema[0], T.StructField(name, _SPAN)]))


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, parts)``: every part of every whole text, weak ones too."""
    return _spans(docs, id_col, text_col, "parts", find_parts)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, spans)``: strong parts, and the weak parts that complementary
    parts in their scope vouch for, by start, then kind.

    A null or empty text has no spans; a null id stays null; equal rows give
    equal rows; other columns are not read.  Offsets are code points of the
    whole text, end exclusive.
    """
    return _spans(docs, id_col, text_col, "spans", lambda text: link(find_parts(text)))


def report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda p: p["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda p: p["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda p: F.concat_ws(
        ":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",")
    return scan(docs, id_col).select(id_col, *[count(k).alias(f"n_{k}") for k in BASE],
                                     F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                                     joined(F.col("spans")).alias("spans"))
