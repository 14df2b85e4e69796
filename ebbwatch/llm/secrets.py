"""Secret scans: keywords by an Aho-Corasick automaton, patterns only where one was hit, then checksums.

Runs of hexadecimal digits have no keyword; they are found by the lengths of runs of their byte class.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.llm.common import LOWER, add_by_shard, utf8

#: In the order in which spans with one start are listed. Fixed values.
BASE_KINDS = ("assign", "access", "hex")
CHECKED_KINDS = ("github", "npm")
KINDS = BASE_KINDS + CHECKED_KINDS
#: Kind: keywords in lower case, pattern at a keyword, least length of the match or its last group. Fixed values.
RULES = {
    "assign": (
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        rb"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
    ),
    "access": (("akia",), rb"(AKIA[A-Z0-9]+)", 20),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", 36),
    "npm": (("npm_",), rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", 36),
}
MIN_HEX = 24
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_IS_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))


def checksum62(body: bytes) -> bytes:
    """The six base-62 digits of the CRC-32 that issued tokens carry at their end."""
    crc, digits = zlib.crc32(body), []
    for _ in range(6):
        crc, digit = divmod(crc, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits))


class Scanner:
    def __init__(self):
        self.keywords = ahocorasick.Automaton()
        for kind, (words, _, _) in RULES.items():
            for word in words:
                self.keywords.add_word(word, (kind, len(word)))
        self.keywords.make_automaton()
        self.patterns = {kind: re.compile(pattern) for kind, (_, pattern, _) in RULES.items()}

    def scan(self, joined: bytes) -> list[tuple[int, int, int]]:
        """(start, end, kind number) of texts joined by NUL, which no pattern matches; byte offsets."""
        starts: dict[str, list[int]] = {kind: [] for kind in RULES}
        for end, (kind, size) in self.keywords.iter(joined.translate(LOWER).decode("latin-1")):
            starts[kind].append(end - size + 1)
        found = []
        for kind, places in starts.items():
            match, least, free = self.patterns[kind].match, RULES[kind][2], 0
            for start in sorted(places):
                if start < free or not (m := match(joined, start)):
                    continue
                free = m.end()
                body = m[1]
                if len(body) < least or kind in CHECKED_KINDS and checksum62(body[:-6]) != body[-6:]:
                    continue
                found.append((start, m.end(), KINDS.index(kind)))
        hexed = _IS_HEX[np.frombuffer(joined, np.uint8)]
        edges = np.flatnonzero(np.diff(hexed.view(np.int8), prepend=0, append=0))
        starts_, ends = edges[::2], edges[1::2]
        long = ends - starts_ >= MIN_HEX
        found += [(a, b, 2) for a, b in zip(starts_[long].tolist(), ends[long].tolist(), strict=True)]
        return sorted(found, key=lambda x: (x[0], x[2]))


_SCANNER: Scanner | None = None


def _scanner() -> Scanner:
    """One automaton for each Python worker; it does not travel with tasks."""
    global _SCANNER
    if _SCANNER is None:
        _SCANNER = Scanner()
    return _SCANNER


def find_secrets(documents: DataFrame, text: str = "text", shard_bytes: int = 4_000_000) -> DataFrame:
    """``documents`` with ``secrets``: kind, start and end (code points, end exclusive), by start, then kind.

    Spans of the checksum kinds are reported only with a right checksum. Null is an empty text. Repeated rows are
    reported each, whole texts are scanned, an empty table gives an empty result. An input column named
    ``secrets`` is replaced.
    """
    span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    field = T.StructField(
        "secrets",
        T.ArrayType(
            T.StructType(
                [
                    T.StructField("kind", T.StringType()),
                    T.StructField("start", T.LongType()),
                    T.StructField("end", T.LongType()),
                ]
            )
        ),
    )

    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        texts = [t or b"" for t in utf8(shard.column(text))]
        first = [0]
        for t in texts:
            first.append(first[-1] + len(t) + 1)
        rows: list[list[dict]] = [[] for _ in texts]
        points, at = np.zeros(0, np.int64), -1
        for start, end, kind in _scanner().scan(b"\0".join(texts)):
            d = bisect_right(first, start) - 1
            if d != at:
                bytes_ = np.frombuffer(texts[d], np.uint8)
                points, at = np.concatenate([[0], np.cumsum((bytes_ & 0xC0) != 0x80)]), d
            place = {"start": int(points[start - first[d]]), "end": int(points[end - first[d]])}
            rows[d].append({"kind": KINDS[kind], **place})
        return [pa.array(rows, pa.list_(pa.struct(span)))]

    return add_by_shard(documents, text, [field], compute, shard_bytes)


def count_kind(kind: str, secrets: str = "secrets") -> Column:
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("bigint")


def listed(base_only: bool = False, secrets: str = "secrets") -> Column:
    """kind:start:end of the spans, comma-joined."""
    chosen = F.filter(secrets, lambda s: s["kind"].isin(*BASE_KINDS)) if base_only else F.col(secrets)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
