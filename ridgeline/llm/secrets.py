"""Secret scans: patterns of known kinds, and strings that a tokenizer's vocabulary cannot shorten.

A vocabulary learnt on ordinary text covers words with few tokens, so a low
number of characters per token exposes random strings. Candidates are runs of
key characters with a letter. Names and values are judged apart, and so are the
parts of paths and identifiers: known digests (hexadecimal, of a digest's
length), UUIDs and parts that the vocabulary covers are left out. Letters of one
case are no sign of a word: only the vocabulary tells base36 and base32 from names.

Null texts are empty. A text without secrets returns one row without spans;
repeated rows return repeated rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import arrow_map, documents

#: The kinds in order: pattern and the least length of the group (fixed values).
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
# The same matches with the length inside the pattern: both are runs that end where the class ends.
_QUICK = {"access": re.compile(r"AKIA[A-Z0-9]{14,}"), "hex": re.compile(r"[0-9a-f]{16,}")}
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-2 family).
DIGESTS = (32, 40, 56, 64, 96, 128)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_LEAST = 16
_HEX = re.compile(r"[0-9a-fA-F]+")
#: UUIDs, and what stands between the separators of paths and identifiers.
_PART = re.compile(r"(?<![0-9A-Za-z])(?P<uuid>[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})(?![0-9A-Za-z])|[0-9A-Za-z+]+")
_CASED = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_LETTER = re.compile(r"[A-Za-z]")


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def covered(part: str, encoding, ratio: float) -> bool:
    """Digests, and what the vocabulary covers with few tokens: as it stands, or words without digits in lower case."""
    if _HEX.fullmatch(part) and len(part) in DIGESTS:
        return True
    tokens = len(encoding.encode_ordinary(part))
    words = _CASED.findall(part) if part.isalpha() else ()
    if words and 4 * len(words) <= len(part) or len(words) == 1:
        tokens = min(tokens, sum(len(encoding.encode_ordinary(w.lower())) for w in words))
    if tokens == 1 < len(part) and words:
        return True
    return len(part) >= ratio * tokens and bool(_LETTER.search(part))


def random_parts(text: str, encoding, ratio: float) -> list[tuple[int, int]]:
    """(start, end) of what the vocabulary cannot shorten in a run of key characters, without the names around it."""

    parts = [(m.start(), m.end(), bool(m["uuid"]) or covered(m[0], encoding, ratio), bool(m["uuid"])) for m in _PART.finditer(text)]

    def dense(start: int, end: int, own: list[tuple]) -> bool:
        """Long enough, with a letter, mostly of parts that are not covered, and too many tokens."""
        s = text[start:end]
        words = sum(p[1] - p[0] for p in own if p[2])
        return len(s) >= _LEAST and 2 * words <= len(s) and bool(_LETTER.search(s)) and len(s) < ratio * len(encoding.encode_ordinary(s))

    def within(start: int, end: int) -> list[tuple[int, int]]:
        own = [p for p in parts if start <= p[0] and p[1] <= end]
        # Covered parts of four characters and more end a run; shorter ones also occur inside keys.
        runs: list[list[tuple]] = [[]]
        for p in own:
            if p[2] and (p[3] or p[1] - p[0] >= 4):
                runs.append([])
            else:
                runs[-1].append(p)
        found = [(r[0][0], r[-1][1]) for r in runs if r and dense(r[0][0], r[-1][1], r)]
        # A key that a covered part happens to divide is taken whole.
        return found or [(start, end)] * dense(start, end, own)

    # Padding belongs to the value before it; any other "=" stands between a name and its value.
    sides = [m.span() for m in re.finditer(r"[^=]+(=+$)?", text)]
    found = [x for side in sides for x in within(*side)]
    return found or within(0, len(text))


def find(text: str, encoding, ratio: float) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text, by start and then kind."""
    spans = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        for m in _QUICK.get(kind, pattern).finditer(text):
            if m.end(group if kind == "assign" else 0) - m.start(group if kind == "assign" else 0) >= least:
                spans.append((m.start(), rank, kind, m.end()))
    for m in _CANDIDATE.finditer(text):
        spans += [(m.start() + a, len(KINDS), "random", m.start() + b) for a, b in random_parts(m[0], encoding, ratio)]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def scan(docs: DataFrame, vocabulary: str, pattern: str, ratio: float = 2.2) -> DataFrame:
    """doc_id and the spans (kind, first, last) of every text.

    ``vocabulary`` is a tiktoken rank file that every executor has, ``pattern``
    its pre-tokenizer; strings with fewer than ``ratio`` characters per token count.
    """

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        encoding = _encoding(vocabulary, pattern)
        found = [find(t, encoding, ratio) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "spans": [[{"kind": k, "first": a, "last": b} for k, a, b in x] for x in found]}

    return arrow_map(documents(docs), each, "doc_id long, spans array<struct<kind:string,first:long,last:long>>", most=1 << 23)


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the query: counts by kind, the digest of base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != "random")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind, *_ in KINDS),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        count("random").alias("n_random"),
    )
