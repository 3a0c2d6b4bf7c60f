"""Secret scans: fixed patterns, and a token-efficiency test for the rest.

A byte-pair vocabulary packs ordinary words into few tokens, while random
strings fall apart into many, so a string with few characters per token is
probably a key. Candidates are long runs of key characters; known digests
(hexadecimal of a digest's length), UUIDs, numbers, dates and identifiers are
excluded before the test, and runs inside a pattern's span are already found.
An identifier is known by its words, not by its kinds of characters: it has
several parts, and the vocabulary packs each of them like a word.

The vocabulary is a tiktoken rank file; its path is a parameter. It travels to
the tasks as a broadcast of its bytes (about 1 MB, fixed), so executors need no
local copy. One pass over the texts, no shuffle.

Defined results: a null text counts as empty and has no spans; a null id is an
id; repeated rows each get a row; an empty table gives an empty result; other
columns pass through ``annotate`` under any name.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that goes with the vocabulary's ranks (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The kinds in the order in which equal starts are listed; the last is the method's.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as all runs of 24 or more
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Lengths of hexadecimal MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
HEX_ANY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9+/_=-]+")
#: Words, acronyms or short numbers joined by separators or capitals. Parts are
#: maximal and possessive, so there is one way to cut a run and it takes linear time.
_PART = r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,12}+(?![A-Z])|[0-9]{1,4}+(?![0-9]))"
IDENTIFIER = re.compile(rf"{_PART}(?:[-_/=+]*+{_PART})*+[-_/=+]*+")
#: Runs of one class of characters in an identifier; random text changes class often.
CLASS_RUN = re.compile(r"[A-Z]*[a-z]+|[A-Z]+|[0-9]+")


def _encoder(rank_file: bytes):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
    return tiktoken.Encoding("secret-scan", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def wordlike(part: str, encoder, max_ratio: float) -> bool:
    """One token, or more than ``max_ratio`` characters a token, in any case of letters."""
    count = len(encoder.encode_ordinary(part.lower()))
    return count == 1 or len(part) > max_ratio * count


def known(run: str, encoder, max_ratio: float) -> bool:
    """Digests, UUIDs, numbers and identifiers of several wordlike parts."""
    if NUMBER.fullmatch(run) or UUID.fullmatch(run):
        return True
    if HEX_ANY.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    if IDENTIFIER.fullmatch(run):
        parts = CLASS_RUN.findall(run)
        return len(parts) > 1 and len(run) >= 4.5 * len(parts) \
            and all(p.isdecimal() or wordlike(p, encoder, max_ratio) for p in parts)
    return False


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def random_spans(text: str, base: list, encoder, max_ratio: float) -> list[tuple[int, int, int]]:
    """Runs outside the ``base`` spans with ``max_ratio`` characters a token or fewer."""
    found, at, reach = [], 0, 0
    for m in RUN.finditer(text):
        start, end, run = m.start(), m.end(), m[0]
        while at < len(base) and base[at][0] < end:  # both in order of start
            reach = max(reach, base[at][2])
            at += 1
        if reach > start or known(run, encoder, max_ratio):
            continue
        if len(run) <= max_ratio * len(encoder.encode_ordinary(run)):
            found.append((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def redact(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """``text`` with each maximal run of overlapping spans replaced by ``mask``."""
    out, at = [], 0
    for s, _, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def scanner(spark: SparkSession, vocabulary: str = VOCABULARY, max_ratio: float = 2.0,
            mask: str | None = None) -> Callable:
    """A function of the text column: struct(n_assign, n_access, n_hex, base,
    spans, clean); base and spans are joined lists, ``clean`` is the text with
    all spans masked (null if there are none or no mask is given)."""
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())

    def row(text: str | None, encoder) -> tuple:
        text = text or ""
        base = base_spans(text)
        spans = base + random_spans(text, base, encoder, max_ratio)
        count = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        clean = redact(text, spans, mask) if mask is not None and spans else None
        return *count, joined(base), joined(spans), clean

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base string, spans string, clean string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(ranks.value)
        for texts in batches:
            yield pd.DataFrame([row(t, encoder) for t in texts],
                               columns=["n_assign", "n_access", "n_hex", "base", "spans", "clean"])

    return scan


def annotate(docs: DataFrame, vocabulary: str = VOCABULARY, max_ratio: float = 2.0,
             mask: str | None = None, text_col: str = "text") -> DataFrame:
    """(row, found): ``row`` is the whole input row as one struct."""
    scan = scanner(docs.sparkSession, vocabulary, max_ratio, mask)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.select("row", scan(F.col("row")[text_col]).alias("found"))
