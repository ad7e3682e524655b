"""Secrets: keyword hits of an Aho-Corasick automaton, anchored patterns, embedded checksums.

One automaton finds all keywords in a text whose A-Z are lower-cased; patterns are tried
only where a keyword stands. Hexadecimal strings have no keyword: their hits are places at
a fixed distance of which a long enough run must cover several. Tokens with an embedded
checksum are reported only if it holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockloom.llm.words import slices, text_bytes

# Base kinds first, in the order that breaks ties; then those with a checksum.
KINDS = ("assign", "access", "hex", "github", "npm", "xkey")
BASE = 3
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_CHARS = 24
# A run of HEX_CHARS covers at least two places in a row at this distance.
HEX_STEP = 8
# Public prefixes of tokens that carry their own checksum.
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
XKEY = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
KEYWORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"),
    "akia": "access",
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "github"),
    "npm_": "npm",
    "xprv": "xkey",
}
_DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DIGITS58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def crc_holds(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of those before, in base 62."""
    value = 0
    for char in match[2]:
        value = value * 62 + _DIGITS62.index(char)
    return value == zlib.crc32(match[1].encode())


def base58_holds(match: re.Match) -> bool:
    """The last four of 82 bytes are the double SHA-256 of those before."""
    value = 0
    for char in match[0]:
        value = value * 58 + _DIGITS58.index(char)
    if value.bit_length() > 82 * 8:
        return False
    raw = value.to_bytes(82, "big")
    return sha256(sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


# What follows a keyword, and which of its matches are reported.
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (GITHUB, crc_holds),
    "npm": (NPM, crc_holds),
    "xkey": (XKEY, base58_holds),
}


def keyword_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of what keyword hits lead to.

    Leftmost and non-overlapping per kind; a match that is not reported still takes its
    characters.
    """
    spans = []
    free = dict.fromkeys(RULES, 0)
    for end, (length, kind) in automaton().iter(text.translate(_LOWER)):
        start = end - length + 1
        if start < free[kind]:
            continue
        pattern, reported = RULES[kind]
        found = pattern.match(text, start)
        if found:
            free[kind] = found.end()
            if reported(found):
                spans.append((start, KINDS.index(kind), found.end()))
    return spans


def hex_rows(data: np.ndarray, bounds: np.ndarray) -> set[int]:
    """Texts that may hold a long hexadecimal run: several digits at a fixed distance."""
    table = np.zeros(256, dtype=bool)
    table[list(b"0123456789abcdef")] = True
    sampled = table[data[::HEX_STEP]]
    need = HEX_CHARS // HEX_STEP
    rows = np.ones(max(0, len(sampled) - need + 1), dtype=bool)
    for i in range(need):
        rows &= sampled[i : len(sampled) - need + 1 + i]
    at = np.flatnonzero(rows) * HEX_STEP
    # Only where all bytes between the places are digits as well.
    span = (need - 1) * HEX_STEP + 1
    whole = table[data[at[:, None] + np.arange(span)]].all(axis=1) if len(at) else rows[:0]
    return set((np.searchsorted(bounds, at[whole], side="right") - 1).tolist())


def hex_spans(text: str) -> list[tuple[int, int, int]]:
    rank = KINDS.index("hex")
    return [
        (m.start(), rank, m.end())
        for m in re.finditer(rf"[0-9a-f]{{{HEX_CHARS},}}", text)
    ]


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[rank]}:{start}:{end}" for start, rank, end in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS[:BASE]), "base_sha256", "spans"]
    for batch in batches:
        for part in slices(batch, "text"):
            with_hex = hex_rows(*text_bytes(part.column("text")))
            counts = [[] for _ in range(BASE)]
            digests, all_spans = [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                spans = keyword_spans(text) if text else []
                if row in with_hex:
                    spans += hex_spans(text)
                spans.sort()
                base = [s for s in spans if s[1] < BASE]
                for rank in range(BASE):
                    counts[rank].append(sum(s[1] == rank for s in base))
                digests.append(sha256(span_text(base).encode()).hexdigest())
                all_spans.append(span_text(spans))
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(digests, pa.string()),
                    pa.array(all_spans, pa.string()),
                ],
                names,
            )


def secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts per base kind, their digest, and all spans.

    Spans are kind:start:end, code points, end exclusive, sorted by start and then kind.
    A null or empty text has none; repeated rows and null ids are kept as they are; other
    columns are ignored.
    """
    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS[:BASE])
    return docs.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id bigint, {counts}, base_sha256 string, spans string"
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by asterisks; columns are kept."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                spans = sorted(keyword_spans(text) + hex_spans(text)) if text else []
                pieces, done = [], 0
                for start, _, end in spans:
                    if end > done:
                        pieces += [text[done:start], "*" * (end - max(start, done))]
                        done = end
                texts.append("".join([*pieces, text[done:]]) if spans else text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.record_batch(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
