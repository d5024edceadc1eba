"""Secret scans: fixed patterns, and the Shannon entropy of sliding windows over candidate strings.

Candidates are runs of token characters. In each, and for each character class, the longest runs of the class are searched with the
threshold of the class, so that what a string is joined to by = or / doesn't decide on it. A window's entropy is kept up by adding the
character that enters and taking away the one that leaves. An allow list suppresses found spans that only look random: it is asked for each span,
never for what the span is a part of, and names made of words are told from random letters by their segments, vowels and consonants.
Positions are code points; texts are searched as UTF-8, in which all patterns are ASCII.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from curatrix.llm.common import doc_rows, slices, text_buffers

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: Bits a character that a window of a class has at least; log2(WINDOW) = 4.32 is the most.
CLASSES = (
    ("hex", re.compile(rb"[0-9a-fA-F]+"), 3.0),
    ("alnum", re.compile(rb"[0-9A-Za-z]+"), 3.6),
    ("base64 without =", re.compile(rb"[0-9A-Za-z+/_-]+"), 3.8),
    ("base64", re.compile(rb"[0-9A-Za-z+/=_-]+"), 3.8),
)
#: Strings that are no secrets however random they look: without a letter, and UUIDs. Words are judged by `wordy`.
ALLOW = (re.compile(rb"[0-9+/=_-]*"), re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"))
#: Words of a name in camel case or with separators; at least so many letters; least share of vowels, most consonants in a row.
SEGMENT = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
LEAST_WORD, LEAST_VOWELS, MOST_CONSONANTS = 3, 0.25, 5
#: Letters that are written as several and said as one consonant.
_ONE = re.compile(rb"sch|tch|ch|sh|th|ph|ck|gh", re.IGNORECASE)
_CONSONANTS = re.compile(rb"[^aeiouy]+", re.IGNORECASE)
_VOWELS = re.compile(rb"[aeiou]", re.IGNORECASE)
#: A name's number, and the share of a name's letters that are in words.
_NUMBER = re.compile(rb"[-_]?[0-9]{1,10}$")
LEAST_WORDY, FEW_LETTERS = 0.6, 10
#: Words by which a span says that it is no secret, and filler that takes away the windows that hold it, but no others.
WORDS = re.compile(rb"example|placeholder|changeme", re.IGNORECASE)
FILLER = re.compile(rb"xxxx|0000|1234567|abcdef0", re.IGNORECASE)
#: An allowed string that a found span may be a part of.
UUID = re.compile(rb"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])")

_PLOGP = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 1)]
_HEX = np.zeros(256, bool)
_HEX[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("f") + 1)]] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/=_-"]] = True
_HINTS = (b"passw", b"secret", b"token", b"api")


def _runs(flat: np.ndarray, bounds: np.ndarray, kind: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(text, start, end) of every longest run of such bytes that has at least this length."""
    lo, hi = int(bounds[0]), int(bounds[-1])
    inside = kind[flat[lo:hi]]
    if not len(inside):
        return []
    edge = np.zeros(len(inside) + 1, bool)
    edge[np.minimum(bounds - lo, len(inside))] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - start >= least
    start, end = start[long], end[long]
    doc = np.searchsorted(bounds - lo, start, "right") - 1
    base = (bounds - lo)[doc]
    return list(zip(doc.tolist(), (start - base).tolist(), (end - base).tolist(), strict=True))


def random_windows(candidate: bytes, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Unions of the windows whose entropy is at least this, as (start, end)."""
    count = [0] * 256
    total, found = 0.0, []
    for i, c in enumerate(candidate):
        total += _PLOGP[count[c] + 1] - _PLOGP[count[c]]
        count[c] += 1
        if i >= window - 1:
            if math.log2(window) - total / window >= least - 1e-9:
                start = i - window + 1
                if found and start <= found[-1][1]:
                    found[-1][1] = i + 1
                else:
                    found.append([start, i + 1])
            gone = candidate[i - window + 1]
            total += _PLOGP[count[gone] - 1] - _PLOGP[count[gone]]
            count[gone] -= 1
    return [(a, b) for a, b in found]


def _without(spans: list[tuple[int, int]], fillers: list[tuple[int, int]], window: int = WINDOW) -> list[tuple[int, int]]:
    """The unions of the windows of some spans that hold no filler whole."""
    out = []
    for a, b in spans:
        first = a  # of the windows not looked at yet
        for x, y in fillers:
            if y <= first or x < a or y > b:
                continue
            low, high = max(y - window, a), min(x, b - window)  # the windows that begin here hold it
            if low <= high:
                if first < low:
                    out.append((first, low - 1 + window))
                first = max(first, high + 1)
        if first <= b - window:
            out.append((first, b))
    return out


def wordy(candidate: bytes) -> np.ndarray:
    """How many bytes of the candidate's words, as far as they can be said, are before each place.

    Random letters of both cases have few segments that could be words; those of one case have few vowels or many consonants in a row."""
    out = np.zeros(len(candidate) + 1, np.int64)
    for m in SEGMENT.finditer(candidate):
        said = _ONE.sub(b"k", m[0])
        if len(m[0]) >= LEAST_WORD and len(_VOWELS.findall(m[0])) >= LEAST_VOWELS * len(said) and max(map(len, _CONSONANTS.findall(said)), default=0) <= MOST_CONSONANTS:
            out[m.start() + 1 : m.end() + 1] = 1
    return np.cumsum(out)


def _is_name(candidate: bytes, a: int, b: int, words: np.ndarray) -> bool:
    """Whether a span is words, joined in camel case or by separators, and perhaps a number."""
    number = _NUMBER.search(candidate[a:b])
    end = a + number.start() if number else b
    rest = candidate[a:end]
    if any(0x30 <= c <= 0x39 for c in rest):
        return False
    letters = sum(c not in b"+/=_-" for c in rest)
    return letters <= FEW_LETTERS or int(words[end] - words[a]) >= LEAST_WORDY * letters


def entropy_spans(candidate: bytes) -> list[tuple[int, int]]:
    """Unions of the spans of a candidate that are random for a class, without spans that the allow list has, that are part of a UUID or that are words."""
    if ALLOW[0].fullmatch(candidate):  # then it has all spans
        return []
    known, fillers = [m.span() for m in UUID.finditer(candidate)], [m.span() for m in FILLER.finditer(candidate)]
    found: set[tuple[int, int]] = set()
    for _, members, bits in CLASSES:
        for run in members.finditer(candidate):
            if len(run[0]) >= WINDOW:
                found |= {(run.start() + a, run.start() + b) for a, b in random_windows(run[0], bits)}
    out: list[tuple[int, int]] = []
    if not found:
        return out
    words = wordy(candidate)
    for a, b in _without([x for x in sorted(found) if not WORDS.search(candidate, *x)], fillers):
        inner = candidate[a:b].strip(b"+/=_-")
        if any(x.fullmatch(inner) for x in ALLOW) or _is_name(candidate, a, b, words) or any(x <= a and b <= y for x, y in known):
            continue
        out.append((a, b))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _text_spans(text: bytes, hexes: list[tuple[int, int]], candidates: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes, sorted by start and then kind."""
    found = [(a, b, 2) for a, b in hexes]
    if b"AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    low = text.lower()
    if any(h in low for h in _HINTS) and (b"=" in text or b":" in text):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    # the fixed patterns' spans as sorted unions, in which one search tells whether a place is taken
    ends: list[int] = []
    starts: list[int] = []
    for x, y, _ in sorted(found):
        if ends and x < ends[-1]:
            ends[-1] = max(ends[-1], y)
        else:
            starts.append(x)
            ends.append(y)
    extra = []
    for a, b in candidates:
        for s, e in entropy_spans(text[a:b]):
            k = bisect_right(ends, a + s)  # the first union that ends after the span's start
            if k == len(starts) or starts[k] >= a + e:
                extra.append((a + s, a + e, 3))
    return sorted(found + extra, key=lambda f: (f[0], f[2]))


def _told(text: bytes, found: list[tuple[int, int, int]]) -> list[str]:
    """The spans in code points: the bytes before a place that begin one."""
    if text.isascii() or not found:
        return [f"{KINDS[k]}:{a}:{b}" for a, b, k in found]
    places = np.unique([p for a, b, _ in found for p in (a, b)])
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    counts = np.cumsum([int(np.count_nonzero(begins[x:y])) for x, y in zip([0, *places[:-1]], places, strict=True)])
    of = dict(zip(places.tolist(), counts.tolist(), strict=True))
    return [f"{KINDS[k]}:{of[a]}:{of[b]}" for a, b, k in found]


def _scan(batches):
    for whole in batches:
        for batch in slices(whole, "text"):
            flat, bounds = text_buffers(batch.column("text"))
            hexes: dict[int, list] = {}
            candidates: dict[int, list] = {}
            for into, kind, least in ((hexes, _HEX, LEAST_HEX), (candidates, _TOKEN, WINDOW)):
                for doc, a, b in _runs(flat, bounds, kind, least):
                    into.setdefault(doc, []).append((a, b))
            counts, digests, spans = [[], [], []], [], []
            for i in range(len(batch)):
                text = flat[bounds[i] : bounds[i + 1]].tobytes()
                found = _text_spans(text, hexes.get(i, []), candidates.get(i, []))
                for k in range(3):
                    counts[k].append(sum(f[2] == k for f in found))
                told = _told(text, found)
                digests.append(hashlib.sha256(",".join(t for t, f in zip(told, found, strict=True) if f[2] < 3).encode()).hexdigest())
                spans.append(",".join(told))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(spans)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of docs(doc_id, text).

    spans: kind:start:end, comma-joined, in order of start and then kind; base_sha256 is of those of the fixed patterns.
    Null and empty texts have no spans; the digest is that of the empty string. Repeated rows give repeated results. No rows: no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return doc_rows(docs, "doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
