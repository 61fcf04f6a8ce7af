"""Personal data in texts: fixed patterns, and spans that a trained tagger adds to them.

The patterns find emails, IPs, payment cards and phone numbers. The tagger, a character-level
bidirectional LSTM with CRF transitions (``tagger``), is trained in numpy on a bounded sample of labelled
spans and on rewritings of them that the patterns miss (a phone number without plus, an email with
spaces around the sign, a card with dots). It learns how spans are written; the checks of their numbers (a card's checksum,
parts of an IP) follow on what it finds. It reads overlapping windows. All windows of a text are
reconciled at once: pieces of a span cut at a window's edge are joined, spans that touch one of the
patterns' go, and of those that overlap, the set of greatest total weight stays.

What is accepted as a span holds a digit or an ``@``; windows without either cannot yield one and are not
read. A window that has one reaches at least ``STRIDE`` characters to either side of it. Positions are code points, ends exclusive.

Edge cases: a null text is empty and has no spans. Rows are read one by one, so repeated rows have the
same spans. Without labelled spans in the sample nothing is trained and only the patterns count.
Columns besides id and text are never read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow, words
from .tagger import CHARACTERS, Tagger

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and between the starts of two. A text's spans of up to their difference lie whole in one.
WINDOW, STRIDE = 96, 48
#: Documents that the fit reads, about, at most, and windows that it learns from at most.
SAMPLE_ROWS, SAMPLE_WINDOWS = 3000, 4000
#: Surroundings of digits and signs that a text gives the sample (its first), and how often a text with spans is written anew.
SURROUNDINGS, WRITINGS = 8, 8
#: Mean chance of its tags that a span needs; shortest and longest span.
SURE, SHORTEST, LONGEST = 0.5, 7, 200
#: Windows decoded at a time.
AT_ONCE = 512

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = np.zeros(256, bool)
_ANCHOR[[*range(48, 58), 64]] = True

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    """As the leftmost matches of the whole pattern, from each sign back and forth: long words cost no retries."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the fixed patterns by kind."""
    digits = lambda s: "".join(c for c in s if "0" <= c <= "9")
    small = lambda s: len(s.lstrip("0")) <= 3 and int(s[-4:]) <= 255
    return {
        "email": list(_emails(text)),
        "ip": [m.span() for m in _IP.finditer(text) if all(map(small, m[0].split(".")))],
        "card": [m.span() for m in _CARD.finditer(text) if 16 <= len(d := digits(m[0])) <= 19 and _luhn(d)],
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15],
    }


def written_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, end and kind of everything written like a span, whether or not its numbers pass the checks.

    The tagger learns from these: what tells a card from any sixteen digits is arithmetic, which is checked after it.
    """
    count = lambda s: sum("0" <= c <= "9" for c in s)
    found = [(a, b, 0) for a, b in _emails(text)] + [(*m.span(), 1) for m in _IP.finditer(text)]
    found += [(*m.span(), 2) for m in _CARD.finditer(text) if 13 <= count(m[0]) <= 19]
    found += [(*m.span(), 3) for m in _PHONE.finditer(text) if 8 <= count(m[0]) <= 15]
    return found


def characters(text: str) -> np.ndarray:
    """Code points of a text, all beyond ASCII as one; 0 is for padding."""
    return np.clip(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 1, CHARACTERS - 1).astype(np.int64)


def _starts(codes: np.ndarray) -> np.ndarray:
    """Where the windows with a digit or sign start."""
    at = np.flatnonzero(_ANCHOR[codes])
    first = at // STRIDE
    found = np.unique(np.concatenate([first, first - 1]))
    return found[found >= 0] * STRIDE


def _cut_out(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int64)])
    return padded[starts[:, None] + np.arange(WINDOW)]


def _tags(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tags of n characters: 0 outside, 1 + 2k at the first character of a span of kind k, 2 + 2k within."""
    made = np.zeros(n, np.int64)
    for start, end, kind in spans:
        made[start] = 1 + 2 * kind
        made[start + 1:end] = 2 + 2 * kind
    return made


def _rewritten(value: str, kind: int, rng: np.random.Generator) -> str:
    """Another way to write a span, which the patterns miss or not."""
    pick = lambda *x: x[rng.integers(len(x))]
    if kind == 0:
        return value.replace("@", pick("@", " @ ", " @", "@ ", "[@]"))
    if kind == 1:
        return value.replace(".", pick(".", ". ", " . "))
    if kind == 2:
        d = re.sub(r"[^0-9]", "", value)
        return pick("", "-", " ", ".").join(d[k:k + 4] for k in range(0, len(d), 4))
    return pick(value, value.lstrip("+"), re.sub(r"[() ]+", "-", value).strip("+-"), re.sub(r"[^0-9]+", ".", value).strip("."), "00" + value.lstrip("+"))


def _other_digits(value: str, kind: int, rng: np.random.Generator) -> str:
    """The same writing with other numbers: what is learned is the shape, not the sample's values."""
    if kind == 1:
        return re.sub(r"[0-9]+", lambda m: str(rng.integers(1, 256)), value)
    return re.sub(r"[0-9]", lambda m: str(rng.integers(10)), value)


def training_windows(texts: list[str], seed: int = 0, most: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Windows around labelled spans as they are, with other digits, and rewritten, and windows without any.

    Every text is written anew ``WRITINGS`` times; each time every span of it gives a window that holds it at
    a random place, and the text one more window around a digit or sign, if it has one.
    """
    rng, x, y = np.random.default_rng(seed), [], []
    for text in texts:
        spans, end = [], 0
        for a, b, k in sorted(written_spans(text)):  # overlapping kinds: the first
            if a >= end:
                spans.append((a, b, k))
                end = b
        for _ in range(WRITINGS if spans else 1):
            out, marks, at, size = [], [], 0, 0
            for a, b, k in spans:
                value = text[a:b] if rng.random() < 0.2 else _other_digits(text[a:b], k, rng)
                value = value if rng.random() < 0.3 else _rewritten(value, k, rng)
                size += a - at
                out += [text[at:a], value]
                marks.append((size, size + len(value), k))
                size, at = size + len(value), b
            whole = "".join([*out, text[at:]])
            codes, tags = characters(whole), _tags(len(whole), marks)
            starts = [int(rng.integers(min(max(0, b - WINDOW), a), a + 1)) for a, b, _ in marks]
            anchors = _starts(codes)
            if len(anchors):
                starts.append(int(rng.choice(anchors)))
            if starts:
                rows = np.minimum(np.array(starts), max(0, len(codes) - 1))
                x.append(_cut_out(codes, rows))
                y.append(_cut_out(tags, rows))
    if not x or not any(t.any() for t in y):
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    x, y = np.concatenate(x), np.concatenate(y)
    order = rng.permutation(len(x))[:most]
    return x[order], y[order]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Tagger | None:
    """Train on documents with digits or signs, about ``rows`` of them by the hash of their id."""
    own = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where(F.col("t").rlike("[0-9@]"))
    # only the surroundings of digits and signs are learned from: at most this much of a text travels to the driver
    around = F.array_join(F.slice(F.regexp_extract_all("t", F.lit(f"(?s).{{0,{WINDOW}}}[0-9@].{{0,{WINDOW}}}"), F.lit(0)), 1, SURROUNDINGS), "\n")
    picked = arrow.sampled(own, "k", rows).select(around.alias("t")).collect()
    x, y = training_windows(sorted(r.t for r in picked))
    if not len(x):
        return None
    tagger = Tagger.new(1 + 2 * len(KINDS))
    tagger.fit(x, y)
    return tagger


def _read(tags: np.ndarray, chance: np.ndarray, start: int, size: int) -> Iterator[tuple[int, int, int, float, bool]]:
    """Spans of one decoded window: start, end, kind, mean chance, and whether an edge may have cut it."""
    n, t = min(WINDOW, size - start), 0
    while t < n:
        if tags[t] == 0:
            t += 1
            continue
        kind, first = (tags[t] - 1) // 2, t
        t += 1
        while t < n and tags[t] == 2 + 2 * kind:
            t += 1
        yield start + first, start + t, int(kind), float(chance[first:t].mean()), (first == 0 and start > 0) or (t == WINDOW and start + t < size)


def _whole(text: str, a: int, b: int, kind: int) -> Span:
    """A span without loose signs at its ends, and with the rest of the words or numbers that they cut."""
    while a < b and not (text[a].isalnum() or text[a] in "+(["):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    if a == b:
        return a, b
    if kind == 0:
        while a and text[a - 1] in _LOCAL:
            a -= 1
        while b < len(text) and (text[b].isascii() and text[b].isalnum() or text[b] in "-." and text[b + 1:b + 2].isalnum()):
            b += 1
        return a, b
    while a and text[a - 1].isdecimal() and text[a].isdecimal():
        a -= 1
    while b < len(text) and text[b].isdecimal() and text[b - 1].isdecimal():
        b += 1
    return a, b


def _checked(value: str, kind: int) -> bool:
    """Whether a span's numbers are of its kind: the checks of the patterns, for any writing."""
    digits = "".join(c for c in value if "0" <= c <= "9")
    if kind == 0:
        return "@" in value and "." in value[value.rindex("@"):]
    if kind == 1:
        parts = re.findall("[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


def reconcile(found: list[tuple[int, int, int, float, bool]], fixed: list[Span], text: str) -> list[tuple[int, int, int]]:
    """From the spans of all windows of a text those that stay."""
    joined: list[list] = []
    for kind in range(len(KINDS)):
        last = None
        for a, b, _, sure, cut in sorted(x for x in found if x[2] == kind):
            if last and a < last[1] and (cut or last[4]):
                last[4] = cut if b > last[1] else last[4]
                last[1], last[3] = max(b, last[1]), max(sure, last[3])
            else:
                last = [a, b, kind, sure, cut]
                joined.append(last)
    good = set()
    for a, b, kind, sure, _ in joined:
        a, b = _whole(text, a, b, kind)
        if sure >= SURE and SHORTEST <= b - a <= LONGEST and _checked(text[a:b], kind) and not any(a < y and x < b for x, y in fixed):
            good.add((b, a, kind, sure * (b - a)))
    order = sorted(good)
    ends, best = [x[0] for x in order], [(0.0, None)]
    for k, (_, a, _, weight) in enumerate(order):
        before = bisect_right(ends, a, 0, k)
        with_it = best[before][0] + weight
        best.append((with_it, before) if with_it > best[-1][0] else (best[-1][0], None))
    chosen, k = [], len(order)
    while k:
        if best[k][1] is None:
            k -= 1
        else:
            b, a, kind, _ = order[k - 1]
            chosen.append((a, b, kind))
            k = best[k][1]
    return sorted(chosen)


def _windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = characters(text)
    starts = _starts(codes)
    return starts, _cut_out(codes, starts)


def spans_of(text: str, tagger: Tagger, fixed=base_spans) -> list[tuple[str, int, int]]:
    """Kind, start and end of all spans of one text: those of ``fixed`` and what the tagger adds."""
    own, found = fixed(text), []
    starts, cut = _windows_of(text)
    for k in range(0, len(starts), AT_ONCE):
        tags, chance = tagger.decode(cut[k:k + AT_ONCE])
        for s, t, c in zip(starts[k:k + AT_ONCE].tolist(), tags, chance):
            found += _read(t, c, s, len(text))
    added = reconcile(found, [x for k in KINDS for x in own[k]], text)
    return [(k, a, b) for k in KINDS for a, b in own[k]] + [(KINDS[k], a, b) for a, b, k in added]


def find(docs: DataFrame, tagger: Tagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, counts of the patterns' spans by kind, ``base_sha256``, ``spans``, ``n_added``; no shuffle."""
    arrow.prepare(docs.sparkSession)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def write(spans: dict[str, list[Span]]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, rows = words.texts(b["text"])
            some = np.flatnonzero(np.diff(np.r_[0, np.cumsum(_ANCHOR[body])][rows])).tolist()
            base, texts, windows = {}, {}, []
            for i in some:
                texts[i] = b["text"][i].as_py()
                base[i] = base_spans(texts[i])
                windows += [(i, int(s), x) for s, x in zip(*_windows_of(texts[i]))]
            found: dict[int, list] = {i: [] for i in some}
            for k in range(0, len(windows) if tagger else 0, AT_ONCE):
                part = windows[k:k + AT_ONCE]
                tags, chance = tagger.decode(np.array([x for _, _, x in part]))
                for (i, s, _), t, c in zip(part, tags, chance):
                    if t.any():
                        found[i] += _read(t, c, s, len(texts[i]))
            out, none = [], {k: [] for k in KINDS}
            for i, name in enumerate(b["id"].to_pylist()):
                own, added = base.get(i, none), []
                if found.get(i):
                    added = reconcile(found[i], [x for k in KINDS for x in own[k]], texts[i])
                every = {k: own[k] + [(a, e) for a, e, kind in added if KINDS[kind] == k] for k in KINDS}
                out.append((name, *(len(own[k]) for k in KINDS), hashlib.sha256(write(own).encode()).hexdigest(), write(every), len(added)))
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * len(names), types)], names)

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
