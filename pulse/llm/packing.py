"""Packing tokenised documents into sequences of a fixed window, planned by non-negative least squares.

Each document is tokenised, ended by a given id and cut into pieces of at most a window. The lengths
of all pieces, rounded up to grains, form a histogram. All combinations of at most three lengths
that fill a window exactly are enumerated; non-negative least squares finds how often to use each
so that together they use up the histogram, and the counts are rounded down. Pieces take places in
the plan by their rank among pieces of equal rounded length. What the plan leaves is packed greedily
in groups: a piece that does not fit is cut at a multiple of 64 ids and goes on in the next sequence.

Ranks come from counts per length and salt, so a length that a third of all pieces have is spread
over many tasks. Salts and greedy groups follow ids and checksums; those that repeated rows, or rows
without an id, overfill are parted by the place of a row among the written pieces. Checksums of cut pieces follow from checksums of prefixes that are kept for every
64 ids, so texts are tokenised once.

Edge cases: a null or empty text is the end id alone. Repeated rows, and rows without an id, are
packed each. An empty table gives no rows. Columns besides id and text are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..settle import settle
from . import arrow, words

#: Ids of a sequence; ids of a grain in which lengths are counted; ids between possible cuts.
WINDOW, GRAIN, CUT = 4096, 16, 64
#: Lengths of a combination, at most.
DEPTH = 3
#: Pieces that one task ranks, and tokens that one task packs greedily, about.
RANKED, GREEDY = 50_000, 1 << 20
#: A salt or a group is overfull, and parted, beyond so many times that.
OVERFULL = 4
#: Places for words that a worker remembers (a power of two), and ids of all of them at most; both bounded memory.
KNOWN, KNOWN_IDS = 1 << 21, 12 << 20

_MARKS = b".,;:!?"
_ASCII_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(_MARKS)] = True
#: Characters that a byte-level vocabulary writes bytes as: printable ones of Latin-1 as they are, the others from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}


def _letters(body: np.ndarray) -> np.ndarray:
    """Which bytes belong to Latin letters up to U+017F, each of which is one letter in lower case as well."""
    out = _ASCII_LETTER[body]
    lead = np.flatnonzero((body[:-1] >= 0xC3) & (body[:-1] <= 0xC5))
    pair = body[lead].astype(np.int32) << 8 | body[lead + 1]
    # the signs of multiplication and division are no letters, and the dotted capital I becomes two characters
    lead = lead[~np.isin(pair, [0xC397, 0xC3B7, 0xC4B0])]
    out[lead] = out[lead + 1] = True
    return out


class Words:
    """Ids of words (runs between ASCII white space), for a batch at a time.

    The vocabulary's model must drop white space and never join across it, so that a text's ids are those of
    its words; a vocabulary for which a trial shows otherwise has whole texts encoded instead. Words are looked up by their hashes in one
    table for all. A word of Latin letters, with one sign after it or none, is looked up without the sign, whose id follows, and with its ASCII letters in
    lower case. Only words not met before, or displaced since, go through the tokenizer, once per batch.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        tried = ["A", "word", "Two-part", "it's", "12,5", "é.", "\u65e5\u672c", "x!?"]
        self.apart = all(
            self._whole(f"{one}{gap}{other}") == self._whole(one) + self._whole(other) for one in tried for other in tried for gap in (" ", "\n", " \t "))
        # whether letters and the sign after them are parts of their own, in lower case, and each sign is one id
        self.mark = np.zeros(256, self.kind)
        found = [self._whole(chr(m)) for m in _MARKS]
        self.simple = self.apart and all(len(x) == 1 for x in found) and all(
            self._whole(a + chr(m)) == self._model(a.lower()) + x for a in ("Abc", "x", "Thequick", "\u00c9t\u00e9", "\u00fc\u00df\u0141\u0173") for m, x in zip(_MARKS, found))
        if self.simple:
            self.mark[list(_MARKS)] = [x[0] for x in found]
        self._forget()

    def _whole(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _model(self, part: str) -> list[int]:
        if not part.isascii():
            part = part.lower().encode().decode("latin-1").translate(_WRITTEN)
        return [t.id for t in self.whole.model.tokenize(part)]

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(KNOWN, np.uint64), np.zeros(KNOWN, np.int32), np.zeros(KNOWN, np.int32)
        self.pool, self.used = np.zeros(1 << 16, self.kind), 0

    def _ids_of(self, found: list[str]) -> list[list[int]]:
        """Ids of words of any kind, from one text that holds them all."""
        if not found:
            return []
        special = [i for i, w in enumerate(found) if "<|" in w]  # may hold a special token
        plain = ["x" if "<|" in w else w for w in found]
        done = self.whole.encode(" ".join(plain), add_special_tokens=False)
        begins = np.cumsum([0, *(len(w) + 1 for w in plain)])
        place = np.searchsorted(begins, [a for a, _ in done.offsets], "right") - 1
        ids, cut = done.ids, np.searchsorted(place, np.arange(len(plain) + 1))
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        for i in special:
            out[i] = self._whole(found[i])
        return out

    def _learn(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, found), np.int64, len(found))
        at = self.used + np.cumsum(size) - size
        self.used += int(size.sum())
        if self.used > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), self.used), self.kind)])
        if len(found):
            self.pool[at[0]:self.used] = np.fromiter(chain.from_iterable(found), self.kind, int(size.sum()))
        return at, size

    def _texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(self._whole(t or ""), self.kind) for t in column.to_pylist()]
        return np.concatenate([np.zeros(0, self.kind), *found]), np.cumsum([0, *map(len, found)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and where each row's begin in it."""
        if not self.apart:
            return self._texts(column)
        if self.used > KNOWN_IDS:
            self._forget()
        body, rows = words.texts(column)
        starts, ends, first = words.bounds(body, rows)
        if not len(starts):
            return np.zeros(0, self.kind), first
        letters = np.zeros(len(body) + 1, np.int32)
        np.cumsum(_letters(body), out=letters[1:])
        other = ends - starts - (letters[ends] - letters[starts])
        marked = self.simple & (other == 1) & (ends - starts > 1) & _MARK[body[ends - 1]]
        stem = marked | (self.simple & (other == 0))
        ends = ends - marked
        h = np.empty(len(starts), np.uint64)
        low = words.LOWER[body]
        h[stem] = words.hashes(low, starts[stem], ends[stem])
        h[~stem] = words.hashes(body, starts[~stem], ends[~stem])
        slot = (h >> np.uint64(64 - KNOWN.bit_length() + 1)).astype(np.int64)
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        new = np.flatnonzero(self.keys[slot] != h)
        if len(new):
            own, which, back = np.unique(h[new], return_index=True, return_inverse=True)
            which = new[which]
            is_stem = stem[which]
            found: list = [None] * len(which)
            for k in np.flatnonzero(is_stem):
                w = which[k]
                found[k] = self._model(low[starts[w]:ends[w]].tobytes().decode())
            rest = np.flatnonzero(~is_stem)
            texts = [body[starts[w]:ends[w]].tobytes().decode() for w in which[rest]]
            for k, ids in zip(rest.tolist(), self._ids_of(texts)):
                found[k] = ids
            own_at, own_size = self._learn(found)
            at[new], size[new] = own_at[back], own_size[back]
            self.keys[slot[which]], self.at[slot[which]], self.size[slot[which]] = own, own_at, own_size
        size += marked
        offsets = np.cumsum(np.r_[0, size])
        place = np.repeat(at - offsets[:-1], size) + np.arange(offsets[-1])
        out = self.pool[np.minimum(place, len(self.pool) - 1)]
        # the place after a stem is its sign's
        out[offsets[1:][marked] - 1] = self.mark[body[ends[marked]]]
        return out, offsets[first]


_words: dict[str, Words] = {}


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32 (bits reflected)."""
    p, m = 0, 1 << 31
    while a:
        if a & m:
            p ^= b
            a ^= m
        m >>= 1
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return p


@lru_cache(65536)
def _shift(n: int) -> int:
    """What a checksum is multiplied by when ``n`` bytes follow."""
    made, power = 1 << 31, 1 << 23
    while n:
        if n & 1:
            made = _times(power, made)
        power = _times(power, power)
        n >>= 1
    return made


def tail_crc(before: int, whole: int, n: int) -> int:
    """Checksum of the last ``n`` bytes, from that of all bytes and of those before them."""
    return whole ^ _times(_shift(n), before)


def pieces(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``crc``, ``doc_tokens``, ``prefix`` (checksums at multiples of CUT within the piece)."""
    arrow.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _words:
            _words[tokenizer] = Words(tokenizer)
        known = _words[tokenizer]
        names = ["doc_id", "start", "length", "crc", "doc_tokens", "prefix"]
        types = [pa.int64()] * 5 + [pa.binary()]
        for b in batches:
            rows = []
            flat, cuts = known.encode(b["text"])
            for name, low, high in zip(b["id"].to_pylist(), cuts[:-1], cuts[1:]):
                ids = np.append(flat[low:high].astype("<u4"), np.uint32(end)).astype("<u4").tobytes()
                n = len(ids) // 4
                for start in range(0, n, WINDOW):
                    part = memoryview(ids)[4 * start:4 * (start + WINDOW)]
                    length, crc, marks = len(part) // 4, 0, []
                    for at in range(0, len(part), 4 * CUT) if length < WINDOW else ():
                        marks.append(crc)
                        crc = zlib.crc32(part[at:at + 4 * CUT], crc)
                    if length == WINDOW:
                        crc = zlib.crc32(part)
                    rows.append((name, start, length, crc, n, np.array(marks, "<u4").tobytes()))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, start long, length long, crc long, doc_tokens long, prefix binary")


def combinations(total: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All falling sequences of at most ``depth`` positive whole numbers with this sum."""
    def below(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if rest == 0:
            yield ()
        elif left:
            for x in range(min(rest, most), math.ceil(rest / left) - 1, -1):
                for more in below(rest - x, x, left - 1):
                    yield x, *more
    return list(below(total, total, depth))


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 2000) -> np.ndarray:
    """x >= 0 of least ``|a x - b|``: columns join while the gradient asks for them, and leave at zero."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    small = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(steps):
        pull = a.T @ (b - a @ x)
        pull[used] = -np.inf
        j = int(pull.argmax())
        if pull[j] <= small:
            break
        used[j] = True
        while True:
            at = np.flatnonzero(used)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            step = (x[at][bad] / np.maximum(x[at][bad] - z[bad], 1e-300)).min()
            x[at] += step * (z - x[at])
            used[at[x[at] <= 1e-12 * max(1.0, float(x.max()))]] = False
            x[~used] = 0
            if not used.any():
                break
    return x


def plan(histogram: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, int]:
    """Places for pieces of each rounded length: (bin, first rank, rank after, first sequence, slot).

    Also how many pieces of each bin the plan takes, and its number of sequences. ``histogram[i]``
    counts the pieces of i grains.
    """
    total = len(histogram) - 1
    sets = combinations(total)
    a = np.zeros((total, len(sets)))
    for j, s in enumerate(sets):
        for x in s:
            a[x - 1, j] += 1
    wanted = np.floor(nnls(a, histogram[1:].astype(float)) + 1e-6).astype(np.int64)
    left, taken = histogram.copy(), np.zeros_like(histogram)
    places, sequence = [], 0
    for j in np.argsort(-wanted, kind="stable"):
        n = min([int(wanted[j]), *(int(left[x]) // sets[j].count(x) for x in set(sets[j]))])
        if n <= 0:
            continue
        for slot, x in enumerate(sets[j]):
            places.append((x, int(taken[x]), int(taken[x]) + n, sequence, slot))
            taken[x] += n
            left[x] -= n
        sequence += n
    return places, taken, sequence


def _greedy(rows: list[tuple], first: int, step: int) -> list[tuple]:
    """Pieces in sequences ``first``, ``first + step``, ...; cut where one does not fit."""
    made, sequence, at = [], first, 0
    for doc, start, length, crc, tokens, prefix in rows:
        marks, done = np.frombuffer(prefix, "<u4"), 0
        while done < length:
            space = WINDOW - at
            n = length - done
            if n > space:
                n = space // CUT * CUT
            if n:
                to = done + n
                whole = crc if to == length else int(marks[to // CUT])
                made.append((doc, start + done, n, whole if not done else tail_crc(int(marks[done // CUT]), whole, 4 * n), tokens, sequence, at))
                done, at = to, at + n
            if done < length or at == WINDOW:
                sequence, at = sequence + step, 0
    return made


def _salted(cut: DataFrame, pieces: int) -> DataFrame:
    """``cut`` with ``bin``, ``salt`` and ``part``, which together have about RANKED rows or fewer."""
    salts = max(1, -(-pieces // RANKED))
    salt = F.pmod(F.xxhash64("doc_id", "start", "crc"), F.lit(salts)).cast("int")
    salted = cut.withColumns({"bin": F.ceil(F.col("length") / GRAIN).cast("int"), "salt": salt})
    full = salted.groupBy("bin", "salt").agg(F.count("*").alias("n")).where(F.col("n") > OVERFULL * RANKED)
    full = settle(full.select("bin", "salt", F.ceil(F.col("n") / RANKED).alias("parts")), "overfull")  # at most a row per OVERFULL * RANKED pieces
    part = F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0).cast("long"))
    return salted.join(F.broadcast(full), ["bin", "salt"], "left").withColumn("part", part).drop("parts")


def _grouped(left: DataFrame, tokens: int) -> tuple[DataFrame, int]:
    """``left`` with ``group``, each of about GREEDY tokens or fewer, and how many groups there are."""
    groups = max(1, -(-tokens // GREEDY))
    dealt = left.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "crc", F.lit(3)), F.lit(groups)).cast("long"))
    full = dealt.groupBy("group").agg(F.sum("length").alias("n")).where(F.col("n") > OVERFULL * GREEDY).orderBy("group").collect()  # at most a row per OVERFULL groups' tokens
    rows, of = [], groups
    for r in full:
        parts = -(-r.n // GREEDY)
        rows.append((r.group, parts, of))
        of += parts - 1
    if not rows:
        return dealt, groups
    table = F.broadcast(left.sparkSession.createDataFrame(rows, "group long, parts long, base long"))
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    group = F.when(F.coalesce(part, F.lit(0)) == 0, F.col("group")).otherwise(F.col("base") + part - 1)
    return dealt.join(table, "group", "left").withColumn("group", group).drop("parts", "base"), of


def pack(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    spark = docs.sparkSession
    cut = settle(pieces(docs, tokenizer, end, key, text).withColumn("row", F.monotonically_increasing_id()), "pieces")
    grains = F.ceil(F.col("length") / GRAIN).cast("int")
    counted = cut.groupBy(grains.alias("bin")).agg(F.count("*").alias("n"), F.sum("length").alias("tokens")).collect()  # WINDOW / GRAIN rows
    histogram = np.zeros(WINDOW // GRAIN + 1, np.int64)
    for r in counted:
        histogram[r.bin] = r.n
    places, taken, sequences = plan(histogram)

    salted = _salted(cut, int(histogram.sum()))
    own = ["bin", "salt", "part"]
    per = salted.groupBy(own).agg(F.count("*").alias("n"))
    before = per.select(*own, (F.sum("n").over(W.partitionBy("bin").orderBy("salt", "part")) - F.col("n")).alias("before"))
    ranked = salted.withColumn("r", F.row_number().over(W.partitionBy(own).orderBy("doc_id", "start")) - 1)
    ranked = ranked.join(before, own).withColumn("rank", F.col("before") + F.col("r")).drop("before", "r", "salt", "part")
    ends = F.create_map(*[F.lit(x) for i, n in enumerate(taken) for x in (i, int(n))])  # WINDOW / GRAIN entries
    ranked = settle(ranked.withColumn("planned", F.col("rank") < F.element_at(ends, F.col("bin"))), "ranked")

    # at most a row per used combination and place, and no more combinations than bins are used
    table = F.broadcast(spark.createDataFrame(places or [(0, 0, 0, 0, 0)], "of int, low long, high long, base long, slot int"))
    own = ranked.where("planned").drop("prefix", "row").join(table, (F.col("bin") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    own = own.withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("low"))
    along = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    own = own.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0).cast("long")))
    names = ["doc_id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]

    rest = sum(r.tokens * int(histogram[r.bin] - taken[r.bin]) // max(1, r.n) for r in counted)
    left, groups = _grouped(ranked.where("not planned"), int(rest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at = [], None

        def done() -> pa.RecordBatch:
            made = _greedy(rows, sequences + (at or 0), groups)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*made)) or [[]] * 7)], names)

        for b in batches:
            for group, *row in zip(*(b[c].to_pylist() for c in ("group", *names[:5], "prefix"))):
                if group != at and rows:
                    yield done()
                    rows = []
                at = group
                rows.append(row)
        yield done()

    dealt = left.repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "start")
    greedy = dealt.select("group", *names[:5], "prefix").mapInArrow(run, ", ".join(f"`{c}` long" for c in names))
    return own.select(names).union(greedy).withColumnRenamed("crc", "ids_crc32")
