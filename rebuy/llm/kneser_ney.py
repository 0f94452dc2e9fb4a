"""Quality classifier: an interpolated modified Kneser-Ney model of words.

Per language, a model of ``WORDS`` words is trained on trusted text, every
document is given its perplexity under the model of its language, and documents
above a quantile of that language's trusted documents are rejected. A symbol is
a run of letters and digits, or any other visible character by itself, as is
each character of a script that writes without blanks. There is no list of
known symbols: a symbol is a 64-bit hash, and the model grows with the trusted
text. (``perplexities`` does the same for single characters when ``words``
isn't set.)

*Layout.* Symbols are dealt to units of about ``UNIT_ROWS`` occurrences by
their hash; a symbol with more has units of its own, dealt by its neighbour. A
task sends the grams of its documents to their units packed: a row per unit,
with short codes for the most frequent symbols and whole hashes for all others.

*Counting.* The counts of all orders of a gram meet in the unit of its last
symbol: occurrences for the highest order, below it the distinct symbols before
(continuation counts). There each gram of the highest order gets them and is
sent on to the unit of its last symbol but one, with which every context ends.
That is the model; only it is kept on disk. Counts of counts and, for the
symbols with several units, sums per class come to the driver: their number is
bounded by the languages and ``CODES``. The three discounts of each order and
class follow from them.

*Scoring.* The grams of all documents are sent to the units of their contexts,
and each symbol to its own unit. A unit has all contexts and the grams that
follow them, so it makes the probabilities from the counts of its part of the
model and sums their logarithms by document: a symbol adds ``log P1`` in its own
unit, and in that of its context what the highest known order and the weights of
the orders above differ from it. The units go in up to ``SLICES`` passes over
the documents, each of which frees its shuffle files, so that the disk holds the
model and an eighth of the grams. No part of the model or the documents passes
through the driver, and no frequent symbol or gram is one task's alone.

*Held out.* A document mustn't be judged by a model that has read it: nearly
all its grams would be known. So each language has ``FOLDS`` models; a trusted
text is learnt by the models of the other folds and scored by its own, and the
fold is that of the text's hash, so that copies share it.

*Threshold.* A document is rejected above the quantile ``UPPER`` of the
log-perplexities of its language's trusted documents in a band of lengths (by
powers of two, since short texts vary more), or further by ``margin`` times
the distance from the middle. A text that repeats itself can be sane by that
measure, so a document is rejected too whose variety, the distinct pairs of
neighbours a symbol, is below the quantile ``LOWER`` of the same documents.
The sketch of Spark's approximate quantiles is used, over all trusted
documents.

A language with under ``MIN_TRUSTED`` trusted documents shares its models with
all such languages.

Defined cases: null, empty and blank texts have no perplexity and are kept, as
are all documents of a language class and fold without trusted text. A null
language is a class member like a rare one. A doc_id that the labels hold more
than once is trusted if all its labels say so. Repeated rows each get the
result and count as often as they occur. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import KEY, pieces, stage_table
from rebuy.sources.stage import drop_path, stage_root

#: Symbols of a gram, for characters and for words.
ORDER, WORDS = 4, 3
FOLDS = 2
MIN_TRUSTED = 50
MIDDLE, UPPER, MARGIN = 0.5, 0.99, 0.0
LOWER = 0.005
#: The class of rare and null languages.
POOLED = "*"
#: Characters of a text that are handled at once.
PIECE = 1 << 16
#: Gram rows that a task holds before it sends them on.
SHARD_ROWS = 1_000_000
#: Symbols of all documents that a unit has, about.
UNIT_ROWS = 2_000_000
#: Passes over the units, of all documents and of the trusted ones.
SLICES, TRAIN_SLICES = 8, 4
#: Symbols with a short code. They decide costs only.
CODES = (1 << 16) - 2
#: Bits of the first sieve of trusted ids. They decide costs only.
SIEVE_BITS = 1 << 23

_START = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)
_LONE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]|[^\p{L}\p{M}\p{N}\p{Z}\s]"
#: Kinds of characters.
_BLANK, _LETTER, _ALONE = 0, 1, 2
#: Kinds of rows between the steps.
_GRAMS, _SYMBOLS, _MODEL, _ONES, _STATS, _HOT_ONES, _HOT_CONTEXTS = range(7)
_CODE_POINTS = 0x110000
#: The code of a symbol that has none.
_NO_CODE = 0xFFFF
_SLOT_BITS = 19


def _mixed(held: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A hash grown by a symbol; multiplications wrap."""
    grown = (held ^ more) * _FACTOR
    grown = (grown ^ (grown >> _SHIFT)) * _FACTOR
    return grown ^ (grown >> _SHIFT)


def _key(seed: np.ndarray, symbols: list[np.ndarray]) -> np.ndarray:
    """The hash of a gram of a class."""
    held = seed + np.uint64(len(symbols))
    for symbol in symbols:
        held = _mixed(held, symbol)
    return held


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted among sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, a place of each and which of them every key is; equal keys in any order, which sorts faster."""
    order = np.argsort(key)
    held = key[order]
    new = np.ones(len(key), bool)
    new[1:] = held[1:] != held[:-1]
    of = np.empty(len(key), np.int64)
    of[order] = np.cumsum(new) - 1
    return held[new], order[new], of


class _Index:
    """Sorted hashes, found by their first bits instead of by halving."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        ends = np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits))
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int32 if len(keys) < 1 << 31 else np.int64)

    def found(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_found``."""
        keys = self.keys
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(self.starts[wanted >> self.shift].astype(np.int64), len(keys) - 1)
        on = np.flatnonzero(keys[at] < wanted)
        for _ in range(16):
            on = on[at[on] < len(keys) - 1]
            if not len(on):
                break
            at[on] += 1
            on = on[keys[at[on]] < wanted[on]]
        if len(on):
            at[on] = np.minimum(np.searchsorted(keys, wanted[on]), len(keys) - 1)
        return at, keys[at] == wanted


_KINDS: list[np.ndarray] = []


def _kinds(spark: SparkSession) -> np.ndarray:
    """The kind of every character, told by the regular expressions of Spark."""
    if not _KINDS:
        # A letter before it, since a decoder drops a mark of byte order that comes first.
        text = lambda c: F.decode(F.unhex(F.concat(F.lit("00000061"), F.lpad(F.hex(c), 8, "0"))), "UTF-32")
        told = lambda c: (
            F.when(c.between(0xD800, 0xDFFF), _ALONE)
            .when(text(c).rlike(r"^a[\s\p{Z}]"), _BLANK)
            .when(text(c).rlike(f"^a(?:{_LONE})"), _ALONE)
            .otherwise(_LETTER)
        )
        block = F.col("id") * 256
        rows = spark.range(_CODE_POINTS // 256).select("id", F.transform(F.sequence(block, block + 255), told).alias("kinds")).collect()
        _KINDS.append(np.array([r.kinds for r in sorted(rows, key=lambda r: r.id)], np.uint8).ravel())
    return _KINDS[0]


@lru_cache(1)
def _letter_values() -> np.ndarray:
    return _mixed(np.arange(_CODE_POINTS, dtype=np.uint64), _START)


@lru_cache(4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the factor and of its inverse."""
    bases = (int(_FACTOR), pow(int(_FACTOR), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full((1 << bits) - 1, b, np.uint64)])) for b in bases)


def _symbols(texts: list[str], kinds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the texts as 64-bit numbers, and how many each text has; characters where there are no kinds."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(("" if kinds is None else "\n").join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if kinds is None:
        return joined.astype(np.uint64), sizes
    kind = kinds[joined]
    new = kind == _LETTER
    new[1:] &= kind[:-1] != _LETTER
    new |= kind == _ALONE
    starts = np.flatnonzero(new)
    begins = np.cumsum(sizes + 1) - sizes - 1
    counts = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    # Blanks add nothing; the powers count from the first letter of a symbol.
    up, down = _powers((len(joined) - 1).bit_length())
    sums = np.add.reduceat(_letter_values()[joined] * up[: len(joined)] * (kind != _BLANK), starts)
    return _mixed(sums * down[starts], _START), counts


def _cut(text: str, most: int) -> Iterator[str]:
    """A long text in pieces that end before a blank."""
    at = 0
    while len(text) - at > most and (end := text.find(" ", at + most)) >= 0:
        yield text[at:end]
        at = end
    yield text[at:]


def _runs(batch: pa.RecordBatch, kinds: np.ndarray | None, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By rows whose texts are short together, or one long: the first of them, their symbols and the symbols of each."""
    texts = [t or "" for t in batch.column("_text").to_pylist()]
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= most:
            size += len(texts[to])
            to += 1
        if size > most and kinds is not None:
            flat = np.concatenate([_symbols([part], kinds)[0] for part in _cut(texts[at], most)])
            yield at, flat, np.array([len(flat)])
        else:
            yield at, *_symbols(texts[at:to], kinds)
        at = to


def _spread(flat: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols with the start's before each text, as many as a context has, and the places of the texts' own."""
    place = np.arange(len(flat)) + np.repeat(np.arange(1, len(counts) + 1) * (order - 1), counts)
    spread = np.full(len(flat) + (order - 1) * len(counts), _START)
    spread[place] = flat
    return spread, place


def _slot(symbol: np.ndarray) -> np.ndarray:
    return symbol * _FACTOR >> np.uint64(64 - _SLOT_BITS)


class _Layout(NamedTuple):
    """Which unit has a symbol, and the codes of symbols."""

    #: Symbols with a code, the most frequent first, and codes by ``_slot``; of those that share one, the first has it.
    coded: np.ndarray
    slots: np.ndarray
    #: Units of all other symbols; symbols with several units, sorted, their first units and how many they have.
    cold: int
    hot: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    def homes(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The units of symbols that have one, and the places of the others among those with several, else -1."""
        unit = ((_mixed(_START, symbol) >> _SHIFT) * np.uint64(self.cold) >> _SHIFT).astype(np.int64)
        at, hot = _found(self.hot, symbol)
        return unit, np.where(hot, at, -1)

    def parted(self, unit: np.ndarray, heat: np.ndarray, neighbour: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Units, from ``homes``; ``neighbour`` gives the neighbours of the symbols at some places."""
        hot = np.flatnonzero(heat >= 0)
        if len(hot):
            part = (_mixed(_START, neighbour(hot)) >> _SHIFT).astype(np.int64) % self.parts[heat[hot]]
            unit[hot] = self.first[heat[hot]] + part
        return unit

    def units(self, symbol: np.ndarray, neighbour: np.ndarray) -> np.ndarray:
        return self.parted(*self.homes(symbol), lambda hot: neighbour[hot])

    def codes(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of symbols, and whether they have one."""
        code = self.slots[_slot(symbol)]
        known = self.coded[np.minimum(code, len(self.coded) - 1)] == symbol
        code[~known] = _NO_CODE
        return code, known

    def is_hot(self, symbol: np.ndarray) -> np.ndarray:
        return _found(self.hot, symbol)[1]


def _least(a: np.ndarray) -> np.ndarray:
    """In the smallest type that has its numbers."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def _bytes(arrays: list[np.ndarray]) -> bytes:
    """Arrays of unsigned numbers, compressed, bytes of the same weight together."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], np.int64).tobytes()
    body = b"".join([head, *(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _arrays(blob: bytes) -> list[np.ndarray]:
    body = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    head, at, found = np.frombuffer(body, np.int64, 2 * n, 8), 8 + 16 * n, []
    for width, size in zip(head[::2].tolist(), head[1::2].tolist(), strict=True):
        planes = np.frombuffer(body, np.uint8, width * size, at).reshape(width, size)
        found.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel())
        at += width * size
    return found


def _parcels(
    layout: _Layout, unit: np.ndarray, who: np.ndarray, names: list[np.ndarray], symbols: list[np.ndarray], more: list[np.ndarray]
) -> Iterator[tuple[int, bytes]]:
    """Rows by unit, packed in their order: ``names`` of those that ``who`` points to, symbols and further numbers of each row."""
    # Numbers of 16 bits are sorted by counting them.
    order = np.argsort(_least(unit), kind="stable")
    unit = unit[order]
    bounds = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]]) if len(unit) else [0]
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        rows = order[lo:hi]
        there = np.zeros(len(names[0]), bool)
        there[who[rows]] = True
        arrays = [_least((np.cumsum(there) - 1)[who[rows]]), *(name[there] for name in names)]
        for column in symbols:
            own = column[rows]
            code, known = layout.codes(own)
            arrays += [code, own[~known]]
        yield int(unit[lo]), _bytes([*arrays, *(_least(m[rows]) for m in more)])


def _opened(layout: _Layout, blob: bytes, names: int, symbols: int) -> tuple[np.ndarray, list, list, list]:
    who, *rest = _arrays(blob)
    columns = []
    for code, whole in zip(rest[names : names + 2 * symbols : 2], rest[names + 1 : names + 2 * symbols : 2], strict=True):
        column = np.empty(len(code), np.uint64)
        known = code != _NO_CODE
        column[known] = layout.coded[code[known]] if known.any() else 0
        column[~known] = whole
        columns.append(column)
    return who.astype(np.int64), rest[:names], columns, rest[names + 2 * symbols :]


_SENT = "unit int, kind int, blob binary"


def _sent(kind: int, parcels: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for unit, blob in parcels:
        yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int32()), pa.array([kind], pa.int32()), pa.array([blob], pa.binary())], ["unit", "kind", "blob"])


def _survey(kinds: np.ndarray | None, most: int, hold: int, codes: int):
    """``_doc, n, pairs`` of each document, and ``w, c``, the frequent symbols of the task, in a row without a document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_doc", "n", "pairs", "w", "c"]
        longs = pa.list_(pa.int64())
        held, counts, waiting = np.empty(0, np.uint64), np.empty(0, np.int64), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            w, c = np.unique(np.concatenate([held[:0], *waiting]), return_counts=True)
            both, back = np.unique(np.concatenate([held, w]), return_inverse=True)
            summed = np.bincount(back, np.concatenate([counts, c]), len(both)).astype(np.int64)
            top = np.argsort(-summed, kind="stable")[: 4 * codes]
            return both[top], summed[top]

        for batch in pieces(batches):
            for at, flat, n in _runs(batch, kinds, most):
                of = np.repeat(np.arange(len(n)), n)
                pairs = np.zeros(len(n), np.int64)
                if kinds is not None:
                    a, b = flat[:-1], flat[1:]
                    turned = (a << np.uint64(1)) ^ (a >> np.uint64(63)) ^ b
                    alike = of[1:] == of[:-1]
                    _, first, _ = _grouped(_mixed(turned[alike], of[1:][alike].astype(np.uint64)))
                    pairs = np.bincount(of[1:][alike][first], minlength=len(n))
                size = len(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_doc").slice(at, size), pa.array(n, pa.int64()), pa.array(pairs, pa.int64()), pa.nulls(size, longs), pa.nulls(size, longs)], names
                )
                waiting.append(flat)
                if sum(map(len, waiting)) > hold:
                    held, counts = merged()
                    waiting = []
        held, counts = merged()
        top = [pa.array([a[:codes]], longs) for a in (held.view(np.int64), counts)]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 3 + top, names)

    return rows, "_doc long, n long, pairs long, w array<long>, c array<long>"


def _layout(survey: DataFrame) -> _Layout:
    total = survey.filter("_doc IS NOT NULL").agg(F.sum("n").alias("n"), F.count("*").alias("docs")).first()
    each = survey.filter("_doc IS NULL").select(F.explode(F.arrays_zip("w", "c")).alias("s")).select("s.w", "s.c")
    top = each.groupBy("w").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "w").limit(CODES).collect()
    coded = np.concatenate([[_START], np.array([r.w for r in top], np.int64).view(np.uint64)]).astype(np.uint64)
    counts = np.array([total.docs, *(r.c for r in top)], np.int64)
    slots = np.full(1 << _SLOT_BITS, _NO_CODE, np.uint16)
    slots[_slot(coded[::-1])] = np.arange(len(coded))[::-1]
    order = np.argsort(coded)
    frequent = np.flatnonzero(counts[order] > UNIT_ROWS)
    parts = -(-counts[order][frequent] // UNIT_ROWS)
    cold = max(1, -(-((total.n or 0) - int(counts[order][frequent].sum())) // UNIT_ROWS))
    return _Layout(coded, slots, cold, coded[order][frequent], cold + np.cumsum(parts) - parts, parts)


def _learnt(layout: _Layout, kinds: np.ndarray | None, most: int, order: int, hold: int, slices: int, at_slice: int):
    """The grams of the highest order for the units of their last symbols."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            seed, unit, *symbols = (np.concatenate(c) for c in zip(*waiting, strict=True))
            classes, who = np.unique(seed, return_inverse=True)
            yield from _sent(_GRAMS, _parcels(layout, unit, who, [classes], symbols, []))

        for batch in pieces(batches):
            seeds = batch.column("_seed").to_numpy().view(np.uint64)
            for at, flat, n in _runs(batch, kinds, most):
                spread, place = _spread(flat, n, order)
                unit = layout.parted(*layout.homes(flat), lambda hot: spread[place[hot] - 1])
                own = np.flatnonzero(unit % slices == at_slice)
                symbols = [spread[place[own] - back] for back in range(order - 1, -1, -1)]
                waiting.append([np.repeat(seeds[at : at + len(n)], n)[own], unit[own], *symbols])
                size += len(own)
                if size > hold:
                    yield from sent()
                    waiting, size = [], 0
        if size:
            yield from sent()

    return rows


_COUNTED = pa.schema(
    [("unit", pa.int32()), ("kind", pa.int32()), ("seed", pa.int64()), ("o", pa.int32()), ("w", pa.int64())]
    + [(c, pa.int64()) for c in ("n1", "n2", "n3", "n4", "total", "size", "least")]
    + [("blob", pa.binary())]
)
_COUNTED_KINDS = "unit int, kind int, seed long, o int, w long, n1 long, n2 long, n3 long, n4 long, total long, size long, least long, blob binary"


def _statistics(kind: int, o: int, keys: list[np.ndarray], c: np.ndarray) -> Iterator[dict]:
    """Sums of the counts ``c`` by class and, where there is a second key, symbol."""
    both, first, of = _grouped(_key(keys[0], keys[1:]))
    table = {f"n{i}": np.bincount(of[c == i], minlength=len(both)) for i in (1, 2, 3, 4)}
    table |= {"total": np.bincount(of, c, len(both)).astype(np.int64), "size": np.bincount(of, minlength=len(both))}
    least = np.full(len(both), np.iinfo(np.int64).max)
    np.minimum.at(least, of[c >= 3], c[c >= 3])
    table |= {"least": least, "seed": keys[0][first].view(np.int64)} | ({"w": keys[1][first].view(np.int64)} if keys[1:] else {})
    for i in range(len(both)):
        yield {"kind": kind, "o": o} | {name: int(a[i]) for name, a in table.items()}


def _counted(layout: _Layout, order: int):
    """A unit of last symbols: counts of all orders, sent on to the units of the contexts."""

    def counted(rows: pa.Table) -> pa.Table:
        opened = [_opened(layout, blob, 1, order) for blob in rows.column("blob").to_pylist()]
        seed = np.concatenate([names[0][who] for who, names, _, _ in opened])
        symbols = [np.concatenate([columns[i] for _, _, columns, _ in opened]) for i in range(order)]
        _, first, of = _grouped(_key(seed, symbols))
        counts = [np.bincount(of)]
        seed, symbols = seed[first], [s[first] for s in symbols]
        out = list(_statistics(_STATS, order, [seed], counts[0]))
        # Of each order, a gram that stands for its equals, and which of them every gram of the highest order has.
        rep, of = np.arange(len(seed)), np.arange(len(seed))
        for o in range(order - 1, 0, -1):
            _, first, to = _grouped(_key(seed[rep], [s[rep] for s in symbols[order - o :]]))
            c, rep, of = np.bincount(to), rep[first], to[of]
            counts.append(c[of])
            if o == 2:
                hot = layout.is_hot(symbols[-2][rep])
                out += _statistics(_HOT_CONTEXTS, o, [seed[rep][hot], symbols[-2][rep][hot]], c[hot])
            if o > 1:
                out += _statistics(_STATS, o, [seed[rep]], c)
        hot = layout.is_hot(symbols[-1][rep])
        out += _statistics(_HOT_ONES, 1, [seed[rep][hot], symbols[-1][rep][hot]], c[hot])
        out += _statistics(_STATS, 1, [seed[rep][~hot]], c[~hot])
        classes, who = np.unique(seed, return_inverse=True)
        ones = rep[~hot]
        unit = np.full(len(ones), rows.column("unit")[0].as_py())
        out += ({"kind": _ONES, "unit": u, "blob": b} for u, b in _parcels(layout, unit, who[ones], [classes], [symbols[-1][ones]], [c[~hot]]))
        # Neighbours and rising codes take less room when packed.
        last, before = (layout.codes(s)[0].astype(np.uint64) for s in (symbols[-1], symbols[-3]))
        near = np.argsort(_mixed(_START, symbols[-2]) >> _SHIFT << _SHIFT | last << np.uint64(16) | before)
        near = near[np.argsort(_least(who[near]), kind="stable")]
        symbols, counts = [s[near] for s in symbols], [c[near] for c in counts]
        unit = layout.units(symbols[-2], symbols[-3])
        out += ({"kind": _MODEL, "unit": u, "blob": b} for u, b in _parcels(layout, unit, who[near], [classes], symbols, counts))
        return pa.Table.from_pylist(out, _COUNTED)

    return counted


class _Sums(NamedTuple):
    """What holds for all units: by class, sorted, and for the symbols with several units, by the hash of class and symbol."""

    seeds: np.ndarray
    #: By order (from 1) and class, the discounts of the counts 1, 2 and more.
    discounts: list[np.ndarray]
    #: By class, of the lowest order: the sum of the counts, what every symbol gets, and the least probability.
    total: np.ndarray
    floor: np.ndarray
    unseen: np.ndarray
    ones: np.ndarray
    one_counts: np.ndarray
    contexts: np.ndarray
    context_seeds: np.ndarray
    context_totals: np.ndarray
    context_counts: np.ndarray

    def cut(self, o: int, cls: np.ndarray, c: np.ndarray) -> np.ndarray:
        return self.discounts[o - 1][cls, np.minimum(c, 3) - 1]

    def lowest(self, cls: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The probabilities of symbols with such counts."""
        return (c - self.cut(1, cls, c)) / self.total[cls] + self.floor[cls]


def _discounts(n: np.ndarray) -> np.ndarray:
    """The three discounts of the modified estimate from counts of counts; 0.5, 1 and 1.5 at most where one is zero."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return np.array([max(0.05 * i, min(i - (i + 1) * y * n[i] / n[i - 1], i)) if n[i - 1] and n[0] else 0.5 * i for i in (1, 2, 3)])


def _sums(counted: DataFrame, order: int) -> _Sums:
    """Rows per class and order, and per class and frequent symbol: few, as language tags and codes are."""
    sums = [F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "total", "size")]
    rows = counted.filter(F.col("kind").isin(_STATS, _HOT_ONES, _HOT_CONTEXTS)).groupBy("kind", "o", "seed", "w").agg(*sums, F.min("least").alias("least")).collect()
    as_key = lambda x: np.uint64(x % 2**64)
    seeds = np.unique(np.array([as_key(r.seed) for r in rows], np.uint64))
    place = {int(s): i for i, s in enumerate(seeds)}
    n, ones = np.zeros((order, len(seeds), 4)), [[] for _ in seeds]
    total, size = np.zeros(len(seeds)), np.zeros(len(seeds))
    hot: dict[int, list[tuple]] = {_HOT_ONES: [], _HOT_CONTEXTS: []}
    for r in rows:
        i = place[r.seed % 2**64]
        if r.kind == _STATS:
            n[r.o - 1, i] += [r.n1, r.n2, r.n3, r.n4]
            if r.o == 1:
                total[i] += r.total
                size[i] += r.size
                ones[i] += [c for c, has in ((1, r.n1), (2, r.n2), (r.least, r.size > r.n1 + r.n2)) if has]
        else:
            hot[r.kind].append((as_key(r.seed), as_key(r.w), r))
        if r.kind == _HOT_ONES:
            c = r.total
            if c <= 4:
                n[0, i, c - 1] += 1
            total[i] += c
            size[i] += 1
            ones[i].append(c)
    discounts = [np.array([_discounts(x) for x in level]).reshape(-1, 3) for level in n]

    def keyed(kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        seed, w = (np.array([h[k] for h in hot[kind]], np.uint64) for k in (0, 1))
        key = _key(seed, [w])
        at = np.argsort(key)
        return key[at], seed[at], w[at], [hot[kind][j][2] for j in at]

    one_keys, _, _, one_rows = keyed(_HOT_ONES)
    contexts, context_seeds, _, context_rows = keyed(_HOT_CONTEXTS)
    counts = np.array([[r.n1, r.n2, r.size - r.n1 - r.n2] for r in context_rows], float).reshape(-1, 3)
    more = size - n[0, :, 0] - n[0, :, 1]
    mass = (discounts[0] * np.stack([n[0, :, 0], n[0, :, 1], more], axis=1)).sum(axis=1)
    floor = mass / total / (size + 2)
    found = _Sums(
        seeds, discounts, total, floor, floor, one_keys, np.array([r.total for r in one_rows], np.int64),
        contexts, context_seeds, np.array([r.total for r in context_rows], float), counts,
    )
    unseen = [found.lowest(np.full(len(c), i), np.array(c)).min() for i, c in enumerate(ones)]
    return found._replace(unseen=np.array(unseen))


def _asked(layout: _Layout, seeds: np.ndarray, kinds: np.ndarray | None, most: int, order: int, hold: int, slices: int, at_slice: int):
    """The grams of the documents for the units of their contexts, and their symbols for their own units."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[list[np.ndarray]] = []
        symbols: list[list[np.ndarray]] = []
        names: list[list[np.ndarray]] = []
        size = held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            named = [np.concatenate(c) for c in zip(*names, strict=True)]
            for kind, waiting in ((_GRAMS, grams), (_SYMBOLS, symbols)):
                unit, who, *columns = (np.concatenate(c) for c in zip(*waiting, strict=True))
                yield from _sent(kind, _parcels(layout, unit, who, named, columns, []))

        for batch in pieces(batches):
            docs, classes = (batch.column(c).to_numpy().view(np.uint64) for c in ("_doc", "_seed"))
            judged = np.isin(classes, seeds)
            for at, flat, n in _runs(batch, kinds, most):
                who, own_docs = np.repeat(np.arange(len(n)), n), docs[at : at + len(n)]
                names.append([own_docs, classes[at : at + len(n)]])
                spread, place = _spread(flat, n, order)
                unit, heat = layout.homes(spread)
                wanted = judged[at : at + len(n)][who]
                for waiting, width, near, neighbour in (
                    (grams, order, place - 1, lambda hot: spread[place[hot] - 2]),
                    (symbols, 1, place, lambda hot: own_docs[who[hot]]),
                ):
                    to = layout.parted(unit[near], heat[near], neighbour)
                    own = np.flatnonzero((to % slices == at_slice) & wanted)
                    waiting.append([to[own], who[own] + held, *(spread[place[own] - back] for back in range(width - 1, -1, -1))])
                    size += len(own)
                held += len(n)
                if size > hold:
                    yield from sent()
                    grams, symbols, names, size, held = [], [], [], 0, 0
        if size:
            yield from sent()

    return rows


def _scored(layout: _Layout, sums: _Sums, order: int):
    """A unit: what its grams and symbols add to the log-probabilities of documents."""

    def levels(blobs: list[bytes]) -> list[tuple[_Index, np.ndarray, _Index, np.ndarray]]:
        """By order from 2: known grams and how far they are from the lowest order, known contexts and their weights."""
        opened = [_opened(layout, blob, 1, order) for blob in blobs]
        seed = np.concatenate([np.empty(0, np.uint64), *(names[0][who] for who, names, _, _ in opened)])
        symbols = [np.concatenate([np.empty(0, np.uint64), *(columns[i] for _, _, columns, _ in opened)]) for i in range(order)]
        counts = [np.concatenate([np.empty(0, np.int64), *(more[i].astype(np.int64) for *_, more in opened)]) for i in range(order)]
        cls = np.searchsorted(sums.seeds, seed)
        c = counts[order - 1]
        at, hot = _found(sums.ones, _key(seed, symbols[-1:]))
        c[hot] = sums.one_counts[at[hot]]
        lower = sums.lowest(cls, c)
        lowest, found = np.log(lower), []
        for o in range(2, order + 1):
            grams, first, of = _grouped(_key(seed, symbols[order - o :]))
            c, own = counts[order - o][first], cls[first]
            cut = sums.cut(o, own, c)
            contexts, _, back = _grouped(_key(seed[first], [s[first] for s in symbols[order - o : -1]]))
            total, mass = np.bincount(back, c, len(contexts)), np.bincount(back, cut, len(contexts))
            if o == 2 and len(sums.contexts):
                # Those of several units: this one needn't have all their grams, nor any.
                contexts, to = np.unique(np.concatenate([contexts, sums.contexts]), return_inverse=True)
                back, into = to[back], to[len(to) - len(sums.contexts) :]
                total, mass = (np.bincount(to[: len(a)], a, len(contexts)) for a in (total, mass))
                total[into] = sums.context_totals
                mass[into] = (sums.discounts[1][np.searchsorted(sums.seeds, sums.context_seeds)] * sums.context_counts).sum(axis=1)
            rest = mass / total
            p = (c - cut) / total[back] + rest[back] * lower[first]
            lower = p[of]
            found.append((_Index(grams), np.log(p) - lowest[first], _Index(contexts), np.log(rest)))
        return found

    def lowest(blobs: list[bytes]) -> tuple[_Index, np.ndarray]:
        opened = [_opened(layout, blob, 1, 1) for blob in blobs]
        seed = np.concatenate([np.empty(0, np.uint64), *(names[0][who] for who, names, _, _ in opened)])
        symbol = np.concatenate([np.empty(0, np.uint64), *(columns[0] for _, _, columns, _ in opened)])
        c = np.concatenate([np.empty(0, np.int64), *(more[0].astype(np.int64) for *_, more in opened)])
        key = _key(seed, [symbol])
        at = np.argsort(key)
        return _Index(key[at]), np.log(sums.lowest(np.searchsorted(sums.seeds, seed), c))[at]

    def scored(rows: pa.Table) -> pa.Table:
        blobs: dict[int, list[bytes]] = {kind: [] for kind in (_GRAMS, _SYMBOLS, _MODEL, _ONES)}
        for kind, blob in zip(rows.column("kind").to_pylist(), rows.column("blob").to_pylist(), strict=True):
            blobs[kind].append(blob)
        upper, (ones, values) = levels(blobs[_MODEL]), lowest(blobs[_ONES])
        docs, gains = [np.empty(0, np.uint64)], [np.empty(0)]
        for blob in blobs[_SYMBOLS]:
            who, (ids, seeds), (symbol,), _ = _opened(layout, blob, 2, 1)
            cls, key = np.searchsorted(sums.seeds, seeds)[who], _key(seeds[who], [symbol])
            gain = np.log(sums.unseen)[cls]
            at, known = ones.found(key)
            gain[known] = values[at[known]]
            at, known = _found(sums.ones, key)
            gain[known] = np.log(sums.lowest(cls[known], sums.one_counts[at[known]]))
            docs.append(ids)
            gains.append(np.bincount(who, gain, len(ids)))
        for blob in blobs[_GRAMS]:
            who, (ids, seeds), symbols, _ = _opened(layout, blob, 2, order)
            gain = np.zeros(len(who))
            for o, (grams, far, contexts, weight) in enumerate(upper, 2):
                at, known = contexts.found(_key(seeds[who], symbols[order - o : -1]))
                gain[known] += weight[at[known]]
                # A gram without a known context isn't known.
                rest = np.flatnonzero(known)
                at, known = grams.found(_key(seeds[who[rest]], [s[rest] for s in symbols[order - o :]]))
                gain[rest[known]] = far[at[known]]
            docs.append(ids)
            gains.append(np.bincount(who, gain, len(ids)))
        ids, of = np.unique(np.concatenate(docs), return_inverse=True)
        return pa.table({"_doc": ids.view(np.int64), "gain": np.bincount(of, np.concatenate(gains), len(ids))})

    return scored


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark drops the shuffle files of a job when it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _sieved(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows whose ids are trusted: first those that may be, by a bitmap of fixed size, so that few other texts are shuffled."""
    columns = rows.columns
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(SIEVE_BITS))
    mine = trusted.select(bit(F.col("_tid")).alias("_bit"))
    ones = F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 AS int))")).alias("_bits")
    bits = mine.groupBy(F.expr("_bit div 64").alias("_word")).agg(ones)
    rows = rows.withColumn("_bit", bit(F.col("_id").cast(trusted.schema["_tid"].dataType)))
    joined = rows.join(F.broadcast(bits), F.expr("_bit div 64") == F.col("_word"))
    joined = joined.filter("(shiftrightunsigned(_bits, cast(_bit % 64 AS int)) & 1L) = 1")
    # Trusted ids grow with the corpus: they are never broadcast. Not a semi join: Spark would do it before the sieve, and shuffle all texts.
    return joined.join(trusted.distinct().hint("merge"), F.col("_id") == F.col("_tid")).select(*columns)


def perplexities(
    docs: DataFrame, trusted: DataFrame, *, doc_id: str, text: str, lang: str, words: bool = False, folds: int = 1
) -> DataFrame:
    """``_id, _h, _class, n, chars, pairs, logp, trusted`` per row; ``trusted`` names the ids of trusted documents (``_tid``).

    ``n`` counts symbols, ``pairs`` the distinct pairs of neighbours among
    them (of words only). With one fold, the documents that a model has learnt
    are scored by it too.
    """
    with _freeing(docs.sparkSession):
        return _perplexities(docs, trusted, doc_id, text, lang, words, folds)


def _perplexities(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, lang: str, words: bool, folds: int) -> DataFrame:
    order = WORDS if words else ORDER
    kinds = _kinds(docs.sparkSession) if words else None
    body = docs[text].cast("string")
    rows = docs.select(
        docs[doc_id].alias("_id"), F.xxhash64(body).alias("_h"), body.alias("_text"), docs[lang].cast("string").alias("_lang")
    )
    counted = rows.select("_id", "_lang").join(trusted, rows["_id"] == trusted["_tid"]).groupBy("_lang").count()
    big = stage_table(counted.filter(F.col("count") >= MIN_TRUSTED).select(F.col("_lang").alias("_known")), "op8_languages")
    # The languages with enough trusted documents; a language tag is a short word, and there are few.
    rows = rows.join(big, rows["_lang"] == big["_known"], "left")
    rows = rows.select(*KEY, "_text", F.coalesce("_known", F.lit(POOLED)).alias("_language"))
    fold = F.pmod(F.coalesce("_h", F.lit(0)), F.lit(folds)).cast("int")
    of_fold = lambda k: F.xxhash64("_language", k)
    rows = rows.withColumn("_fold", fold).withColumn("_seed", of_fold(F.col("_fold")))
    scored = rows.withColumn("_doc", F.xxhash64(*KEY, "_seed"))

    surveyed, named = _survey(kinds, PIECE, SHARD_ROWS, CODES)
    survey = stage_table(scored.select("_doc", "_text").mapInArrow(surveyed, named), "op8_survey")
    layout = _layout(survey)
    units = layout.cold + int(layout.parts.sum())

    learn = _sieved(rows, trusted)
    taught = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    learn = learn.select("_text", "_language", "_fold", taught.alias("_to"))
    if folds > 1:
        learn = learn.filter("_to <> _fold")
    # Cut out once, not in every pass; the room is free again when the model is there.
    path = f"{stage_root(docs.sparkSession)}/op8_learn-{uuid.uuid4().hex[:12]}"
    learn.select(of_fold(F.col("_to")).alias("_seed"), "_text").write.option("compression", "zstd").parquet(path)
    learn = docs.sparkSession.read.schema("_seed long, _text string").parquet(path)
    slices = min(TRAIN_SLICES, units)
    parts = []
    for k in range(slices):
        grams = learn.mapInArrow(_learnt(layout, kinds, PIECE, order, SHARD_ROWS, slices, k), _SENT)
        parts.append(stage_table(grams.groupBy("unit").applyInArrow(_counted(layout, order), _COUNTED_KINDS), "op8_model"))
    model = reduce(DataFrame.unionAll, parts)
    sums = _sums(model, order)
    drop_path(docs.sparkSession, path)

    slices = min(SLICES, units)
    asked = scored.select("_doc", "_seed", "_text")
    parts = []
    for k in range(slices):
        sent = asked.mapInArrow(_asked(layout, sums.seeds, kinds, PIECE, order, SHARD_ROWS, slices, k), _SENT)
        own = model.filter(F.col("kind").isin(_MODEL, _ONES) & (F.col("unit") % slices == k)).select("unit", "kind", "blob")
        gains = sent.unionAll(own).groupBy("unit").applyInArrow(_scored(layout, sums, order), "_doc long, gain double")
        parts.append(stage_table(gains.groupBy("_doc").agg(F.sum("gain").alias("gain")), "op8_gains"))
    # The rows of a document that is repeated are summed together; each has its part.
    gained = reduce(DataFrame.unionAll, parts).groupBy("_doc").agg(F.sum("gain").alias("gain"))
    lengths = survey.filter("_doc IS NOT NULL").groupBy("_doc").agg(F.max("n").alias("n"), F.max("pairs").alias("pairs"), F.count("*").alias("k"))
    each = scored.select(*KEY, "_language", "_seed", "_doc", F.coalesce(F.length("_text"), F.lit(0)).cast("long").alias("chars"))
    each = each.join(lengths.hint("merge"), "_doc").join(gained.hint("merge"), "_doc", "left")
    judged = F.col("_seed").isin([int(s) for s in sums.seeds.view(np.int64)])
    each = each.select(
        *KEY, F.col("_language").alias("_class"), F.when(judged, F.col("n")).otherwise(0).cast("long").alias("n"), "chars", "pairs",
        F.when(judged, F.coalesce("gain", F.lit(0.0)) / F.col("k")).otherwise(0.0).alias("logp"),
    )
    each = stage_table(each, "op8_scores")
    marked = trusted.select("_tid", F.lit(True).alias("trusted"))
    return each.join(marked, each["_id"] == marked["_tid"], "left").select(
        *KEY, "_class", "n", "chars", "pairs", "logp", F.coalesce("trusted", F.lit(False)).alias("trusted")
    )


def _band() -> Column:
    """Lengths by powers of two, from 64 characters to 4096."""
    return F.greatest(F.lit(6), F.least(F.lit(12), F.floor(F.log2(F.col("chars").cast("double")))))


def trusted_ids(labels: DataFrame, *, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    return labels.groupBy(labels[doc_id].alias("_tid")).agg(F.min(labels[quality]).alias("q")).filter("q = 1").select("_tid")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    margin: float = MARGIN,
) -> DataFrame:
    """One row per row of ``docs``: ``_id, _h, n_chars, perplexity, threshold, rejected``.

    ``threshold`` is that of the perplexity.
    """
    scored = perplexities(docs, trusted_ids(labels), doc_id=doc_id, text=text, lang=lang, words=True, folds=FOLDS)
    scored = stage_table(
        scored.withColumn("level", F.when(F.col("n") > 0, -F.col("logp") / F.col("n")))
        .withColumn("variety", F.when(F.col("n") > 1, F.col("pairs") / (F.col("n") - 1)))
        .withColumn("band", _band()),
        "op8_levels",
    )
    learnt = scored.filter("trusted AND level IS NOT NULL")
    quantiles = F.concat(F.percentile_approx("level", [MIDDLE, UPPER], 10_000), F.percentile_approx("variety", [LOWER], 10_000))
    # Bands with too few trusted documents take the quantiles of the whole language.
    by_band = learnt.groupBy(F.col("_class").alias("_c"), F.col("band").alias("_b")).agg(
        quantiles.alias("q"), F.count("*").alias("k")
    )
    by_class = learnt.groupBy(F.col("_class").alias("_c")).agg(quantiles.alias("whole"))
    by_band = by_band.filter(F.col("k") >= MIN_TRUSTED).drop("k")
    joined = scored.join(by_class, scored["_class"] == by_class["_c"], "left").drop("_c")
    joined = joined.join(by_band, (joined["_class"] == by_band["_c"]) & (joined["band"] == by_band["_b"]), "left")
    q = F.coalesce("q", "whole")
    limit = q[1] + F.lit(margin) * (q[1] - q[0])
    return joined.select(
        *KEY,
        F.col("chars").alias("n_chars"),
        F.exp("level").alias("perplexity"),
        F.exp(limit).alias("threshold"),
        (F.coalesce(F.col("level") > limit, F.lit(False)) | F.coalesce(F.col("variety") < q[2], F.lit(False))).alias("rejected"),
    )
