"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A model file gives pieces with scores. The library that wrote it merges, in
the whole text, the adjacent pair whose joined piece scores highest, the
leftmost among equal scores, until no pair joins to a piece. Here this runs on
flat numpy arrays over the words of many texts at once:

* *Words.* Two characters that stand side by side in no piece can never come
  into one symbol, so a text is cut there; the words are independent of each
  other and equal words of a batch are merged once (found by hash, compared
  letter by letter).
* *Rounds.* One flat array of symbols with a pair rank at every place. Per
  word, the segmented minimum is the pair to merge; all its occurrences are
  merged at once, the leftmost first where they overlap. Then the arrays are
  compacted, ranks are looked up anew around the merges only, and words without
  a pair leave. It ends when none is left.
* *Order.* Merging one occurrence at a time could differ only if a merge makes
  a pair of the same or a better rank beside it. Such words (several
  occurrences, and a new pair ranked that well) merge only their leftmost
  occurrence in that round, which is what the library does next.

Characters in no piece become their UTF-8 bytes. A text gets the dummy blank
in front, blanks become U+2581, and the begin and end ids go round it. A long
text is taken in slices that end at a cut, so arrays don't grow with the text.

The model file is a parameter; the driver reads it (``MAX_MODEL`` bytes at
most) and Spark broadcasts it. It must be a BPE model with byte fallback, the
identity normaliser and no user-defined pieces; others raise ``ValueError``.

Defined cases: null is empty; an empty text has the begin and end ids only and
decodes to the empty text. Repeated rows are encoded as often as they occur. An
empty table gives no rows. Names of special pieces in a text are ordinary
text. Other columns are ignored. Decoding drops special ids and one leading
blank, and turns bytes that are no UTF-8 into U+FFFD; ids outside the model
raise ``ValueError``; null ids decode to the empty text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rebuy.llm.common import pieces as small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL = 64 * 1024 * 1024
#: Characters that are encoded at once.
SLICE = 1 << 19

# Kinds of pieces, the model kind and the blank of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
BLANK = 0x2581
UNKNOWN_SURFACE = " ⁇ "

_WIDTH = 21  # bits of a symbol: ids of pieces, then the code points in no piece
_NONE = np.iinfo(np.int32).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class PieceModel:
    """The tables of a model file."""

    def __init__(self, data: bytes) -> None:
        found: list[tuple[bytes, float, int]] = []
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                found.append((piece[1], struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        self.kinds = np.array([kind for _, _, kind in found], np.int8)
        plain = normalizer.get(1) == b"identity" and not normalizer.get(2) and normalizer.get(4) == 0 and normalizer.get(5, 1)
        if trainer.get(3) != BPE or not trainer.get(35) or not plain or np.isin(self.kinds, (USER_DEFINED, UNUSED)).any():
            raise ValueError("the model isn't BPE with byte fallback, identity normaliser and no user-defined pieces")
        self.n = len(found)
        self.dummy = bool(normalizer.get(3, 1))
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        surface = trainer.get(44, UNKNOWN_SURFACE.encode())
        strings = [raw.decode() for raw, _, _ in found]
        normal = {strings[i]: i for i in np.flatnonzero(self.kinds == NORMAL)}

        # Symbols of characters and the byte pieces.
        self.symbol = np.arange(self.n, self.n + 0x110000, dtype=np.int32)
        for text, i in normal.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        self.bytes = np.full(256, -1, np.int32)
        for i in np.flatnonzero(self.kinds == BYTE):
            self.bytes[int(strings[i][3:5], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError("the model lacks byte pieces")

        # Pairs of symbols that join to a piece, by key; equal scores share a rank.
        scores = np.array([score for _, score, _ in found], np.float32)
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        joins: dict[int, int] = {}
        sides: set[tuple[str, str]] = set()
        for text, i in normal.items():
            sides.update(zip(text, text[1:], strict=False))
            for cut in range(1, len(text)):
                left, right = (self._part(part, normal) for part in (text[:cut], text[cut:]))
                if left is not None and right is not None:
                    joins[(left << _WIDTH) | right] = i
        self.keys = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[key] for key in self.keys.tolist()], np.int32)
        # A slot for each key by its hash, the next free one where it is taken.
        self.shift = np.uint64(64 - max(8, (8 * len(joins)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        for k, slot in enumerate(self._slot(self.keys).tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) % len(self.slots)
            self.slots[slot] = k

        # A bit for each two characters that stand side by side in some piece.
        letters = sorted({c for pair in sides for c in pair})
        number = {c: k for k, c in enumerate(letters, 1)}
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        bits = np.zeros(self.letters * self.letters, bool)
        bits[[number[a] * self.letters + number[b] for a, b in sides]] = True
        self.beside = np.packbits(bits, bitorder="little")

        # What the pieces decode to.
        texts = [
            surface if kind == UNKNOWN else b"" if kind == CONTROL else bytes([int(text[3:5], 16)]) if kind == BYTE else text.replace(chr(BLANK), " ").encode()
            for text, kind in zip(strings, self.kinds.tolist(), strict=True)
        ]
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.text_size = np.array([len(t) for t in texts], np.int64)
        self.text_start = np.cumsum(self.text_size) - self.text_size

    def _part(self, text: str, normal: dict[str, int]) -> int | None:
        """The symbol of a part of a piece; None if no merge can make it."""
        found = normal.get(text)
        return found if found is not None else self.n + ord(text) if len(text) == 1 else None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols joins to, or -1."""
        keys = (left.astype(np.int64) << _WIDTH) | right
        out = np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        found = self.slots[slot]
        open_ = np.flatnonzero(found >= 0)
        while len(open_):
            at = found[open_]
            same = self.keys[at] == keys[open_]
            out[open_[same]] = self.joined[at[same]]
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) % len(self.slots)
            found[open_] = self.slots[slot[open_]]
            open_ = open_[found[open_] >= 0]
        return out

    def ranks(self, joined: np.ndarray) -> np.ndarray:
        return np.where(joined >= 0, self.rank[joined], _NONE)

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character (the first always does)."""
        letter = self.letter[codes].astype(np.int64)
        pair = letter[:-1] * self.letters + letter[1:]
        joins = (self.beside[pair >> 3] >> (pair & 7)) & 1
        return np.concatenate([np.ones(min(1, len(codes)), bool), joins == 0])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def distinct_words(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, which)``: a representative of each distinct word, and each word's place among them."""
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    hashed = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * powers[place], starts)
    _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
    model = first[which]
    if (sizes[model] == sizes).all() and (codes[_ranges(starts[model], sizes)] == codes).all():
        return first, which
    every = np.arange(len(starts))  # two words share a hash: each stands for itself
    return every, every


def merge_rounds(model: PieceModel, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words (``sizes`` symbols each, none empty) until no pair joins: symbols and sizes."""
    word = np.repeat(np.arange(len(sizes)), sizes)
    symbols = symbols.astype(np.int32)

    def look_up(at: np.ndarray) -> np.ndarray:
        """What the pair at each of these places joins to; nothing across words."""
        right = np.minimum(at + 1, len(symbols) - 1)
        inside = (right > at) & (word[right] == word[at])
        return np.where(inside, model.pairs(symbols[at], symbols[right]), -1)

    done: list[tuple[np.ndarray, np.ndarray]] = []
    made = look_up(np.arange(len(symbols)))
    while len(symbols):
        rank = model.ranks(made)
        begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lengths = np.diff(np.append(begins, len(word)))
        least = np.minimum.reduceat(rank, begins)
        active = least < _NONE
        if not active.all():
            stays = np.repeat(active, lengths)
            done.append((word[~stays], symbols[~stays]))
            word, symbols, made, rank = word[stays], symbols[stays], made[stays], rank[stays]
            least, lengths = least[active], lengths[active]
            if not len(symbols):
                break
        floor = np.repeat(least, lengths)
        best = rank == floor
        # In a run of overlapping occurrences, every other one from the left.
        places = np.arange(len(best))
        opens = best & ~np.concatenate([[False], best[:-1]])
        run = np.maximum.accumulate(np.where(opens, places, 0))
        at = np.flatnonzero(best & ((places - run) % 2 == 0))
        owner = word[at]
        single = np.concatenate([[True], owner[1:] != owner[:-1]])
        if not single.all():
            several = ~single | np.append(~single[1:], False)
            early = np.zeros(len(sizes), bool)
            early[_out_of_order(model, symbols, word, made, floor, at[several])] = True
            at = at[single | ~early[owner]]
        symbols[at] = made[at]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        word, symbols, made = word[stays], symbols[stays], made[stays]
        now = at - np.arange(len(at))
        changed = np.zeros(len(symbols), bool)
        changed[now] = changed[np.maximum(now - 1, 0)] = True
        near = np.flatnonzero(changed)
        made[near] = look_up(near)
    words = np.concatenate([w for w, _ in done]) if done else word
    order = np.argsort(words, kind="stable")
    merged = np.concatenate([s for _, s in done]) if done else symbols
    return merged[order], np.bincount(words, minlength=len(sizes))


def _out_of_order(model: PieceModel, symbols, word, made, floor, at) -> np.ndarray:
    """The words (some repeatedly) in which some merge of this round makes a pair that would have come before the next merge."""
    size = len(symbols)
    new = made[at]
    # On the left stands what the round leaves there, on the right what stands there now.
    left = symbols.copy()
    left[at + 1] = new
    before, after = np.maximum(at - 1, 0), np.minimum(at + 2, size - 1)
    early = np.zeros(len(at), bool)
    for beside, pair in (
        ((at > 0) & (word[before] == word[at]), (left[before], new)),
        ((at + 2 < size) & (word[after] == word[at]), (new, symbols[after])),
    ):
        early |= beside & (model.ranks(model.pairs(*pair)) <= floor[at])
    return word[at[early]]


def _encode_codes(model: PieceModel, codes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the characters, and to which character's word each belongs (the word's first)."""
    starts = np.flatnonzero(cuts)
    sizes = np.diff(np.append(starts, len(codes)))
    first, which = distinct_words(codes, starts, sizes)
    symbols, counts = merge_rounds(model, model.symbol[codes[_ranges(starts[first], sizes[first])]], sizes[first])
    # Characters in no piece become bytes.
    strange = np.flatnonzero(symbols >= model.n)
    if len(strange):
        raw = [chr(c).encode() for c in (symbols[strange] - model.n).tolist()]
        width = np.ones(len(symbols), np.int64)
        width[strange] = [len(r) for r in raw]
        owner = np.repeat(np.repeat(np.arange(len(counts)), counts), width)
        symbols = np.repeat(symbols, width)
        symbols[np.flatnonzero(symbols >= model.n)] = model.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        counts = np.bincount(owner, minlength=len(counts))
    offsets = np.cumsum(counts) - counts
    return symbols[_ranges(offsets[which], counts[which])], np.repeat(starts, counts[which])


def encode(model: PieceModel, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of each text, begin and end ids included."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    group: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if not group:
            return
        sizes = np.array([len(codes) for _, codes in group])
        begins = np.cumsum(sizes) - sizes
        codes = np.concatenate([codes for _, codes in group])
        cuts = model.cuts(codes)
        cuts[begins] = True
        ids, places = _encode_codes(model, codes, cuts)
        for (text, _), low, high in zip(group, np.searchsorted(places, begins), np.searchsorted(places, begins + sizes), strict=True):
            parts[text].append(ids[low:high])
        group, held = [], 0

    for number, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(((" " if model.dummy else "") + text).encode("utf-32-le"), np.uint32)
        codes = np.where(codes == 32, np.uint32(BLANK), codes)
        at = 0
        while at < len(codes):
            width = SLICE
            while at + width < len(codes):  # a slice ends where a word does
                cuts = np.flatnonzero(model.cuts(codes[at : at + width + 1]))
                if cuts[-1] > 0:
                    width = int(cuts[-1])
                    break
                width *= 2
            piece = codes[at : at + width]
            if held + len(piece) > SLICE:
                flush()
            group.append((number, piece))
            held += len(piece)
            at += len(piece)
    flush()
    begin, end = np.array([model.begin], np.int32), np.array([model.end], np.int32)
    return [np.concatenate([begin, *found, end]).astype("<u4") for found in parts]


def _decode_bytes(raw: bytes) -> str:
    """Bytes as text; each byte that begins no character is U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def decode(model: PieceModel, ids: np.ndarray) -> str:
    """The text of the ids."""
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= model.n):
        raise ValueError("an id is outside the model")
    kept = np.flatnonzero(model.kinds[ids] != CONTROL)
    ids = ids[kept]
    is_byte = model.kinds[ids] == BYTE
    parted = (np.diff(kept) > 1) & is_byte[:-1] & is_byte[1:]  # special ids part runs of byte pieces
    raw = model.text_bytes[_ranges(model.text_start[ids], model.text_size[ids])].tobytes()
    leading = int(model.dummy and len(ids) > 0 and model.kinds[ids[0]] == NORMAL and raw[:1] == b" ")
    if not parted.any():
        try:
            return raw[leading:].decode()
        except UnicodeDecodeError:
            pass
    # Runs of byte pieces are read by themselves.
    ends = np.flatnonzero(np.append((is_byte[1:] != is_byte[:-1]) | parted, True)) + 1
    places = np.concatenate([[0], np.cumsum(model.text_size[ids])])
    out, start = [], 0
    for end in ends.tolist():
        part = raw[places[start] : places[end]]
        out.append(_decode_bytes(part) if is_byte[start] else part.decode())
        start = end
    return "".join(out)[leading:]


_loaded: dict[int, PieceModel] = {}


def piece_model(data: bytes) -> PieceModel:
    """The tables of a model file, made once per Python process."""
    name = hash(data)
    if name not in _loaded:
        _loaded[name] = PieceModel(data)
    return _loaded[name]


def _shared(rows: DataFrame, path: str):
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL + 1)
    if len(data) > MAX_MODEL:
        raise ValueError(f"{path} has over {MAX_MODEL} bytes")
    PieceModel(data)  # an unfit model fails here, not in the tasks
    return rows.sparkSession.sparkContext.broadcast(data)


def encode_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """``_id, ids``: the ids of every row's whole text as little-endian unsigned 32-bit integers."""
    shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = piece_model(shared.value)
        for batch in small_batches(batches):
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            found = encode(tables, [t.decode("utf-8", "replace") if t else None for t in raw])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i.tobytes() for i in found], pa.binary())], ["_id", "ids"])

    rows = docs.select(docs[doc_id].alias("_id"), docs[text].cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, ids binary")


def decode_documents(encoded: DataFrame, *, model: str = MODEL) -> DataFrame:
    """``_id, ids, text`` of rows ``_id, ids`` as ``encode_documents`` gives them."""
    shared = _shared(encoded, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = piece_model(shared.value)
        for batch in small_batches(batches):
            texts = [decode(tables, np.frombuffer(raw or b"", "<u4")) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["_id", "ids", "text"])

    rows = encoded.select("_id", "ids")
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, ids binary, text string")
