"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two strings counts the sequences of three letters that both
hold, in order but not necessarily next to each other; an occurrence that
spans s characters weighs ``DECAY ** s``. Inserted characters and gaps thus
weaken a match without breaking it: ``i-d.i*o t`` is close to ``idiot``. It is
normalised to 1 for equal strings. Only letters match; all other characters
lengthen spans.

*Training*, on a bounded sample of labelled documents (``SAMPLE`` of either
class, those of smallest id hashes): the sentences of a document carry its
label, but a toxic document need hold only one toxic word. So *witnesses* are
chosen first. The support of a word is its number of toxic documents, where
those that copy one another (by a min-hash of their longer words) count once,
against the clean documents that hold it. Words whose support can't be chance
are witnesses (``SURE``, the likelihood ratio in nats); then, greedily, those
that explain most toxic documents not yet explained. Witnesses are the
positive, words of clean documents the negative examples, and each costs as
many documents as hold it: a clean word that looks like an insult has the
weight of its documents, in every language. Their kernels to ``LANDMARKS``
landmarks, times the inverse root of the landmarks' kernel, are the features of
a linear machine with squared hinge loss. In rounds, the clean words that it
misjudges are added as negatives, until it has seen all that it misjudges. A
logistic curve fitted on the sample's documents turns margins into scores.

*Scoring.* The decision is linear in the kernels, and a kernel is linear in the
counts of three-letter sequences, so landmarks and weights fold into one weight
per sequence that a landmark holds, which are broadcast. Letters of all scripts
count by their own code. Every word of every text is scored once per task and
the margin of a document is that of its worst word. Words longer than ``WIDTH``
characters are read in overlapping windows; runs of single letters and short
neighbours (``id iot``) are also read as one word.

Defined cases: null and empty texts have no word and get the score of the
kernel's zero. Without labels of both classes, every score is the share of
toxic labels with one of either added. Labels other than 0 and 1 are none; an
id labelled twice is toxic if any label says so. A null id is never labelled.
Repeated rows each get the result. An empty table gives no rows. Only the text
enters a score; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.common import KEY, pieces, stage_table

DECAY = 0.5
#: Places of the table of three-letter sequences; beyond, they are looked up.
TABLE = 1 << 22
WIDTH = 24
#: Letters of neighbours that are also read as one word, and of that word at least.
SHORT, LEAST_JOINED = 3, 5
SAMPLE = 10_000
LANDMARKS = 192
#: Words of clean sentences that training starts with, and those added a round, until none is misjudged.
CLEAN_WORDS, HARD_WORDS = 10_000, 1_000
#: Most witnesses, the words among which they are chosen, and the documents that one must explain beyond the others'.
WITNESSES, SUSPECTS, LEAST_EXPLAINED = 1_000, 50_000, 2
#: Evidence, in nats, of a witness by itself, and of one that explains what others don't.
SURE, LIKELY = 9.0, 5.5
#: Letters of a word from which on it tells a document from others that aren't its copies.
LONG = 8
COST = 10.0
#: Word scores that a task keeps.
KEPT = 1_000_000

_EDGES = ".,;:!?\"'()[]{}<>|%&$#*"
_LETTER = (1 << 21) - 1
_PADDED = (4, 6, 8, 10, 12, 16, 20, WIDTH)


def words(text: str) -> set[str]:
    """The distinct words of a text in lower case, its runs of single letters, and neighbours of ``SHORT`` letters at most, as words."""
    parts = text.lower().split()
    bare = {p: p.strip(_EDGES) for p in set(parts)}
    found = set(bare.values())
    single = bytes([len(p) == 1 for p in parts])
    at = single.find(b"\1\1\1")
    while at >= 0:
        past = single.find(b"\0", at)
        past = past if past >= 0 else len(parts)
        found.add(" ".join(parts[at:past]))
        at = single.find(b"\1\1\1", past)
    short = {p: b for p, b in bare.items() if 2 <= len(b) <= SHORT}
    pairs = {(a, b) for a, b in zip(parts, parts[1:]) if a in short and b in short}
    found.update(f"{short[a]} {short[b]}" for a, b in pairs if len(short[a]) + len(short[b]) >= LEAST_JOINED)
    return found


def _letters(strings: list[str], width: int) -> np.ndarray:
    """Letters as their code points, everything else and the padding as 0."""
    joined = "".join(s.ljust(width, "\0") for s in strings)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = ((points >= 97) & (points <= 122)) | (points >= 0xAA)
    return np.where(letter, points, 0).reshape(len(strings), width)


def _windows(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    return [word[at : at + WIDTH] for at in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def _norms(x: np.ndarray) -> np.ndarray:
    """Root of the kernel of each string with itself."""
    n, width = x.shape
    match = ((x[:, :, None] == x[:, None, :]) & (x[:, :, None] > 0)).astype(np.float32)
    lag = np.subtract.outer(np.arange(width), np.arange(width))
    decay = np.where(lag > 0, DECAY ** np.maximum(lag, 0), 0).astype(np.float32)
    held = match * np.float32(DECAY**2)
    for _ in range(2):
        held = (held.reshape(-1, width) @ decay.T).reshape(n, width, width).transpose(0, 2, 1)
        held = (np.ascontiguousarray(held).reshape(-1, width) @ decay.T).reshape(n, width, width)
        held = held * match
    return np.sqrt(held.sum((1, 2), dtype=np.float64))


class Sequences:
    """A number for each of some sequences of three letters, of any script; 0 for all others.

    ``keys`` are the sequences, sorted, 21 bits a letter. Letters that occur in
    them get short codes. Three codes are a place in a table where that has
    ``TABLE`` places at most, else they are looked up among the keys.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values
        parts = np.stack([keys >> 42, (keys >> 21) & _LETTER, keys & _LETTER])
        self.alphabet = np.unique(parts)
        self.size = len(self.alphabet) + 1
        coded = np.searchsorted(self.alphabet, parts) + 1
        self._coded = (coded[0] * self.size + coded[1]) * self.size + coded[2]
        self._table = None
        if self.size**3 <= TABLE:
            self._table = np.zeros(self.size**3, dtype=np.int32)
            self._table[self._coded] = np.arange(len(keys)) + 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Letters as numbers from 1; 0 where no key holds the letter."""
        if not len(self.alphabet):
            return np.zeros_like(x)
        at = np.minimum(np.searchsorted(self.alphabet, x), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == x, at + 1, 0)

    def places(self, coded: np.ndarray) -> np.ndarray:
        """The number of each key, from 1, or 0."""
        if self._table is not None:
            return self._table[coded]
        at = np.minimum(np.searchsorted(self._coded, coded), len(self._coded) - 1)
        return np.where(self._coded[at] == coded, at + 1, 0)

    def __matmul__(self, other: Sequences) -> float:
        _, mine, others = np.intersect1d(self.keys, other.keys, assume_unique=True, return_indices=True)
        return float(self.values[mine] @ other.values[others])


def _summed(parts: list[tuple[float, Sequences]]) -> Sequences:
    keys, at = np.unique(np.concatenate([m.keys for _, m in parts]), return_inverse=True)
    return Sequences(keys, np.bincount(at, np.concatenate([a * m.values for a, m in parts]), len(keys)))


def _projected(x: np.ndarray, weights: Sequences) -> np.ndarray:
    """Sum over the three-letter sequences of each string of decayed weight."""
    total = np.zeros(len(x))
    values = np.concatenate([[0.0], weights.values])
    if weights._table is not None:
        values = values[weights._table]
    x = weights.codes(x)
    for i in range(x.shape[1] - 2):
        for j in range(i + 1, x.shape[1] - 1):
            pair = (x[:, i] * weights.size + x[:, j]) * weights.size
            for k in range(j + 1, x.shape[1]):
                coded = pair + x[:, k]
                total += DECAY ** (k - i + 1) * values[coded if weights._table is not None else weights.places(coded)]
    return total


def features(string: str) -> Sequences:
    """The normalised decayed counts of all three-letter sequences of a string."""
    made: dict[int, float] = {}
    letters = [(at, int(c)) for at, c in enumerate(_letters([string], max(len(string), 1))[0]) if c]
    for (i, a), (_, b), (k, c) in combinations(letters, 3):
        key = (a << 42) | (b << 21) | c
        made[key] = made.get(key, 0.0) + DECAY ** (k - i + 1)
    keys = np.array(sorted(made), dtype=np.int64)
    values = np.array([made[k] for k in keys.tolist()])
    norm = np.sqrt((values * values).sum())
    return Sequences(keys, values / norm if norm else values)


def _by_width(strings: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the strings' windows, by padded width, and the string that each is of."""
    found: dict[int, tuple[list[int], list[str]]] = {}
    for at, string in enumerate(strings):
        for window in _windows(string):
            place = found.setdefault(next(w for w in _PADDED if len(window) <= w), ([], []))
            place[0].append(at)
            place[1].append(window)
    for width, (places, windows) in found.items():
        for start in range(0, len(windows), 8192):
            yield _letters(windows[start : start + 8192], width), np.array(places[start : start + 8192])


def normalised(strings: list[str], weights: Sequences) -> np.ndarray:
    """Of each string, the inner product of its normalised features with the weights; the largest of its windows."""
    result = np.full(len(strings), -np.inf)
    for x, at in _by_width(strings):
        norms = _norms(x)
        np.maximum.at(result, at, np.where(norms > 0, _projected(x, weights) / np.maximum(norms, 1e-30), 0))
    return result


def kernel(strings: list[str], landmarks: list[Sequences]) -> np.ndarray:
    """The normalised kernel of each string (its first window) with each landmark, given by its features."""
    used = _summed([(1.0, m) for m in landmarks])
    table = np.zeros((len(used.keys) + 1, len(landmarks)), dtype=np.float32)
    for n, m in enumerate(landmarks):
        table[np.searchsorted(used.keys, m.keys) + 1, n] = m.values
    result = np.zeros((len(strings), len(landmarks)))
    for x, at in _by_width([s[:WIDTH] for s in strings]):
        norms = np.maximum(_norms(x), 1e-30)
        x = used.codes(x)
        for i, j, k in combinations(range(x.shape[1]), 3):
            cells = used.places((x[:, i] * used.size + x[:, j]) * used.size + x[:, k])
            hit = np.flatnonzero(cells)
            if len(hit):
                result[at[hit]] += DECAY ** (k - i + 1) * table[cells[hit]] / norms[hit, None]
    return result


def _fitted(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps in the primal; the last weight is the bias."""
    z = np.hstack([z, np.ones((len(z), 1))])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(z.shape[1])
    held = None
    for _ in range(30):
        active = y * (z @ w) < 1
        if held is not None and (active == held).all():
            break
        held = active
        za = z[active]
        w = np.linalg.solve(ridge + (za.T * cost[active]) @ za, za.T @ (cost[active] * y[active]))
    return w


class Machine:
    """Weights of the three-letter sequences, bias, and slope and shift of the logistic curve."""

    def __init__(self, weights: Sequences, bias: float, slope: float = 1.0, shift: float = 0.0) -> None:
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def margins(self, strings: list[str]) -> np.ndarray:
        return normalised(strings, self.weights) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def trained(positives: list[str], gains: np.ndarray, negatives: list[str], losses: np.ndarray) -> Machine:
    """The machine of two sets of words; gains and losses are the documents that a mistake on each would cost."""
    half = LANDMARKS // 2
    landmarks = [*positives[:half], *negatives[: LANDMARKS - min(half, len(positives))]]
    mapped = [features(s[:WIDTH]) for s in landmarks]
    inner = kernel([s[:WIDTH] for s in landmarks], mapped)
    inner = (inner + inner.T) / 2
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    strings = positives + negatives
    y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
    cost = np.concatenate([gains, losses]) * COST
    w = _fitted(kernel(strings, mapped) @ root, y, cost)
    folded = root @ w[:-1]
    return Machine(_summed(list(zip(folded, mapped, strict=True))), float(w[-1]))


def evidence(support: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood ratio of a word's share of toxic documents against the share of all; 0 where it is lower."""
    n = np.maximum(support + good, 1)
    rate = support / n
    with np.errstate(divide="ignore", invalid="ignore"):
        made = support * np.log(rate / share) + np.where(good > 0, good * np.log((1 - rate) / (1 - share)), 0)
    return np.where((rate > share) & (support > 0), made, 0)


def witnesses(holders: dict[str, set[int]], sure: list[str]) -> tuple[list[str], np.ndarray]:
    """The sure words, then those that explain most groups of toxic documents that no witness explains yet; with weights."""
    chosen = sure[:WITNESSES]
    weights = [1.0] * len(chosen)
    everything = set().union(*holders.values()) if holders else set()
    open_ = everything - set().union(*(holders[w] for w in chosen)) if chosen else everything
    # Gains only fall, so a word at the top of the heap whose gain still holds is the best.
    heap = [(-len(h), len(w), w) for w, h in holders.items() if w not in set(chosen)]
    heapify(heap)
    while heap and open_ and len(chosen) < WITNESSES:
        known, _, word = heappop(heap)
        gain = len(holders[word] & open_)
        if gain < LEAST_EXPLAINED:
            continue
        if gain < -known:
            heappush(heap, (-gain, len(word), word))
            continue
        chosen.append(word)
        weights.append(0.5)
        open_ -= holders[word]
    return chosen, np.array(weights)


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with a little weight decay so that separable data end too."""
    x = np.column_stack([margin, np.ones(len(margin))])
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _decoded(column: pa.Array) -> Iterable[str]:
    return ((t or b"").decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist())


def _worst(machine: Machine, texts: Iterable[str], kept: dict[str, float]) -> list[float]:
    """The margin of each text's worst word."""
    held = [words(t) for t in texts]
    new = list(set().union(*held) - kept.keys()) if held else []
    kept.update(zip(new, machine.margins(new).tolist(), strict=True))
    return [max((kept[w] for w in own), default=machine.bias) for own in held]


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        found = [sorted(w for w in words(t) if len(w) > 2) for t in _decoded(batch.column("_text"))]
        group = [min((xxhash.xxh3_64_intdigest(w) >> 1 for w in own if len(w) >= LONG), default=None) for own in found]
        group = [g if g is not None else xxhash.xxh3_64_intdigest(" ".join(own)) >> 1 for g, own in zip(group, found, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(group, pa.int64()), pa.array(found, pa.list_(pa.string()))], ["toxic", "grp", "words"]
        )


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str, sample: int = SAMPLE) -> Machine | float:
    """The machine learnt from ``labels`` (``_lid, toxic``), or the constant score without both classes."""
    picked = []
    for value in (0, 1):
        of = labels.filter(F.col("toxic") == value)
        picked.append(of.orderBy(F.xxhash64("_lid"), "_lid").limit(sample))
    chosen = stage_table(picked[0].unionAll(picked[1]), "op1_sample")
    rows = docs.select(docs[doc_id].alias("_id"), docs[text].cast("string").alias("_text"))
    # At most 2 * sample ids of 8 bytes.
    rows = rows.join(F.broadcast(chosen), rows["_id"] == chosen["_lid"]).select("_text", "toxic").filter("_text IS NOT NULL")
    held = stage_table(rows.mapInArrow(_sample_words, "toxic int, grp long, words array<string>"), "op1_words")
    groups = {r.toxic: r.n for r in held.groupBy("toxic").agg(F.countDistinct("grp").alias("n")).collect()}
    if len(groups) < 2:
        n = sum(groups.values())
        return (groups.get(1, 0) + 1) / (n + 2)
    share = groups[1] / (groups[0] + groups[1])

    tokens = held.select("toxic", "grp", F.explode("words").alias("word")).distinct()
    total = tokens.groupBy("word").agg(F.sum("toxic").alias("support"), F.sum(1 - F.col("toxic")).alias("good"))
    total = stage_table(total, "op1_counts")
    likely = F.col("support") * 4 * (1 - share) >= F.col("good") * share * 16
    suspects = total.filter((F.col("support") >= LEAST_EXPLAINED) & likely)
    suspects = stage_table(suspects.orderBy(F.desc("support"), F.xxhash64("word")).limit(SUSPECTS), "op1_suspects")
    found = suspects.toArrow()
    names = found.column("word").to_pylist()
    ratio = evidence(found.column("support").to_numpy(), found.column("good").to_numpy(), share)
    sure = [names[i] for i in np.argsort(-ratio, kind="stable") if ratio[i] >= SURE]
    incidence = tokens.filter("toxic = 1").join(suspects.select("word"), "word", "left_semi").select("word", "grp")
    holders: dict[str, set[int]] = {}
    # Less likely words explain nothing.
    likely_names = {names[i] for i in np.flatnonzero(ratio >= LIKELY)}
    for word, group in zip(*(c.to_pylist() for c in incidence.toArrow().columns), strict=True):  # bounded by the sample
        if word in likely_names:
            holders.setdefault(word, set()).add(group)
    positives, weights = witnesses(holders, sure)
    if not positives:
        return (groups[1] + 1) / (groups[0] + groups[1] + 2)
    good = total.filter("good > 0")
    held_by = dict(zip(names, found.column("support").to_pylist(), strict=True))
    weights = weights * np.array([held_by[w] for w in positives])
    clean = {r.word: r.good for r in good.orderBy(F.xxhash64("word")).limit(CLEAN_WORDS).collect()}
    negatives = list(clean)
    machine = trained(positives, weights, negatives, np.array([clean[w] for w in negatives], dtype=float))
    while True:
        # The clean words on the wrong side that aren't learnt yet; those beyond HARD_WORDS have their turn in the next round.
        hard = good.select("word", "good").mapInArrow(_misjudged(machine, set(clean)), "word string, good long, margin double")
        most = {r.word: r.good for r in hard.orderBy(F.desc("margin"), "word").limit(HARD_WORDS).collect()}
        if not most:
            break
        clean.update(most)
        # Hard words also become landmarks, before the others.
        negatives = [*most, *negatives]
        machine = trained(positives, weights, negatives, np.array([clean[w] for w in negatives], dtype=float))
    margins = held.mapInArrow(_held_margins(machine), "toxic int, margin double").toArrow()  # 2 * sample rows at most
    machine.slope, machine.shift = _logistic(margins.column("margin").to_numpy(), margins.column("toxic").to_numpy())
    return machine


def _misjudged(machine: Machine, learnt: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array([w not in learnt for w in batch.column("word").to_pylist()], pa.bool_()))
            got = machine.margins(rest.column("word").to_pylist())
            made = pa.RecordBatch.from_arrays([*rest.columns, pa.array(got, pa.float64())], ["word", "good", "margin"])
            yield made.filter(pa.array(got > 0))

    return run


def _held_margins(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, float] = {}
        for batch in batches:
            worst = []
            for own in batch.column("words").to_pylist():
                new = [w for w in own if w not in kept]
                kept.update(zip(new, machine.margins(new).tolist(), strict=True))
                worst.append(max((kept[w] for w in own), default=machine.bias))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(worst, pa.float64())], ["toxic", "margin"])

    return run


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, kept = shared.value, {}
        for batch in pieces(batches):
            if len(kept) > KEPT:
                kept = {}
            scores = machine.score(np.array(_worst(machine, _decoded(batch.column("_text")), kept))).tolist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEY), pa.array(scores, pa.float64())], [*KEY, "score"]
            )

    return run


def toxic_labels(labels: DataFrame, *, doc_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """``_lid, toxic``: one row per labelled id."""
    valid = labels.filter(labels[toxic].isin(0, 1) & labels[doc_id].isNotNull())
    return valid.groupBy(labels[doc_id].alias("_lid")).agg(F.max(labels[toxic]).cast("int").alias("toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id, _h, score`` of every row, from a machine learnt on ``labels`` (``_lid, toxic``)."""
    machine = fit(docs, labels, doc_id=doc_id, text=text)
    body = docs[text].cast("string")
    rows = docs.select(docs[doc_id].alias("_id"), F.xxhash64(body).alias("_h"), body.alias("_text"))
    if isinstance(machine, float):
        return rows.select(*KEY, F.lit(machine).alias("score"))
    kinds = dict(rows.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return rows.mapInArrow(_scorer(shared), f"_id {kinds['_id']}, _h long, score double")
