"""Exact similarity join of shingle sets, skipping by relations between sets.

Two sets link when ``100 * intersection >= threshold * union``. The join asks
for the components of the links, so it need not spell out every link inside a
group of near copies, but it may lose none between groups.

1. *Equal sets* become one node, whatever their number.
2. *Index.* Each node is listed under its prefix: the first
   ``n - ceil(t n) + 1`` shingles in one order of all shingles, which is that
   of their hashes, but for common ones, which come last. Linked sets meet in
   a list under any order, so what counts as common touches only the cost: a
   shingle does if its low bits are marked in a map of fixed size, made from
   those that ``COMMON`` documents or more have in the first 15 % of their
   hash order. Passages that many documents share so leave the lists.
3. *Answers from a similar set.* Nodes of a large group of similar sets take
   as their home a pivot with which they share many lists, and keep only
   their difference from it. For x
   and y of a home r, the intersection follows from r's:
   ``|x & y| = |r| - |r-x| - |r-y| + |dx & dy|``, where ``dx`` is all by which
   x differs from r. Members linked to r need no comparison with each other;
   the others are compared with every member through the differences alone.
4. *Index-level skipping.* Pairs of different homes that share a list are
   compared within the range of sizes that can link. Long lists are walked in
   blocks, and blocks whose positions leave too few shingles for the needed
   overlap are skipped whole. Short lists are joined as they are; a pair found
   there goes on if one of its positions leaves enough, and if it shares as
   many prefix shingles as linked sets of these sizes must. What remains is
   verified on the full sets.
5. Links become components (``components.connected``).

Hot lists and hot homes are cut into blocks, and a task holds one pair of
blocks. Shingles and sets are named by 64-bit hashes: among 10**9 different
texts one false merge is expected in about 40 such corpora.

Defined cases: null or blank text has no set and links with nothing, its
component is its own id. With fewer words than a shingle, the whole sequence
is the one shingle. Repeated rows are one node; rows that share an id but not
the text are different nodes; a null id never names a component unless all its
ids are null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.common import KEY, keyed, pieces, stage_table
from rebuy.llm.components import connected

#: A shingle that this many documents have near the start of their order goes to the end of it.
COMMON = 32
#: Bits, a power of two, of the map that marks common shingles, and the most for that of the documents whose sets are needed.
COMMON_BITS, MOST_BITS = 2**24, 2**28
#: Entries of a list, or members of a home, in one block.
BLOCK = 1024
#: Entries of a list that are skipped together by position.
SKIP = 64
#: Lists longer than this are walked in blocks.
LONG = 64
#: Least members of a home. The nodes of smaller groups are compared as pairs.
GROUP = 32


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The hashes of the distinct shingles, sorted. Words are what blanks (0x20, 0x09-0x0D) part, after A-Z are lower-cased."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    count = len(words) - span + 1
    made = np.full(count, span, dtype=np.uint64)
    for i in range(span):
        made = _mixed(made, h[i : i + count])
    return np.unique(made.view(np.int64))


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("_text").cast(pa.binary()).to_pylist()


def _prefix_size(n: int, threshold: int) -> int:
    return n + (-threshold * n // 100) + 1


def _heads(width: int, threshold: int):
    """Size and name of each set, and the shingles that can come into its prefix, in the order of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, names, heads = [], [], []
            for text in _texts(batch):
                s = shingles(text, width)
                sizes.append(len(s))
                names.append(_name(s) if len(s) else None)
                heads.append(s[: _prefix_size(len(s), threshold) * 3 // 2] if len(s) else s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_h"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
                 pa.array(heads, pa.list_(pa.int64()))],
                ["_id", "_h", "n", "sid", "head"],
            )

    return run


def _name(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def _prefixes(width: int, threshold: int, common):
    """The prefixes in the final order: common shingles last, hashes in order within either part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, sizes, heads = [], [], []
            for text in _texts(batch):
                s = shingles(text, width)
                if len(s):
                    late = _marked(common.value, s)
                    names.append(_name(s))
                    sizes.append(len(s))
                    heads.append(np.concatenate([s[~late], s[late]])[: _prefix_size(len(s), threshold)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.int64()))],
                ["sid", "n", "prefix"],
            )

    return run


def _sets(width: int, wanted):
    """The whole sets of the documents whose key is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            batch = batch.filter(pa.array(_marked(wanted.value, batch.column("_key").to_numpy())))
            found = [shingles(text, width) for text in _texts(batch)]
            names = [_name(s) if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["sid", "s"]
            )

    return run


def _in_lists(shared):
    """The postings of the shingles that are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2048):
            prefix = batch.column("prefix")
            sizes = np.diff(prefix.offsets.to_numpy())  # of the slice
            tok = prefix.flatten().to_numpy()
            node = np.repeat(np.arange(batch.num_rows), sizes)
            pos = np.arange(len(tok)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = _marked(shared.value, tok)
            columns = [
                pa.array(tok[keep]),
                batch.column("sid").take(pa.array(node[keep])),
                batch.column("n").take(pa.array(node[keep])),
                pa.array(pos[keep].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["tok", "sid", "n", "pos"])

    return run


def _map_bits(count: int) -> int:
    """Bits of a map for so many values: a power of two, 16 a value or more, as far as the bound allows."""
    return min(MOST_BITS, max(2**16, 1 << (16 * count).bit_length()))


def _marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values & np.int64(len(bits) * 64 - 1)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits, a power of two; those that the low ends of the values (random longs) name are set."""
    at = values.select(F.col(values.columns[0]).bitwiseAND(F.lit(bits - 1).cast("long")).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63L AS int))")).alias("bits")
    )
    found = words.toArrow()  # at most bits / 64 rows
    made = np.zeros(bits // 64, dtype=np.uint64)
    made[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return made


def _blocks(count: Column, size: int = BLOCK) -> Column:
    return F.ceil(count / F.lit(size)).cast("int")


def _within_homes(threshold: int):
    """Links of the members of a home that aren't linked to its pivot, from the differences alone."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs: tuple[list, list] = ([], [])
        if left.num_rows and right.num_rows:
            home = left.column("home")[0].as_py()
            lx, rx = left.column("sid").to_numpy(), right.column("sid").to_numpy()
            ln, rn = left.column("n").to_numpy(), right.column("n").to_numpy()
            lm, rm = left.column("n_minus").to_numpy(), right.column("n_minus").to_numpy()
            base = ln[0] + lm[0] - left.column("n_plus").to_numpy()[0]
            shared = _shared(left.column("d"), right.column("d"))
            inter = base - lm[:, None] - rm[None, :] + shared
            link = 100 * inter >= threshold * (ln[:, None] + rn[None, :] - inter)
            link &= lx[:, None] != rx[None, :]
            tight = right.column("tight").to_numpy(zero_copy_only=False)
            for i in range(len(lx)):
                row = link[i]
                if (row & tight).any():
                    pairs[0].append(int(lx[i]))
                    pairs[1].append(home)
                loose = np.flatnonzero(row & ~tight & (rx < lx[i]))
                pairs[0].extend([int(lx[i])] * len(loose))
                pairs[1].extend(rx[loose].tolist())
        return pa.table([pa.array(c, pa.int64()) for c in pairs], ["u", "v"])

    return run


def _shared(left: pa.ChunkedArray, right: pa.ChunkedArray) -> np.ndarray:
    """For each pair of rows, how many values their arrays share."""

    def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
        rows = column.combine_chunks()
        lengths = np.diff(rows.offsets.to_numpy())
        return rows.flatten().to_numpy(), np.repeat(np.arange(len(rows)), lengths), len(rows)

    (a, ai, an), (b, bi, bn) = flat(left), flat(right)
    common = np.intersect1d(a, b)
    ka, kb = np.isin(a, common), np.isin(b, common)
    a, ai, b, bi = np.searchsorted(common, a[ka]), ai[ka], np.searchsorted(common, b[kb]), bi[kb]
    total = np.zeros((an, bn), dtype=np.float32)
    for start in range(0, len(common), 512):
        wide = min(512, len(common) - start)
        x, y = np.zeros((an, wide), dtype=np.float32), np.zeros((bn, wide), dtype=np.float32)
        pick = (a >= start) & (a < start + wide)
        x[ai[pick], a[pick] - start] = 1
        pick = (b >= start) & (b < start + wide)
        y[bi[pick], b[pick] - start] = 1
        total += x @ y.T
    return total.astype(np.int64)


def _across(threshold: int):
    """Pairs of a list, or of two of its blocks, that may link and lie in different homes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, low, high = (k.as_py() for k in key)
        got: tuple[list, list] = ([], [])
        order = np.argsort(table.column("n").to_numpy(), kind="stable")
        sid, n, left, home, block = (
            table.column(c).to_numpy()[order] for c in ("sid", "n", "remaining", "home", "block")
        )
        starts = np.arange(0, len(n), SKIP)
        most = np.maximum.reduceat(left, starts)
        # The most frequent home meets no entry of its own; the others look for partners.
        names, counts = np.unique(home, return_counts=True)
        major = names[counts.argmax()]
        for i in np.flatnonzero(home != major):
            first = np.searchsorted(n, -(-threshold * n[i] // 100), "left")
            past = np.searchsorted(n, 100 * n[i] // threshold, "right")
            for at in range(first - first % SKIP, past, SKIP):
                if most[at // SKIP] * (100 + threshold) < threshold * (n[i] + n[max(at, first)]):
                    continue
                j = np.arange(max(at, first), min(at + SKIP, past))
                need = threshold * (n[i] + n[j])
                ok = np.minimum(left[i], left[j]) * (100 + threshold) >= need
                ok &= home[j] != home[i]
                ok &= (home[j] == major) | (sid[j] < sid[i])
                if low != high:
                    ok &= block[j] != block[i]
                j = j[ok]
                got[0].extend(np.maximum(sid[i], sid[j]).tolist())
                got[1].extend(np.minimum(sid[i], sid[j]).tolist())
        return pa.table([pa.array(c, pa.int64()) for c in got], ["u", "v"])

    return run


class _Join:
    def __init__(self, docs: DataFrame, doc_id: str, text: str, width: int, threshold: int) -> None:
        self.width, self.threshold = width, threshold
        self.base = keyed(docs, doc_id=doc_id, text=text)
        kinds = dict(self.base.dtypes)
        self.rows = stage_table(
            self.base.mapInArrow(
                _heads(width, threshold), f"_id {kinds['_id']}, _h long, n long, sid long, head array<long>"
            ),
            "op2_rows",
        )

    def _marks(self, values: DataFrame, bits: int):
        return self.base.sparkSession.sparkContext.broadcast(_bitmap(values, bits))

    def _postings(self) -> DataFrame:
        """``tok, sid, n, pos, df, pivot`` of the nodes that meet another in a list, in the final order."""
        heads = self.rows.select(F.explode("head").alias("tok"))
        common = heads.groupBy("tok").agg(F.count("*").alias("df")).filter(F.col("df") >= COMMON).select("tok")
        made = self.base.select("_text").mapInArrow(
            _prefixes(self.width, self.threshold, self._marks(common, COMMON_BITS)),
            "sid long, n long, prefix array<long>",
        )
        nodes = made.groupBy("sid").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        nodes = stage_table(nodes, "op2_nodes")
        lists = nodes.select(F.explode("prefix").alias("tok")).groupBy("tok").agg(F.count("*").alias("df"))
        lists = stage_table(lists.filter("df > 1"), "op2_lists")
        # Most shingles head one node only; what the map lets through besides falls to the join.
        shared = self._marks(lists.select("tok"), _map_bits(lists.count()))
        kept = nodes.mapInArrow(_in_lists(shared), "tok long, sid long, n long, pos int")
        met = stage_table(kept.join(lists, "tok"), "op2_met")
        pivots = met.groupBy("tok").agg(F.min(F.struct(F.xxhash64("sid"), "sid")).alias("p"))
        return stage_table(met.join(pivots.select("tok", F.col("p.sid").alias("pivot")), "tok"), "op2_postings")

    def _load_sets(self, met: DataFrame) -> None:
        """``sid, s``: the whole set of each node in ``met``, from one document that has it."""
        key = F.xxhash64(*KEY)
        named = self.rows.filter("n > 0").groupBy("sid").agg(F.min(key).alias("_key")).join(met, "sid", "left_semi")
        named = stage_table(named, "op2_named")
        wanted = self._marks(named.select("_key"), _map_bits(named.count()))
        found = self.base.select(key.alias("_key"), "_text").mapInArrow(
            _sets(self.width, wanted), "sid long, s array<long>"
        )
        found = found.join(named, "sid", "left_semi").groupBy("sid").agg(F.first("s").alias("s"))
        self.sets = stage_table(found, "op2_sets")

    def _prefix(self, n: Column) -> Column:
        return n - F.ceil(n * F.lit(self.threshold) / 100) + 1

    def _chosen_homes(self, postings: DataFrame) -> DataFrame:
        """``home, sid, n``: for the nodes that share a list with a pivot which ``GROUP`` nodes have as the nearest.

        A node is close to a pivot if a quarter of its prefix is in lists of the pivot.
        """
        near = postings.filter("pivot <> sid").groupBy("sid", "n", F.col("pivot").alias("home")).agg(
            F.count("*").alias("shared")
        )
        near = stage_table(near.withColumn("close", 4 * F.col("shared") >= self._prefix(F.col("n"))), "op2_near")
        best = Window.partitionBy("sid").orderBy(F.desc("shared"), "home")
        first = near.filter("close").withColumn("place", F.row_number().over(best)).filter("place = 1")
        large = first.groupBy("home").agg(F.count("*").alias("members")).filter(F.col("members") >= GROUP)
        # Of the large groups that a node is close to, the largest: a group so hardly splits. A node that is close to
        # none is compared as a member of the one that it shares most lists with, not pair by pair through these lists.
        most = Window.partitionBy("sid").orderBy(
            F.desc("close"), F.when(F.col("close"), F.col("members")).desc_nulls_last(), F.desc("shared"), "home"
        )
        chosen = near.join(large, "home").withColumn("place", F.row_number().over(most)).filter("place = 1")
        return stage_table(chosen.select("home", "sid", "n"), "op2_chosen")

    def _homes(self, chosen: DataFrame) -> DataFrame:
        """``sid, home, n, n_minus, n_plus, d, tight``: the difference of each node from its pivot."""
        both = (
            chosen.join(self.sets, "sid")
            .join(self.sets.select(F.col("sid").alias("home"), F.col("s").alias("r")), "home")
            .select("sid", "home", "n", F.array_except("r", "s").alias("minus"), F.array_except("s", "r").alias("plus"))
            .withColumns({"n_minus": F.size("minus").cast("long"), "n_plus": F.size("plus").cast("long")})
        )
        inter, union = F.col("n") - F.col("n_plus"), F.col("n") + F.col("n_minus")
        tight = (100 * inter >= self.threshold * union).alias("tight")
        return stage_table(
            both.select("sid", "home", "n", "n_minus", "n_plus", F.concat("minus", "plus").alias("d"), tight), "op2_homes"
        )

    def _home_links(self, homes: DataFrame) -> DataFrame:
        size = homes.groupBy("home").agg(
            F.count("*").alias("members"), F.sum(F.when(F.col("tight"), 0).otherwise(1)).alias("loose")
        )
        size = size.filter("loose > 0").select(
            "home", _blocks(F.col("members")).alias("m_blocks"), _blocks(F.col("loose")).alias("l_blocks")
        )
        rows = homes.join(size, "home")
        own = F.xxhash64("sid")
        loose = (
            rows.filter(~F.col("tight"))
            .withColumn("lo", F.pmod(own, F.col("l_blocks")).cast("int"))
            .withColumn("hi", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1)))
        )
        members = rows.withColumn("hi", F.pmod(own, F.col("m_blocks")).cast("int")).withColumn(
            "lo", F.explode(F.sequence(F.lit(0), F.col("l_blocks") - 1))
        )
        keys = ["home", "lo", "hi"]
        return (
            loose.groupBy(*keys)
            .cogroup(members.toDF(*members.columns).groupBy(*keys))
            .applyInArrow(_within_homes(self.threshold), "u long, v long")
        )

    def _list_pairs(self, postings: DataFrame, chosen: DataFrame) -> DataFrame:
        """``u, v`` (u the greater): the pairs of different homes that are to be verified."""
        entries = postings.select("tok", "df", "sid", "n", (F.col("n") - F.col("pos")).alias("remaining"))
        entries = entries.join(chosen.select("sid", "home"), "sid", "left").withColumn("home", F.coalesce("home", "sid"))
        entries = stage_table(entries, "op2_entries")
        in_long = entries.filter(F.col("df") > LONG)
        split = in_long.groupBy("tok").agg(F.min("home").alias("a"), F.max("home").alias("b")).filter("a < b")
        blocked = in_long.join(split.select("tok"), "tok", "left_semi").withColumn("blocks", _blocks(F.col("df")))
        blocked = blocked.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        dealt = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "tok",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "sid",
            "n",
            "remaining",
            "home",
            "block",
        )
        walked = dealt.groupBy("tok", "low", "high").applyInArrow(_across(self.threshold), "u long, v long")

        t = self.threshold
        short = entries.filter(F.col("df") <= LONG)
        a, b = short.alias("a"), short.toDF(*short.columns).alias("b")
        sizes = F.col("a.n") + F.col("b.n")
        near = 100 * F.least("a.n", "b.n") >= t * F.greatest("a.n", "b.n")
        met = a.join(b, (F.col("a.tok") == F.col("b.tok")) & (F.col("a.sid") > F.col("b.sid")) & near)
        met = met.filter(F.col("a.home") != F.col("b.home"))
        leaves = F.least("a.remaining", "b.remaining") * (100 + t) >= t * sizes
        need = F.ceil(t * sizes / F.lit(100 + t)) + 1 - F.ceil(F.greatest("a.n", "b.n") * F.lit(t) / 100)
        counted = met.groupBy(F.col("a.sid").alias("u"), F.col("b.sid").alias("v"), need.alias("need")).agg(
            F.count("*").alias("shared"), F.max(leaves).alias("leaves")
        )
        # Shared shingles in long lists aren't counted here: as many as either set has in such lists may be shared.
        longs = in_long.groupBy("sid").agg(F.count("*").alias("longs"))
        counted = (
            counted.filter("leaves")
            .join(longs.withColumnsRenamed({"sid": "u", "longs": "lu"}), "u", "left")
            .join(longs.withColumnsRenamed({"sid": "v", "longs": "lv"}), "v", "left")
        )
        more = F.least(F.coalesce("lu", F.lit(0)), F.coalesce("lv", F.lit(0)))
        joined = counted.filter(F.col("shared") + more >= F.col("need")).select("u", "v")
        return stage_table(walked.unionAll(joined).distinct(), "op2_pairs")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        joined = pairs.join(self.sets.select(F.col("sid").alias("u"), F.col("s").alias("a")), "u").join(
            self.sets.select(F.col("sid").alias("v"), F.col("s").alias("b")), "v"
        )
        inter = F.size(F.array_intersect("a", "b"))
        linked = inter * (100 + self.threshold) >= self.threshold * (F.size("a") + F.size("b"))
        return joined.filter(linked).select("u", "v")

    def run(self) -> DataFrame:
        postings = self._postings()
        chosen = self._chosen_homes(postings)
        pairs = self._list_pairs(postings, chosen)
        met = chosen.select("sid").unionAll(chosen.select("home")).unionAll(pairs.select("u")).unionAll(pairs.select("v"))
        self._load_sets(met.distinct())
        homes = self._homes(chosen)
        tight = homes.filter("tight").select(F.col("sid").alias("u"), F.col("home").alias("v"))
        links = tight.unionAll(self._home_links(homes)).unionAll(self._verified(pairs))
        roots = connected(stage_table(links, "op2_links"))

        nodes = self.rows.filter("n > 0").groupBy("sid").agg(F.min("_id").alias("_id"), F.count("*").alias("rows"))
        named = nodes.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
            "root", F.coalesce("root", "sid")
        )
        least = named.groupBy("root").agg(F.min("_id").alias("component_id"))
        by_set = named.join(least, "root").select("sid", "root", "component_id")
        joined = self.rows.select("_id", "_h", "n", "sid").join(by_set, "sid", "left")
        return joined.select(
            "_id",
            "_h",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
            F.when(F.col("n") > 0, F.col("root")).alias("component"),
        )


def similar_sets(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, threshold: int = 90
) -> DataFrame:
    """One row per row of ``docs``: ``_id, _h, n_shingles, component_id, component``.

    ``component`` names the component also where ids repeat or are null; it is
    null for rows without words. ``width`` is the words of a shingle,
    ``threshold`` the least similarity in percent.
    """
    return _Join(docs, doc_id, text, width, threshold).run()
