"""Mixing sources to target weights by Pfair scheduling (native DataFrame operations only).

Documents of a source are put in a random but repeatable order and cut into
blocks of ``block_docs``. Time is counted in slots of one block. With weights
``p`` and ``q`` their sum, the j-th block of a source (from 0) is released at
``floor(j q / p)`` and due at ``ceil((j + 1) q / p)``. In each slot the earliest
deadline among the released blocks goes next. On one unit of capacity that
meets every deadline, so after any number of slots every source has given less
than one block more or less than its share.

The pattern repeats after ``q`` slots, so only one period is scheduled, with
``q`` at most about 200. When a source has no blocks left, a new *phase* begins
and the others go on by their own weights, again with less than one block of
deviation in the phase; so no document is dropped or repeated, and there are as
many phases as sources at most. Both are computed by one expression over arrays
of a number per source. A document's slot follows from its number in its source
by arithmetic, whatever the size of the data.

*The rest.* Targets are seldom whole percents. A source has a class of its own
with the whole percents of its target, and what is left of all targets (of a
source under one percent, all of it) makes up one more class, whose weight is
whole too. Each source gives that class the matching part of its blocks. Inside
it, the j-th block of a source with the exact weight w has the time
``(j + 1/2) / w``, and blocks go by time: a source is half a block from its
weight times the time at most, so no source loses its target, however many
there are. Times are ranked in two levels like documents.

Documents are numbered within a source in two levels: by hash ranges of about
``RUN`` documents, whose counts are summed, and by a window within a range. A
source with a third of all rows is so numbered in many tasks.

Given ``targets``, whole percents, sources not named share the rest as one class
by their sizes; without, a source weighs as the power ``temper`` of its document
count.

Defined cases: a null source is a source of its own. Rows that repeat id and
text are numbered one after the other. Sources whose target is 0 come last, in
a phase of their own. An empty table gives no rows. Other columns pass through
where they are asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.common import stage_table

BLOCK_DOCS = 32
RUN = 5_000
POOLED = "(others)"
#: Columns that are added; an input column of such a name gives way.
ADDED = ("mix_class", "mix_weight", "mix_block", "mix_slot", "mix_place")


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``value``, computed once, under ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _pattern(weights: str, period: str) -> str:
    """The source (its place in the array) of each slot of a period: earliest deadline first."""
    due = f"(g.done[i] * {period} + {period} + x - 1) DIV x"
    free = f"x > 0 AND g.done[i] < x AND (g.done[i] * {period}) DIV x <= t"
    first = f"array_min(transform({weights}, (x, i) -> IF({free}, struct({due} AS due, i AS i), NULL))).i"
    grown = "struct(transform(g.done, (d, i) -> IF(i = c, d + 1L, d)) AS done, concat(g.slots, array(c)) AS slots)"
    return (
        f"aggregate(sequence(0L, {period} - 1L), "
        f"struct(transform({weights}, x -> 0L) AS done, cast(array() AS array<int>) AS slots), "
        f"(g, t) -> {_let(first, 'c', grown)}, g -> g.slots)"
    )


def phases_expression(weights: str, blocks: str) -> str:
    """An array of phases from two arrays, weights and blocks of each source (bigint).

    A phase has ``start`` (its first slot), ``q``, and per source ``first`` (its
    first block of the phase), ``taken`` (its blocks in it) and ``places`` (its
    slots in a period).
    """
    live = f"zip_with({weights}, s.remaining, (w, l) -> IF(l > 0, w, 0L))"
    # Sources without weight go on once all others have ended.
    live = _let(live, "v", "IF(exists(v, x -> x > 0), v, transform(s.remaining, l -> IF(l > 0, 1L, 0L)))")
    places = "transform(w, (x, i) -> filter(sequence(0L, q - 1L), t -> e[cast(t AS int)] = i))"
    ends = (
        "transform(w, (x, i) -> IF(x > 0, "
        "((s.remaining[i] - 1) DIV x) * q + places[i][cast((s.remaining[i] - 1) % x AS int)] + 1L, NULL))"
    )
    taken = "transform(w, (x, i) -> IF(x > 0, (n DIV q) * x + cast(size(filter(places[i], t -> t < n % q)) AS bigint), 0L))"
    phase = "struct(s.start AS start, q AS q, s.used AS first, taken AS taken, w AS w, places AS places)"
    after = (
        "struct(zip_with(s.remaining, taken, (l, k) -> l - k) AS remaining, s.start + n AS start, "
        f"zip_with(s.used, taken, (u, k) -> u + k) AS used, concat(s.found, array({phase})) AS found)"
    )
    step = _let(taken, "taken", after)
    step = _let(f"array_min({ends})", "n", step)
    step = _let(places, "places", step)
    step = _let(_pattern("w", "q"), "e", step)
    step = _let("aggregate(w, 0L, (a, x) -> a + x)", "q", step)
    step = _let(live, "w", step)
    kind = (
        "array<struct<start: bigint, q: bigint, first: array<bigint>, taken: array<bigint>, w: array<bigint>, "
        "places: array<array<bigint>>>>"
    )
    begin = (
        f"struct({blocks} AS remaining, 0L AS start, transform({blocks}, x -> 0L) AS used, "
        f"cast(array() AS {kind}) AS found)"
    )
    rounds = f"sequence(1, size({blocks}))"
    return f"aggregate({rounds}, {begin}, (s, r) -> IF(exists(s.remaining, l -> l > 0), {step}, s), s -> s.found)"


def source_classes(counts: DataFrame, targets: dict[str, int] | None, temper: float, block_docs: int) -> DataFrame:
    """``_source, n, own, n_own, part, rest`` from ``_source, n``.

    ``own`` is the weight of the source's own class and ``n_own`` its documents
    there; the others belong to the class ``POOLED`` of weight ``rest``, in
    which the source weighs ``part``. At most about 100 sources have a class of
    their own, or those named by ``targets``.
    """
    if targets is not None:
        if any(w < 0 for w in targets.values()) or sum(targets.values()) > 100:
            raise ValueError("targets are percents: none below 0, 100 at most in all")
        named = F.create_map(*(F.lit(x) for pair in targets.items() for x in pair)) if targets else F.lit(None)
        weight = (named[F.col("_source")] if targets else named).cast("long")
        return counts.select(
            "_source", "n", F.coalesce(weight, F.lit(0)).cast("long").alias("own"),
            F.when(weight.isNotNull(), F.col("n")).otherwise(0).cast("long").alias("n_own"),
            F.col("n").cast("double").alias("part"), F.lit(max(0, 100 - sum(targets.values()))).cast("long").alias("rest"),
        )
    powered = counts.withColumn("power", F.pow(F.col("n").cast("double"), F.lit(temper)))
    total = powered.agg(F.sum("power")).first()[0] or 1.0
    share = powered.withColumn("share", 100 * F.col("power") / F.lit(total))
    # A share that is whole but for rounding is whole.
    near = F.abs(F.col("share") - F.round("share")) < 1e-9
    share = share.withColumn("share", F.when(near, F.round("share")).otherwise(F.col("share")))
    whole = F.when(F.col("_source") == POOLED, 0).otherwise(F.floor("share")).cast("long")
    share = share.withColumn("own", whole)
    rest = F.lit(100 - (share.agg(F.sum("own")).first()[0] or 0)).cast("long")
    blocks = F.ceil(F.col("n") * F.col("own") / F.col("share") / F.lit(block_docs))
    n_own = F.least(F.col("n"), blocks * F.lit(block_docs)).cast("long")
    return share.select("_source", "n", "own", n_own.alias("n_own"), (F.col("share") - F.col("own")).alias("part"), rest.alias("rest"))


def pooled_blocks(classes: DataFrame, block_docs: int) -> DataFrame:
    """``_source, _j, _rank``: the place among the blocks of the class ``POOLED`` of each block that a source has there."""
    given = classes.filter("n > n_own")
    total = given.agg(F.sum("part")).first()[0] or 1.0
    last = F.expr(f"(n - n_own - 1) DIV {block_docs}")
    # Of the class as a whole, about one block goes in a unit of time.
    times = given.select("_source", (F.col("part") / F.lit(total)).alias("w"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_j"))
    times = times.withColumn("_time", (F.col("_j") + 0.5) / F.col("w")).withColumn("_span", F.floor(F.col("_time") / RUN))
    in_span = times.groupBy("_span").agg(F.count("*").alias("n"))
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_span.select("_span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_span").orderBy("_time", F.xxhash64("_source"), "_source")
    ranked = times.withColumn("_in_span", F.row_number().over(within) - 1).join(offsets, "_span")
    return ranked.select("_source", "_j", (F.col("_before") + F.col("_in_span")).alias("_rank"))


def mixed(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    targets: dict[str, int] | None = None,
    temper: float = 0.5,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """The columns ``keep`` (all, by default) of every row with its place in the mix.

    ``mix_class, mix_weight, mix_block`` (the number of the block in its class),
    ``mix_slot`` and ``mix_place`` (in the block). The order of the mix is that
    of slot and place; slots have no gaps.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    own = docs[source].cast("string")
    base = docs.select(
        F.struct(*(docs[c] for c in columns)).alias("_row"),
        F.coalesce(own, F.lit("\0")).alias("_source"),
        F.xxhash64(docs[doc_id], docs[text].cast("string")).alias("_order"),
    )
    counts = stage_table(base.groupBy("_source").agg(F.count("*").alias("n")), "op3_sources")
    total = counts.agg(F.sum("n")).first()[0] or 0
    runs = max(1, -(-total // RUN))
    classes = stage_table(source_classes(counts, targets, temper, block_docs), "op3_classes")
    pooled = stage_table(pooled_blocks(classes, block_docs), "op3_pooled")

    # One row per class, at most about 100: small by the bound on classes or the given targets.
    sized = classes.filter("n_own > 0").select(
        F.col("_source").alias("class"), F.col("own").alias("weight"), F.ceil(F.col("n_own") / F.lit(block_docs)).cast("long").alias("blocks")
    )
    others = pooled.agg(F.count("*").alias("blocks")).filter("blocks > 0").crossJoin(classes.agg(F.max("rest").alias("weight")))
    sized = sized.unionAll(others.select(F.lit(POOLED).alias("class"), "weight", "blocks"))
    one = sized.agg(F.array_sort(F.collect_list(F.struct("class", "weight", "blocks"))).alias("c"))
    plan = one.select(
        F.col("c.class").alias("classes"), F.col("c.weight").alias("w0"), F.col("c.blocks").alias("b0")
    ).withColumn("phases", F.expr(phases_expression("w0", "b0")))
    of_class = plan.select(F.posexplode("classes").alias("i", "class"), "phases", "w0").select(
        "class",
        F.expr("w0[i]").alias("weight"),
        F.expr(
            "transform(phases, f -> struct(f.start AS start, f.q AS q, f.first[i] AS first, f.taken[i] AS taken, "
            "f.w[i] AS w, f.places[i] AS places))"
        ).alias("_phases"),
    )
    of_class = stage_table(of_class, "op3_plan")

    run = F.pmod(F.shiftright("_order", 20), F.lit(runs)).cast("long")
    tagged = base.join(classes.select("_source", "n_own"), "_source").withColumn("_run", run)
    in_run = tagged.groupBy("_source", "_run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("_source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_run.select("_source", "_run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_source", "_run").orderBy("_order")
    numbered = (
        tagged.withColumn("_in_run", F.row_number().over(within) - 1)
        .join(offsets, ["_source", "_run"])
        .withColumn("_n", F.col("_before") + F.col("_in_run"))
        # Blocks of a source's own class count down from -1, so that they match none of the others and spread in the join.
        .withColumn("_j", F.expr(f"IF(_n < n_own, -1L - _n DIV {block_docs}, (_n - n_own) DIV {block_docs})"))
        .join(pooled, ["_source", "_j"], "left")
        .withColumn("class", F.when(F.col("_j") < 0, F.col("_source")).otherwise(F.lit(POOLED)))
        .withColumn("_block", F.when(F.col("_j") < 0, -1 - F.col("_j")).otherwise(F.col("_rank")))
        .withColumn("_place", F.expr(f"cast(IF(_j < 0, _n, _n - n_own) % {block_docs} AS int)"))
    )
    placed = numbered.join(of_class, "class").withColumn("_f", F.expr(
        "filter(_phases, f -> _block >= f.first AND _block < f.first + f.taken)[0]"
    ))
    slot = "_f.start + ((_block - _f.first) DIV _f.w) * _f.q + _f.places[cast((_block - _f.first) % _f.w AS int)]"
    return placed.select(
        "_row.*",
        F.when(F.col("class") == "\0", F.lit(None)).otherwise(F.col("class")).alias("mix_class"),
        F.col("weight").alias("mix_weight"),
        F.col("_block").alias("mix_block"),
        F.expr(slot).alias("mix_slot"),
        F.col("_place").alias("mix_place"),
    )


def in_order(mix: DataFrame, partitions: int) -> DataFrame:
    """The mix spread over partitions by ranges of slots, each in order: written, the files read in order are the mix."""
    ranged = mix.repartitionByRange(partitions, F.col("mix_slot"), F.col("mix_place"))
    return ranged.sortWithinPartitions("mix_slot", "mix_place")
