"""Mixing sources to target weights: a proportionate-fair (Pfair) schedule of source blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlens.llm.common import packed_columns, stored

#: Blocks that are broadcast at most; more are joined by a shuffle.
BROADCAST_BLOCKS = 250_000
#: Slots of a period that are scheduled in one go, and those that one array takes up singly.
SPAN, STEP = 1_000_000, 1_000
#: Documents of a source, and slots, that are numbered together.
_RUN_ROWS, _RUN_SLOTS = 1_024, 8_192


def root_weights(documents: DataFrame, period: int = 1_000, power: float = 0.5) -> DataFrame:
    """(source, weight int) with weights in proportion to the documents of a source to the power,
    by largest remainders; a source due less than 1 gets 1, and the others share what is left. They
    sum to the least multiple of `period` that has ten parts a source. A null source is the empty one."""
    sizes = documents.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("size")
    )
    everything = W.partitionBy(F.lit(1))
    downwards = everything.orderBy(F.col("size").desc(), "source").rowsBetween(W.unboundedPreceding, W.currentRow)
    n = F.count(F.lit(1)).over(everything)
    ranked = sizes.select(
        "source",
        "size",
        (n - F.count(F.lit(1)).over(downwards)).alias("smaller"),
        F.sum("size").over(downwards).alias("from_here"),
        (F.ceil(n * 10 / period) * period).alias("total"),
    )
    # Were all smaller ones given 1, would this one be due 1 at least?
    free = ranked.withColumn("free", (F.col("total") - F.col("smaller")) * F.col("size") >= F.col("from_here"))
    spare = F.col("total") - F.count_if(~F.col("free")).over(everything)
    due = spare * F.col("size") / F.sum(F.when(F.col("free"), F.col("size"))).over(everything)
    parts = free.select("source", "free", "total", F.when(F.col("free"), due).otherwise(1.0).alias("share"))
    left = F.col("total") - F.sum(F.floor("share")).over(everything)
    by_rest = everything.orderBy(F.col("free").desc(), (F.col("share") - F.floor("share")).desc(), "source")
    extra = (F.row_number().over(by_rest) <= left).cast("int")
    return parts.select("source", (F.floor("share") + extra).cast("int").alias("weight"))


def pfair_period(weights: DataFrame) -> DataFrame:
    """The schedule of one period for weights (source, weight int, ...): one row (slot int, source,
    nth int, weight int, period int, taken array<int>, all array of the rows of weights by source)
    per slot; nth counts the source's slots from 0, taken is what each source has had before.

    The period is the sum of the weights. Job k of a source of weight w may run from floor(k /
    share), its release, and must by ceil((k + 1) / share), its deadline; each slot goes to the
    released job of the earliest deadline, of the first source by name in a tie. As shares sum to
    one, all deadlines are met, so before any slot t each source has had within one slot of t times
    its share, and after a period exactly its weight.

    taken and all have an entry per source in each slot: for few sources. pfair_slots gives the same
    schedule without them."""
    others = [c for c in weights.columns if c not in ("source", "weight")]
    one = weights.filter("weight > 0").agg(
        F.array_sort(F.collect_list(F.struct("source", "weight", *others))).alias("all"),
        F.sum("weight").cast("int").alias("period"),
    )
    job = """
        array_min(filter(
          transform(state.taken, (k, i) -> named_struct(
            'deadline', (k * CAST(period AS BIGINT) + period + all[i].weight - 1) div all[i].weight,
            'i', i,
            'release', (k * CAST(period AS BIGINT)) div all[i].weight)),
          job -> job.release <= t)).i
    """
    slots = f"""
        aggregate(
          sequence(0, period - 1),
          named_struct(
            'taken', transform(all, w -> 0),
            'slots', CAST(array() AS ARRAY<STRUCT<i: INT, nth: INT, taken: ARRAY<INT>>>)),
          (state, t) -> transform(array({job}), i -> named_struct(
            'taken', transform(state.taken, (k, j) -> IF(j = i, k + 1, k)),
            'slots', array_append(
              state.slots, named_struct('i', i, 'nth', state.taken[i], 'taken', state.taken))))[0],
          state -> state.slots)
    """
    rows = one.filter("period > 0").select("period", "all", F.posexplode(F.expr(slots)).alias("slot", "at"))
    return rows.select(
        "slot",
        F.expr("all[at.i].source").alias("source"),
        F.col("at.nth").alias("nth"),
        F.expr("all[at.i].weight").alias("weight"),
        "period",
        F.col("at.taken").alias("taken"),
        "all",
    )


def pfair_slots(weights: DataFrame) -> DataFrame:
    """The schedule of pfair_period for any number of sources: one row (source, nth long, slot long,
    period long) per slot.

    Sources of one weight have the same releases and deadlines and take turns by name, so one count
    per weight is the state, and a period has at most the root of twice its slots of different
    weights. Slots follow from those before them: spans of them are scheduled one after the other,
    each by one task, and stored."""
    by_name = W.partitionBy(F.lit(1)).orderBy("source")
    ranked = weights.filter("weight > 0").select("source", "weight", F.row_number().over(by_name).alias("rank"))
    ranked = stored(ranked, "ranked")
    classes = ranked.groupBy("weight").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    one = classes.agg(
        F.array_sort(F.collect_list(F.struct("weight", "ranks"))).alias("all"),
        F.sum(F.col("weight").cast("long") * F.size("ranks")).alias("period"),
    )
    state = stored(one.filter("period > 0").withColumn("taken", F.expr("transform(all, x -> 0L)")), "turns")
    period = (state.select("period").first() or [0])[0]
    job = """
        array_min(filter(
          transform(s.taken, (c, i) -> named_struct(
            'deadline', ((c div size(all[i].ranks) + 1) * period + all[i].weight - 1) div all[i].weight,
            'rank', all[i].ranks[CAST(c % size(all[i].ranks) AS INT)],
            'i', i,
            'release', (c div size(all[i].ranks)) * period div all[i].weight)),
          job -> job.release <= t))
    """
    made = "ARRAY<STRUCT<slot: BIGINT, rank: INT, nth: BIGINT>>"
    few = f"""
        aggregate(
          sequence(first, least(first + {STEP}, until) - 1),
          named_struct('taken', state.taken, 'slots', CAST(array() AS {made})),
          (s, t) -> transform(array({job}), job -> named_struct(
            'taken', transform(s.taken, (c, j) -> IF(j = job.i, c + 1, c)),
            'slots', array_append(s.slots, named_struct(
              'slot', t, 'rank', job.rank, 'nth', s.taken[job.i] div size(all[job.i].ranks)))))[0])
    """
    span = f"""
        aggregate(
          sequence(start, until - 1, {STEP}L),
          named_struct('taken', taken, 'steps', CAST(array() AS ARRAY<{made}>)),
          (state, first) -> transform(array({few}), x -> named_struct(
            'taken', x.taken, 'steps', array_append(state.steps, x.slots)))[0])
    """
    spans = []
    for start in range(0, period, SPAN):
        bounds = state.withColumn("start", F.lit(start).cast("long")).withColumn("until", F.lit(min(start + SPAN, period)).cast("long"))
        done = stored(bounds.select("all", "period", F.expr(span).alias("span")), "span")
        state = done.select("all", "period", F.col("span.taken").alias("taken"))
        spans.append(done.select("period", F.explode("span.steps").alias("step")).select("period", F.inline("step")))
    slots = reduce(DataFrame.union, spans) if spans else state.selectExpr("period", "0L AS slot", "0 AS rank", "0L AS nth")
    return slots.join(ranked.select("rank", "source"), "rank").select("source", "nth", "slot", "period")


def mix_sources(documents: DataFrame, weights: DataFrame | None = None, block_rows: int = 64) -> DataFrame:
    """Every row of documents (doc_id, source, ...) with its place in the mix: source (a null one
    as the empty text), block long, place int, slot long, position long, release and deadline long,
    in_balance boolean. Other columns pass through; columns of these names are replaced.

    The documents of a source, in the order of the MD5 of their ids, form blocks of `block_rows`;
    block k is job k of the source in the endless repetition of pfair_slots(weights), weights
    being (source, weight int) or root_weights(documents). Reading by position, each source is
    within one block of its target share at every slot before the first at which a source has run
    out; in_balance marks those. Later slots of sources that have run out are skipped. No document
    is lost or repeated; a source without weight is an error. An empty table gives no rows. Rows of
    one doc_id follow each other.

    Numbering is done in runs of some thousand rows, whose starts are summed, so that a source that
    holds most documents is spread over the cluster; nothing is sorted as a whole."""
    made = ("block", "place", "slot", "position", "release", "deadline", "in_balance")
    others = [c for c in documents.columns if c not in (*made, "doc_id", "source")]
    row = packed_columns(documents, (*made, "doc_id", "source"))
    frame = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), *([row] if others else []))
    weights = root_weights(frame) if weights is None else weights
    sizes = frame.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    weighted = sizes.join(weights.filter("weight > 0").select("source", "weight"), "source", "full")
    weighted = stored(weighted.select("source", F.coalesce("rows", F.lit(0)).alias("rows"), "weight"), "weights")
    without, n_rows, n_blocks = weighted.agg(
        F.count_if(F.col("weight").isNull()),
        F.coalesce(F.sum("rows"), F.lit(0)),
        F.coalesce(F.sum(F.ceil(F.col("rows") / block_rows)), F.lit(0)),
    ).first()
    if without:
        raise ValueError(f"{without} sources have no weight")

    runs = max(1, n_rows // _RUN_ROWS)
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    top = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long")
    spread = frame.withColumn("_digest", digest).withColumn("_run", F.shiftright(top * F.lit(runs), 32))
    starts = spread.groupBy("source", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("source").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select("source", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy("source", "_run").orderBy("_digest", "doc_id")
    numbered = spread.withColumn("_nth", F.row_number().over(within) - 1).join(starts, ["source", "_run"])
    nth = F.col("_start") + F.col("_nth")
    blocks = numbered.withColumn("block", F.floor(nth / block_rows)).withColumn(
        "place", F.pmod(nth, F.lit(block_rows)).cast("int")
    )

    timed = blocks.drop("_nth").join(_placed(weighted, block_rows, n_blocks), ["source", "block"])
    return timed.select(
        *["_row." + f"`{c}`" if c in others else c for c in documents.columns if c not in made],
        "block",
        "place",
        F.col("_at").alias("slot"),
        (F.col("_before") + F.col("place")).alias("position"),
        F.col("_release").alias("release"),
        F.col("_deadline").alias("deadline"),
        F.col("_balanced").alias("in_balance"),
    )


def _placed(weighted: DataFrame, block_rows: int, n_blocks: int) -> DataFrame:
    """(source, block, _at long the slot, _before long the documents in earlier slots, _release and
    _deadline long, _balanced boolean) of every block of the sources (source, rows, weight)."""
    blocks = weighted.filter("rows > 0").select(
        "source", "rows", F.col("weight").cast("long").alias("weight"),
        F.explode(F.expr(f"sequence(0L, (rows + {block_rows - 1}) div {block_rows})")).alias("block"),
    )
    slots = pfair_slots(weighted)
    # The last of each source is the first block that it does not have: without rows, out of balance.
    found = blocks.withColumn("nth", F.expr("block % weight")).join(slots, ["source", "nth"]).select(
        "source",
        "block",
        F.expr("block div weight * period + slot").alias("_at"),
        F.expr(f"least({block_rows}L, rows - {block_rows} * block)").alias("_rows"),
        F.expr("block * period div weight").alias("_release"),
        F.expr("((block + 1) * period + weight - 1) div weight").alias("_deadline"),
    )
    found = stored(found.withColumn("_run", F.expr(f"_at div {_RUN_SLOTS}")), "blocks")
    horizon = found.filter("_rows <= 0").agg(F.min("_at")).first()[0] or 0
    found = found.filter("_rows > 0")
    earlier = W.orderBy("_run").partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, -1)
    starts = found.groupBy("_run").agg(F.sum("_rows").alias("_n"))
    starts = starts.select("_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = W.partitionBy("_run").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    placed = found.withColumn("_within", F.coalesce(F.sum("_rows").over(within), F.lit(0))).join(starts, "_run").select(
        "source", "block", "_at", (F.col("_start") + F.col("_within")).alias("_before"),
        "_release", "_deadline", (F.col("_at") < horizon).alias("_balanced"),
    )
    return F.broadcast(placed) if n_blocks <= BROADCAST_BLOCKS else placed.hint("merge")
