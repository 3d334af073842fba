"""Mixing sources to target weights along a time-varying curriculum.

Every source has a share of the words to train on and a schedule: the density of its words over
training time t from 0 to 1 is target * (1 + slope * (2t - 1)). Its integral is the cumulative
demand D(t); a document that stands at cumulative word c of its source's stream is trained at
the position where D(t) = c. Documents are then sorted by range on that position.

A source's stream is its documents in hashed order, repeated while the target asks for more. A
document is taken whole, so the last pass takes those that end within the rest of the target.
Behind a document that is longer than the gap it would fill, further rounds take from the rest of
the stream the documents of half the gap at most that end within it; each round halves the gap or
leaves no such document. Then the one document that fills the gap best is taken, after which no
other fits. Cumulative words come from two levels, sums
of hash ranges and running sums inside a range, so no task holds a whole source.

Defined cases: a null text has size 0; a null source is a source and sorts last; a source of
size 0 has target 0; rows that repeat a doc_id, text and source are interchangeable: they follow each
other in the stream, the plan has a row for each, and `mix` deals these to them in the order of a hash
of the other columns; other columns, whatever their names, pass through `mix`; documents of one
position are sorted by doc_id and copy; sources of one fill level, by name; an empty table gives no
rows. Very long texts are only counted and hashed, in the JVM; one that is longer than the rest of its
source's target is left out of the last pass, which goes on behind it.

Equal rows are one row with a count until the end, and what each of them gets is reckoned from its
number among them. Only then are numbers dealt out, `DEAL` at a time over all tasks. The windows
without a partition are over sources, a row each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_SQL, free, partitions, table, text_or_empty, written

WEIGHTS = (5.0, 2.0, 1.0)
#: A source's density of words rises or falls along the training time by this much.
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
CAP = 2
ROWS_PER_RANGE = 4_000
LEAST_RANGES = 64
#: Equal rows that one task deals out at once.
DEAL = 1 << 16


def _cycle(rank: Column, values: tuple) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.pmod(rank - 1, F.lit(len(values))))


def source_targets(sized: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, n_rows, target, slope: one row per source.

    Water-filling: in the order of cap per weight, the sources whose share of what is left
    exceeds their cap stop there; the others divide the rest by weight.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", _cycle(F.col("rank"), WEIGHTS))
    ranked = ranked.withColumns({
        "most": F.col("source_size") * F.lit(float(cap)),
        "all": F.sum("source_size").over(whole) * F.lit(share),
    })
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("rank").asc())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("most"))
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    water = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least("most", water * F.col("weight")))
    return leveled.withColumn("target", target).withColumn("slope", _cycle(F.col("rank"), SLOPES)).select("source", "source_size", "n_rows", "target", "slope")


def _position(words: Column, target: Column, slope: Column) -> Column:
    """t where the cumulative demand, target * (t + slope * (t*t - t)), reaches `words`."""
    u = F.least(F.lit(1.0), words / target)
    root = F.sqrt(F.greatest(F.lit(0.0), (1 - slope) * (1 - slope) + 4 * slope * u))
    return F.when(u <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), 2 * u / (1 - slope + root)))


def _late(rows: DataFrame) -> DataFrame:
    """l_source, l_doc_id, l_h, l_size, l_words: what the last pass takes behind the first document
    that doesn't fit, and the words at which each is trained. rows: the streams.

    Of equal rows, those that don't fit are taken together.
    """
    key = ["source", "range", "h", "doc_id", "size"]
    held = F.when(F.col("n_within") > 0, F.col("end") - (F.col("n") - F.col("n_within")) * F.col("size"))
    gaps = rows.groupBy("source").agg((F.max("rest") - F.coalesce(F.max(held), F.lit(0))).alias("gap"), F.max("target").alias("target"))
    gaps = written(gaps, "gaps")
    outside = rows.where((F.col("n_within") < F.col("n")) & (F.col("passes") < CAP) & (F.col("size") > 0))
    outside = written(outside.select(*key, ((F.col("n") - F.col("n_within")) * F.col("size")).alias("total")), "outside")

    def to_fill(some: DataFrame) -> DataFrame:
        named = gaps.select(F.col("source").alias("g_source"), "gap", "target")
        return some.select(*key, "total").join(named, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")

    def without(some: DataFrame, gone: DataFrame) -> DataFrame:
        gone = gone.select(*[F.col(c).alias(f"x_{c}") for c in key])
        return some.join(gone, [F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in key], "left_anti")

    taken = None
    small = written(to_fill(outside).where("2 * total <= gap"), "small")
    while not small.isEmpty():
        before = Window.partitionBy("r_source").orderBy("r_range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = small.groupBy(F.col("source").alias("r_source"), F.col("range").alias("r_range")).agg(F.sum("total").alias("range_size"), F.max("gap").alias("range_gap"))
        ranges = ranges.withColumn("range_from", F.coalesce(F.sum("range_size").over(before), F.lit(0))).where("range_from < range_gap").select("r_source", "r_range", "range_from")
        inside = Window.partitionBy("source", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ahead = small.join(ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
        ended = ahead.withColumn("end", F.col("range_from") + F.sum("total").over(inside)).where("end <= gap")
        now = written(ended.select(*key, "total", (F.col("target") - F.col("gap") + F.col("end") - F.col("total") / 2).alias("words")), "late")
        filled = now.groupBy(F.col("source").alias("n_source")).agg(F.sum("total").alias("filled"))
        left = gaps.join(filled, F.col("source").eqNullSafe(F.col("n_source")), "left")
        gaps = written(left.select("source", (F.col("gap") - F.coalesce("filled", F.lit(0))).alias("gap"), "target"), "gaps")
        small = written(to_fill(without(small, now)).where("2 * total <= gap"), "small")
        taken = now if taken is None else taken.union(now)
    if taken is not None:
        outside = without(outside, taken)
    misses = F.abs(F.col("total") - F.col("gap"))
    best = F.min(F.struct(misses.alias("misses"), "h", "doc_id", "range", "size", "total", "target")).alias("best")
    fillers = to_fill(outside).where(misses < F.col("gap")).groupBy("source").agg(best)
    fillers = fillers.select("source", *[f"best.{c}" for c in (*key[1:], "total")], F.col("best.target").alias("words"))
    late = written(fillers if taken is None else fillers.union(taken), "late")
    return late.select(*[F.col(c).alias(f"l_{c}") for c in ("source", "doc_id", "h", "size", "words")])


def _hashed(seed: int) -> Column:
    return F.xxhash64("doc_id", text_or_empty(), F.lit(seed))


def _streams(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, h of every distinct document, how many rows are equal (n), how many of
    them the last pass reaches (n_within), where the last of them ends in its source's stream, its
    source's figures, and the words at which the other ones are trained besides, if they are."""
    size = F.regexp_count(text_or_empty(), F.lit(WORD_SQL)).cast("long").alias("size")
    one = docs.select("doc_id", F.col("source").cast("string").alias("source"), size, _hashed(seed).alias("h"))
    key = ["source", "doc_id", "size", "h"]
    sized = written(one.groupBy(*key).agg(F.count("*").alias("n")).withColumn("total", F.col("size") * F.col("n")), "sized")
    targets = written(source_targets(sized.select("source", F.col("total").alias("size"))), "targets")
    # As many hash ranges as the largest source needs; one number comes to the driver.
    ranges = max(LEAST_RANGES, -(-(targets.agg(F.max("n_rows")).first()[0] or 0) // ROWS_PER_RANGE))
    sized = sized.withColumn("range", _range("h", ranges))
    sums = sized.groupBy("source", "range").agg(F.sum("total").alias("range_size"))
    offset = F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("range_from", F.coalesce(offset, F.lit(0))).select(F.col("source").alias("s_source"), F.col("range").alias("s_range"), "range_from")
    inside = F.sum("total").over(Window.partitionBy("source", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = sized.withColumn("inside", inside)
    ended = running.join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range"))).withColumn("end", F.col("inside") + F.col("range_from"))
    named = targets.select(F.col("source").alias("t_source"), "source_size", "target", "slope")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = ended.join(named, F.col("source").eqNullSafe(F.col("t_source"))).withColumn("passes", F.least(F.lit(CAP), passes))
    rows = rows.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    room = F.floor("rest").cast("long") - (F.col("end") - F.col("total"))  # words end at whole numbers
    reached = F.when(F.col("size") > 0, F.least("n", F.greatest(F.lit(0), F.call_function("div", room, F.col("size"))))).otherwise(F.when(room >= 0, F.col("n")).otherwise(0))
    rows = rows.withColumn("n_within", reached)
    rows = written(rows.select(*key, "n", "n_within", "source_size", "target", "slope", "passes", "rest", "end", "range"), "streams")
    more = _late(rows)
    same = [rows[c].eqNullSafe(more[f"l_{c}"]) for c in key]
    rows = rows.join(more, [*same, rows["n_within"] < rows["n"], rows["passes"] < CAP], "left")
    return rows.select(*key, "n", "n_within", "source_size", "target", "slope", "passes", "end", "l_words")


def _range(hashed: str, ranges: int) -> Column:
    """The top 31 bits of the hash, as a fraction of their range, times the number of ranges."""
    return F.floor((F.shiftright(hashed, 33) + F.lit(1 << 30)) * F.lit(ranges) / F.lit(1 << 31)).cast("int")


def _dealt(df: DataFrame, first: Column, last: Column, k: str) -> DataFrame:
    """`df`, whose rows come once for each number from `first` to `last`, in column `k`. Where these
    are many, all tasks deal them out."""
    block, span = f"{k}_block", last - first
    most = df.agg(F.max(span)).first()[0] or 0
    if most < DEAL:
        return df.withColumn(k, F.explode(F.sequence(first, last)))
    blocks = df.withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", span, F.lit(DEAL)))))
    # By round robin; a row's numbers depend on the row alone, so it may be sent anywhere.
    blocks = blocks.repartition(partitions(df.sparkSession))
    return blocks.withColumn(k, F.explode(F.sequence(first + F.col(block) * DEAL, F.least(last, first + F.col(block) * DEAL + (DEAL - 1))))).drop(block)


def _taken(of: Callable[[str], Column], k: Column) -> dict[str, Column]:
    """copies, middle, words of the first and the last copy of the k-th of equal rows. of: the
    columns of `_streams`."""
    within = k <= of("n_within")
    fills = ~within & of("l_words").isNotNull()
    middle = of("end") - (of("n") - k) * of("size") - of("size") / 2
    final = middle + of("source_size") * (of("passes") - 1 + within.cast("long"))
    return {
        "copies": of("passes") + within.cast("long") + fills.cast("long"),
        "middle": middle,
        "first_words": F.when(of("passes") + within.cast("long") > 0, middle).when(fills, of("l_words")),
        "last_words": F.when(fills, of("l_words")).when(within | (of("passes") > 0), final),
    }


def plan(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, position (of the first copy) and
    last_position of every row."""
    rows = _dealt(written(_streams(docs, seed), "plan"), F.lit(1).cast("long"), F.col("n"), "k")
    got = _taken(F.col, F.col("k"))
    at = lambda words: F.when(words.isNotNull(), _position(words, F.greatest(F.col("target"), F.lit(1.0)), F.col("slope")))
    return rows.select("doc_id", "source", "size", "source_size", "target", got["copies"].alias("copies"), at(got["first_words"]).alias("position"), at(got["last_words"]).alias("last_position"))


#: What a row and its plan have in common.
KEY = ["doc_id", "source", "h"]


def _matched(docs: DataFrame, planned: DataFrame, seed: int, m: str) -> DataFrame:
    """`docs` with a struct `m` of the plan and the row's number among equal ones."""
    own = {"doc_id": F.col("doc_id"), "source": F.col("source").cast("string"), "h": _hashed(seed)}
    same = F.lit(True)
    for c in KEY:
        same = same & own[c].eqNullSafe(F.col(f"{m}_{c}"))
    k, columns = f"{m}_k", [F.col(f"`{c}`") for c in docs.columns]
    named = planned.select(*[F.col(c).alias(f"{m}_{c}") for c in KEY], F.struct(*planned.columns).alias(m))
    out = docs.join(named.where(F.col(m)["n"] == 1), same).select(*columns, m, F.lit(1).cast("long").alias(k))
    again = written(named.where(F.col(m)["n"] > 1), "again")
    if again.isEmpty():
        return out
    # Rows that are equal in all columns are one with a count. What differs is numbered in the order
    # of a hash, by ranges of it: a table of hashes and counts, without the rows themselves.
    r, c, at, row, part = (f"{m}_{x}" for x in ("r", "c", "from", "row", "part"))
    rows = docs.join(again, same).withColumn(r, F.xxhash64(F.to_json(F.struct(*columns))))
    unlike = [f"{m}_{x}" for x in KEY] + [r]
    rows = written(rows.groupBy(*unlike).agg(F.count("*").alias(c), F.first(F.struct(*columns)).alias(row), F.first(m).alias(m)), "unlike")
    counts = rows.select(*unlike, c).withColumn(part, _range(r, LEAST_RANGES))
    by_key = Window.partitionBy(*unlike[:-1])
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy(*unlike[:-1], part).agg(F.sum(c).alias("sum"))
    sums = sums.withColumn("sum", F.coalesce(F.sum("sum").over(before(by_key.orderBy(part))), F.lit(0)))
    sums = sums.select(*[F.col(x).alias(f"{x}_s") for x in (*unlike[:-1], part)], "sum")
    inside = F.coalesce(F.sum(c).over(before(Window.partitionBy(*unlike[:-1], part).orderBy(r))), F.lit(0))
    on = F.lit(True)
    for x in (*unlike[:-1], part):
        on = on & F.col(x).eqNullSafe(F.col(f"{x}_s"))
    starts = counts.withColumn("inside", inside).join(sums, on).select(*[F.col(x).alias(f"{x}_t") for x in unlike], (F.col("sum") + F.col("inside")).alias(at))
    on = F.lit(True)
    for x in unlike:
        on = on & F.col(x).eqNullSafe(F.col(f"{x}_t"))
    dealt = _dealt(written(rows.join(starts, on).select(row, m, c, at), "starts"), F.col(at) + 1, F.col(at) + F.col(c), k)
    return out.union(dealt.select(*[F.col(row)[x].alias(x) for x in docs.columns], m, k))


def mix(docs: DataFrame, seed: int = 1, position: str | None = None) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, sorted by training position, which a
    column named `position` holds if asked for (in place of one that `docs` may have)."""
    m = free(docs.columns, "__m")
    copy, place, of = f"{m}_copy", f"{m}_at", lambda c: F.col(m)[c]
    got = _taken(of, F.col(f"{m}_k"))
    taken = _matched(docs, written(_streams(docs, seed), "plan"), seed, m).where(got["copies"] > 0)
    taken = taken.withColumn(copy, F.explode(F.sequence(F.lit(0), (got["copies"] - 1).cast("int"))))
    words = F.when(F.col(copy) == got["copies"] - 1, got["last_words"]).otherwise(got["middle"] + F.col(copy) * of("source_size"))
    at = _position(F.least(of("target"), words), F.greatest(of("target"), F.lit(1.0)), of("slope"))
    told = [F.col(place).alias(position)] if position else []
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() != (position or "").lower()]
    return taken.withColumn(place, at).orderBy(place, "doc_id", copy).select(*own, *told)


def query(spark, sf_dir: str) -> DataFrame:
    rows = plan(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "copies", "position", "last_position", "source").orderBy("position", "doc_id")
