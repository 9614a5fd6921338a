"""Interval joins by bins, islands, sweeps and top rows by key, all as plain joins, windows and aggregates.

Windows run within tiles of a contig; only one summary row for each tile meets over a whole contig, so a long
contig is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import distance, overlap

#: Bins of short intervals, the length from which an interval is long, bins of pairs with a long one, tiles of windows.
BIN, LONG, WIDE_BIN, TILE = 512, 1 << 12, 1 << 16, 1 << 16
#: Rows of one side in a bin beyond which the bin is split, and split bins up to which their list is broadcast.
SPLIT, BROADCAST_BINS = 1 << 14, 1 << 17


def _binned(df: DataFrame, start: str, end: str, bin_bp: int, pad: int) -> DataFrame:
    low, high = F.floor(F.greatest(F.lit(0), F.col(start) - pad) / bin_bp), F.floor((F.col(end) + pad - 1) / bin_bp)
    return df.withColumn("_first", low).withColumn("_bin", F.explode(F.sequence(low, F.greatest(low, high))))


def interval_join(
    a: DataFrame, b: DataFrame, a_span: tuple[str, str, str], b_span: tuple[str, str, str], within: int = 0, bin_bp: int = BIN, long_bp: int = LONG, wide_bp: int = WIDE_BIN, split: int = SPLIT, spans: DataFrame | None = None
) -> DataFrame:
    """Pairs of rows on one contig that overlap, or with `within` lie at most so far apart.

    Spans are (contig, start, end) column names, half-open; the two tables' columns differ but for the contig's.
    Both sides are dealt to bins and joined on (contig, kind, bin), where the kind tells which of both intervals
    is long: pairs of short ones meet in bins of bin_bp, others in bins of wide_bp, so that a long interval is
    few rows. A pair that shares several bins is taken in the first.

    A first pass over both sides' spans alone counts the rows of each bin. Kinds that one side has no intervals for are
    left out, and a bin with more than `split` rows of a side is a grid of cells: each side is dealt to parts of about so
    many rows, and goes to every part of the other, so a place that any number of rows cover is many tasks' work. `spans`
    has a's spans where a itself takes long to make. Adds overlap_bp and distance_bp.
    """
    ac, a0, a1 = a_span
    bc, b0, b1 = b_span
    # intervals that only just come within reach share no base: one more on either side
    pad = within + 1 if within else 0

    def reach(span: tuple[str, str, str], pad: int) -> dict[str, Column]:
        """First and last bin of both sizes, and whether the interval is long."""
        low, high = F.greatest(F.lit(0), F.col(span[1]) - pad), F.col(span[2]) + pad - 1
        ends = {f"_{end}{size}": F.floor(at / size) for size in (bin_bp, wide_bp) for end, at in (("low", low), ("high", high))}
        return ends | {"_long": F.col(span[2]) - F.col(span[1]) + 2 * pad > long_bp}

    def bins(side: int, r: dict[str, Column], kinds: list[int]) -> Column:
        """(kind, first bin, bin) of an interval; of a kind's two bits the higher says that a's interval is long."""
        own = 1 - side

        def of(kind: int) -> Column:
            size = wide_bp if kind else bin_bp
            first = r[f"_low{size}"]
            return F.transform(F.sequence(first, F.greatest(first, r[f"_high{size}"])), lambda i: F.struct(F.lit(kind).alias("kind"), first.alias("first"), i.alias("bin")))

        def ways(long: int) -> Column:
            wanted = [of(k) for k in kinds if k >> own & 1 == long]
            return F.concat(*wanted) if wanted else F.array().cast("array<struct<kind:int,first:bigint,bin:bigint>>")

        return F.when(r["_long"], ways(1)).otherwise(ways(0))

    def counted(kinds: list[int]) -> DataFrame:
        """Rows of both sides in each bin. Rows that reach over the same bins are counted first, then dealt to them."""
        sides = []
        for side, df, span, p in ((0, a if spans is None else spans, a_span, pad), (1, b, b_span, 0)):
            r = reach(span, p)
            alike = df.select(F.col(span[0]).alias("_contig"), *[c.alias(n) for n, c in r.items()]).groupBy("_contig", *r).count()
            sides.append(alike.select("_contig", F.explode(bins(side, {n: F.col(n) for n in r}, kinds)).alias("w"), *[(F.col("count") if side == x else F.lit(0)).alias(f"n{o}") for x, o in enumerate("ab")]))
        both = sides[0].unionByName(sides[1]).groupBy("_contig", F.col("w.kind").alias("_kind"), F.col("w.bin").alias("_bin"))
        return both.agg(F.sum("na").alias("na"), F.sum("nb").alias("nb")).filter("na > 0 AND nb > 0")

    counts = counted([0, 1, 2, 3])
    crowded = (F.col("na") > split) | (F.col("nb") > split)
    met = counts.groupBy("_kind").agg(F.count_if(crowded).alias("n")).collect()
    kinds, split_bins = sorted(r["_kind"] for r in met) or [0], sum(r["n"] for r in met)
    cells = None
    if split_bins:
        parts = lambda n: F.ceil(F.col(n) / F.lit(split)).cast("int")
        cells = counted(kinds).filter(crowded).select(F.col("_contig").alias("_cc"), F.col("_kind").alias("_ck"), F.col("_bin").alias("_cb"), parts("na").alias("_pa"), parts("nb").alias("_pb"))
        cells = F.broadcast(cells) if split_bins <= BROADCAST_BINS else cells

    def dealt(df: DataFrame, span: tuple[str, str, str], pad: int, side: int) -> DataFrame:
        """df by bins, and where a bin is split by cells."""
        own, contig = "ab"[side], span[0]
        r = reach(span, pad)
        if len(kinds) == 1:  # plain columns
            size = wide_bp if kinds[0] else bin_bp
            low, high = r[f"_low{size}"], r[f"_high{size}"]
            fits = df.filter(r["_long"] if kinds[0] >> (1 - side) & 1 else ~r["_long"])
            found = fits.withColumns({f"_k{own}": F.lit(kinds[0]), f"_f{own}": low, f"_b{own}": F.explode(F.sequence(low, F.greatest(low, high)))})
        else:
            found = df.withColumn("_w", F.explode(bins(side, r, kinds)))
            found = found.withColumns({f"_k{own}": F.col("_w.kind"), f"_f{own}": F.col("_w.first"), f"_b{own}": F.col("_w.bin")}).drop("_w")
        if cells is None:
            return found
        met = found.join(cells, (F.col(contig) == F.col("_cc")) & (F.col(f"_k{own}") == F.col("_ck")) & (F.col(f"_b{own}") == F.col("_cb")), "left")
        mine, others = (F.coalesce(c, F.lit(1)) for c in (("_pa", "_pb") if side == 0 else ("_pb", "_pa")))
        met = met.withColumns({f"_i{own}": F.pmod(F.xxhash64(*df.columns), mine).cast("int"), f"_j{own}": F.explode(F.sequence(F.lit(0), others - 1))})
        return met.drop("_cc", "_ck", "_cb", "_pa", "_pb")

    left = dealt(a, a_span, pad, 0)
    right = dealt(b.withColumnRenamed(bc, "_contig"), ("_contig", b0, b1), 0, 1)
    ends = [F.col(c) for c in (a0, a1, b0, b1)]
    near = (distance(*ends) <= within) if within else (overlap(*ends) > 0)
    keys = (F.col(ac) == F.col("_contig")) & (F.col("_ka") == F.col("_kb")) & (F.col("_ba") == F.col("_bb"))
    if cells is not None:
        keys = keys & (F.col("_ia") == F.col("_jb")) & (F.col("_ja") == F.col("_ib"))
    joined = left.join(right, keys & (F.col("_ba") == F.greatest("_fa", "_fb")) & near)
    return joined.withColumns({"overlap_bp": overlap(*ends), "distance_bp": distance(*ends)}).drop("_contig", *[f"_{x}{own}" for x in "kfbij" for own in "ab"])


def met_once(
    a: DataFrame, keys: list[str], b: DataFrame, a_span: tuple[str, str, str], b_span: tuple[str, str, str], within: int = 0, fields: tuple[str, ...] = ()
) -> DataFrame:
    """Each row of b with each group of a, the rows alike in keys, of which any interval meets it: one row, no shuffle of pairs.

    The row has the keys, columns of b, and span and fields of the first of the group's intervals that meets, with its
    overlap_bp and distance_bp; `_rest` is the array of the others that meet, with their spans and fields, null if there
    are none. Intervals of a group are put in the order of their starts before the join: any before this one starts as
    near to b's end, so that the greatest of their ends tells whether one of them met already.
    """
    ac, a0, a1 = a_span
    bc, b0, b1 = b_span
    longest = b.agg(F.max(F.col(b1) - F.col(b0))).first()[0]
    reach = 2 * within + max(longest or 0, 0)
    valid = a.dropna(subset=list(a_span)) if within else a.filter(F.col(a0) < F.col(a1)).dropna(subset=[ac])
    groups = valid.groupBy(*keys, ac).agg(F.sort_array(F.collect_list(F.struct(a0, a1, *fields))).alias("_all"))
    rows = groups.select("*", F.posexplode("_all").alias("_i", "_m")).select("*", "_m.*")
    later = F.filter(F.slice("_all", F.col("_i") + 2, F.size("_all")), lambda x: x[a0] - F.col(a1) <= reach)
    before = F.array_max(F.transform(F.slice("_all", F.lit(1), F.col("_i")), lambda x: x[a1]))
    members = rows.select(*keys, ac, a0, a1, *fields, before.alias("_past"), F.get("_all", F.col("_i") + 1)[a0].alias("_next"), later.alias("_later"))
    joined = interval_join(members, b, a_span, b_span, within=within, spans=valid)
    past, following = (F.col(b0) - F.col("_past"), F.col("_next") - F.col(b1))
    first = F.col("_past").isNull() | (past > within if within else past >= 0)
    more = following <= within if within else following < 0
    meets = lambda x: (distance(x[a0], x[a1], F.col(b0), F.col(b1)) <= within) if within else (overlap(x[a0], x[a1], F.col(b0), F.col(b1)) > 0)
    # nearly always there is one other at most, which plain columns tell
    single, far = F.size("_later") == 1, F.col(b0) - F.get("_later", F.lit(0))[a1]
    rest = F.when(~F.coalesce(more, F.lit(False)), None).when(single, F.when(far <= within if within else far < 0, F.col("_later"))).otherwise(F.filter("_later", meets))
    return joined.filter(first).withColumn("_rest", rest).withColumn("_rest", F.when(F.size("_rest") > 0, F.col("_rest"))).drop("_past", "_next", "_later")


def gathered(df: DataFrame, span: list[str], fields: list[str], name: str, most: int = 1 << 10) -> DataFrame:
    """Per span an array of the fields of the rows that lie there, in parts of about `most` rows. Rows with a null in the span are left out."""
    parts = df.groupBy(*span).agg(F.ceil(F.count("*") / most).alias("_parts"))
    dealt = df.join(parts, span).withColumn("_part", F.pmod(F.xxhash64(*fields), F.col("_parts")))
    return dealt.groupBy(*span, "_part").agg(F.collect_list(F.struct(*fields)).alias(name)).drop("_part")


def interval_filter(a: DataFrame, b: DataFrame, a_span: tuple[str, str, str], b_span: tuple[str, str, str], keep: bool, bin_bp: int = BIN) -> DataFrame:
    """Rows of a that overlap some row of b, or with keep=False those that overlap none.

    b is merged first, so that many rows over one place are one, and each row of a is a bounded number of probes.
    A row is known by two independent 64-bit hashes of its columns; rows that are equal share their fate.
    """
    ac, a0, a1 = a_span
    bc, b0, b1 = b_span
    merged = merge_intervals(b, [bc], b0, b1).select(F.col(bc).alias("_contig"), F.col(b0).alias("_b0"), F.col(b1).alias("_b1"))
    keyed = a.withColumns({"_row": F.xxhash64(*a.columns), "_other": F.xxhash64(F.lit("other"), *a.columns)})
    hit = (
        _binned(keyed, a0, a1, bin_bp, 0)
        .join(
            _binned(merged, "_b0", "_b1", bin_bp, 0).select("_contig", "_b0", "_b1", F.col("_bin").alias("_bb")),
            (F.col(ac) == F.col("_contig")) & (F.col("_bin") == F.col("_bb")) & (overlap(F.col(a0), F.col(a1), F.col("_b0"), F.col("_b1")) > 0),
            "left_semi",
        )
        .select(F.col("_row").alias("_hit"), F.col("_other").alias("_hit2"))
        .distinct()
    )
    same = (F.col("_row") == F.col("_hit")) & (F.col("_other") == F.col("_hit2"))
    return keyed.join(hit, same, "left_semi" if keep else "left_anti").drop("_row", "_other")


def running_before(df: DataFrame, keys: list[str], position: str, order: list[str], value: Column, how: str, tile: int = TILE) -> Column | DataFrame:
    """df with `_before`: the max or sum of value over the rows before each in the order, within the keys."""
    tiled = df.withColumns({"_tile": F.floor(F.col(position) / tile), "_value": value})
    f = {"max": F.max, "sum": F.sum}[how]
    inside = Window.partitionBy(*keys, "_tile").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = tiled.groupBy(*keys, "_tile").agg(f("_value").alias("_v")).withColumn("_carry", f("_v").over(across)).drop("_v")
    joined = tiled.withColumn("_local", f("_value").over(inside)).join(carried, [*keys, "_tile"])
    both = F.greatest("_local", "_carry") if how == "max" else F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return joined.withColumn("_before", both).drop("_local", "_carry", "_tile", "_value")


def with_previous(df: DataFrame, keys: list[str], position: str, columns: dict[str, str], tile: int = TILE) -> DataFrame:
    """df with columns of the row before it in the order of a distinct whole-number position, within the keys.

    Rows look back within tiles; only the last row of each tile meets the others of its keys.
    """
    held = F.struct(F.col(position), *[F.col(c).alias(n) for n, c in columns.items()])
    seen = running_before(df, keys, position, [position], held, "max", tile)
    return seen.select("*", *[F.col("_before")[n].alias(n) for n in columns]).drop("_before")


def islands(df: DataFrame, keys: list[str], start: str, end: str, touching: bool, ties: list[str] | None = None, name: str = "island") -> DataFrame:
    """df with the number from 0 of its connected group of intervals within the keys, in the order of starts.

    Intervals that only touch are one group if `touching`.
    """
    order = [start, end, *(ties or [])]
    seen = running_before(df, keys, start, order, F.col(end), "max")
    gap = F.col(start) > F.col("_before") if touching else F.col(start) >= F.col("_before")
    flagged = seen.withColumn("_new", F.coalesce(gap.cast("int"), F.lit(0))).drop("_before")
    counted = running_before(flagged, keys, start, order, F.col("_new"), "sum")
    return counted.withColumn(name, (F.col("_before") + F.col("_new")).cast("long")).drop("_new", "_before")


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The union of overlapping or touching intervals within the keys."""
    found = islands(df.select(*keys, start, end).distinct(), keys, start, end, touching=True)
    return found.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def union_and_depth(df: DataFrame, keys: list[str], contig: str, start: str, end: str) -> DataFrame:
    """Per keys: all bases, bases covered, greatest depth. Ends count before starts at one place."""
    both = [*keys, contig]
    events = df.filter(F.col(end) > F.col(start)).select(*both, F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("delta")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("delta")))).alias("e"))
    steps = events.groupBy(*both, F.col("e.pos").alias("pos")).agg(F.sum("e.delta").alias("delta"))
    swept = running_before(steps, both, "pos", ["pos"], F.col("delta"), "sum").withColumn("depth", F.col("_before") + F.col("delta")).drop("_before")
    total = df.filter(F.col(end) > F.col(start)).groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias("total_bp"))
    union = merge_intervals(df.filter(F.col(end) > F.col(start)), both, start, end).groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias("union_bp"))
    return total.join(union, keys).join(swept.groupBy(*keys).agg(F.max("depth").alias("max_depth")), keys)


def top_row(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, name: str | None = None) -> DataFrame:
    """The first n rows of each key in an order that must be total; `name` keeps the rank."""
    ranked = df.withColumn(name or "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name or "_rank") <= n)
    return kept if name else kept.drop("_rank")


def quantiles(df: DataFrame, keys: list[str], value: Column, shares: dict[str, float], tile: float, places: int | None = None) -> DataFrame:
    """Exact quantiles of a number by linear interpolation, a column for each name; null and NaN don't count.

    Equal values are one row before anything meets; counts run over tiles of `tile` values' width, so a group of
    very many rows is many tasks' work and one row a tile meets in one.
    """
    rows = df.select(*keys, value.cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    counted = rows.groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    running = running_before(counted, keys, "_x", ["_x"], F.col("_n"), "sum", tile)
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    if keys:
        same = [running[k].eqNullSafe(totals[k]) for k in keys]
        joined = running.join(totals, same).select(*[running[k] for k in keys], "_x", "_n", "_before", "_total")
    else:
        joined = running.join(F.broadcast(totals))
    before, after = F.coalesce("_before", F.lit(0)), F.coalesce("_before", F.lit(0)) + F.col("_n")
    found, ends = [], []
    for i, share in enumerate(shares.values()):
        place = share * (F.col("_total") - 1)
        for side, at in (("l", F.floor(place)), ("h", F.ceil(place))):
            found.append(F.max(F.when((before <= at) & (at < after), F.col("_x"))).alias(f"_{side}{i}"))
        ends.append(F.max(place - F.floor(place)).alias(f"_f{i}"))
    grouped = joined.groupBy(*keys).agg(*found, *ends)
    at = [F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_f{i}") for i in range(len(shares))]
    return grouped.select(*keys, *[(F.round(q, places) if places is not None else q).alias(n) for n, q in zip(shares, at, strict=True)])


def ranked_by_histogram(df: DataFrame, keys: list[str], order: list[tuple[str, int]], name: str, tile: float) -> DataFrame:
    """df with rank() over descending whole numbers, `order` naming columns from the first.

    Rows of equal values are one row of a histogram, whose running counts go over tiles of the first column.
    """
    columns = [c for c, _ in order]
    counted = df.groupBy(*keys, *columns).agg(F.count("*").alias("_n")).withColumn("_place", -F.col(columns[0]))
    flipped = counted.withColumns({f"_o{i}": F.col(c) * sign for i, (c, sign) in enumerate(order)})
    running = running_before(flipped, keys, "_place", [f"_o{i}" for i in range(len(order))], F.col("_n"), "sum", tile)
    ranks = running.select(*keys, *columns, (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias(name))
    return df.join(ranks, [*keys, *columns])
