"""Per-key rate limit in windows anchored at a key's own events.

A key's first event opens a window; the first event at least one window length
after that opens the next. In each window the first ``limit`` events are allowed.

Whether an event opens a window depends on all earlier events of its key, yet no task
ever sees a key as a whole, and the work does not depend on how many windows there are:
one sort over all keys gives every event time its successor, the first time that is at
least one window length later. A key's sorted times are cut into blocks. Inside a block
the successors are followed as places in an array; between blocks only the times a chain
can come in by are left, and these are followed by doubling: a round joins the jumps with
themselves, so that they reach twice as far, and adds where the openings known so far jump
to. The rounds are as many as the binary digits of the blocks of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemirror.session import checkpointed

MICROS = 1_000_000
OPENED, USED = "_opened", "_used"
# Times of a key that are followed at once, as one array.
BLOCK = 4096


def micros(ts: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts) if isinstance(ts, str) else ts)


def rate_limit(
    events: DataFrame,
    key: str,
    ts: str,
    tie: str,
    *,
    limit: int = 10,
    window_seconds: int = 60,
    carried: DataFrame | None = None,
) -> DataFrame:
    """``events`` with ``allowed`` and ``remaining``.

    ``ts`` is a TIMESTAMP_NTZ; ``tie`` is unique per event and orders equal times. ``carried``
    (see ``open_windows``) has the windows that earlier events left open.
    """
    timed = _timed(events, key, ts, carried)
    return _allowed(events.columns, timed, _in_windows(timed, key, window_seconds * MICROS), key, tie, limit)


def open_windows(
    events: DataFrame, key: str, ts: str, *, limit: int = 10, window_seconds: int = 60, carried: DataFrame | None = None
) -> DataFrame:
    """``key``, ``_opened`` and ``_used`` of every key's last window, leaving out those that are over.

    A window is over when the newest event of all is at least one window length past its
    opening. Keys of ``carried`` without an event are carried on.
    """
    timed = _timed(events, key, ts, carried)
    return _last_windows(timed, _in_windows(timed, key, window_seconds * MICROS), key, limit, window_seconds * MICROS, carried)


def rate_limit_and_windows(
    events: DataFrame, key: str, ts: str, tie: str, *, limit: int = 10, window_seconds: int = 60, carried: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both of the above from one placement of the events in their windows."""
    timed = _timed(events, key, ts, carried)
    width = window_seconds * MICROS
    placed = _in_windows(timed, key, width)
    return _allowed(events.columns, timed, placed, key, tie, limit), _last_windows(timed, placed, key, limit, width, carried)


def _allowed(columns: list[str], timed: DataFrame, placed: DataFrame, key: str, tie: str, limit: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key, "_open").orderBy("_t", "_at", tie))
    first = placed.select(key, "_open", "_t", "_at", tie, OPENED, USED).withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    before = F.when(F.col("_open") == F.col(OPENED), F.col(USED)).otherwise(0)
    # A missing key is a key like any other, hence the null-safe comparisons.
    first = first.withColumn("_rank", (F.col("_rank") + before).cast("int")).filter(F.col("_rank") <= limit).select(
        F.col(key).alias("_key"), F.col("_at").alias("_own"), F.col(tie).alias("_tie"), "_rank"
    )
    same_event = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_own")) & (F.col(tie) == F.col("_tie"))
    return timed.join(first, same_event, "left").select(
        *columns,
        F.col("_rank").isNotNull().alias("allowed"),
        F.coalesce(F.lit(limit) - F.col("_rank"), F.lit(0)).alias("remaining"),
    )


def _last_windows(timed: DataFrame, placed: DataFrame, key: str, limit: int, width: int, carried: DataFrame | None) -> DataFrame:
    counted = placed.groupBy(key, "_open").agg(F.count("*").alias("n"), F.max(OPENED).alias(OPENED), F.max(USED).alias(USED))
    used = F.col("n") + F.when(F.col("_open") == F.col(OPENED), F.col(USED)).otherwise(0)
    last = counted.groupBy(key).agg(F.max_by(F.struct(F.col("_open").alias(OPENED), F.least(used, F.lit(limit)).cast("int").alias(USED)), "_open").alias("w"))
    now = last.select(key, "w.*")
    if carried is not None:
        seen = now.select(F.col(key).alias("_key"))
        now = now.unionByName(carried.join(seen, F.col(key).eqNullSafe(F.col("_key")), "left_anti"))
    newest = timed.select(F.max("_at")).scalar()
    return now.filter(F.col(OPENED) + F.lit(width) > F.coalesce(newest, F.col(OPENED)))


def _timed(events: DataFrame, key: str, ts: str, carried: DataFrame | None) -> DataFrame:
    """Events with their own time ``_at`` and the time ``_t`` they count at: never before a carried opening."""
    timed = events.withColumn("_at", micros(ts))
    if carried is None:
        none = F.lit(None).cast("bigint")
        return timed.withColumns({"_t": F.col("_at"), OPENED: none, USED: F.lit(None).cast("int")})
    open_now = carried.select(F.col(key).alias("_key"), OPENED, USED)
    timed = timed.join(open_now, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return timed.withColumn("_t", F.greatest("_at", OPENED))


def _in_windows(timed: DataFrame, key: str, width: int) -> DataFrame:
    """Events with ``_open``, the opening of their window."""
    times = timed.select(key, "_t").union(timed.select(key, OPENED).filter(f"{OPENED} IS NOT NULL")).distinct()
    starts = _openings(times, key, width)
    slot = F.floor(F.col("_t") / F.lit(width)).cast("bigint")
    # Openings are at least one width apart: at most one per slot, so an event's
    # window was opened in its own slot or in the one before.
    none = F.lit(None).cast("bigint")
    own = F.struct(slot.alias("_in"), F.col("_t").alias("_own"), none.alias("_prev"))
    following = F.struct((slot + 1).alias("_in"), none.alias("_own"), F.col("_t").alias("_prev"))
    by_slot = starts.select(F.col(key).alias("_key"), F.inline(F.array(own, following)))
    slots = by_slot.groupBy("_key", "_in").agg(F.max("_own").alias("_own"), F.max("_prev").alias("_prev"))
    same_slot = F.col(key).eqNullSafe(F.col("_key")) & (slot == F.col("_in"))
    opened = F.when(F.col("_own") <= F.col("_t"), F.col("_own")).otherwise(F.col("_prev"))
    return timed.join(slots, same_slot, "left").withColumn("_open", opened).drop("_key", "_in", "_own", "_prev")


def successors(times: DataFrame, key: str, width: int) -> DataFrame:
    """``(key, _t, _next)``: the first time of the key at least ``width`` later; times without one are left out.

    Times and the moments windows end are sorted together over all tasks. Within a partition
    a moment's successor is the next time of its key; for the last ones of a partition it is
    the first time of the partitions after it, of which one row each is looked at.
    """
    return _followed(times, key, width).select(key, "_t", "_next")


def _followed(times: DataFrame, key: str, width: int) -> DataFrame:
    """``successors`` with their partition ``_part`` and ``_block``: the times of a key's block follow each other."""
    spark = times.sparkSession
    ends = times.select(key, (F.col("_t") + width).alias("_m"), F.lit(0).alias("_is_time"), "_t")
    marks = ends.union(times.select(key, F.col("_t").alias("_m"), F.lit(1), F.lit(None).cast("bigint")))
    # An end comes before a time of the same moment, which is late enough.
    placed = checkpointed(spark, marks.sort(key, "_m", "_is_time")).withColumn("_part", F.spark_partition_id())
    time = F.when(F.col("_is_time") == 1, F.col("_m"))
    # From the last mark back, as a frame that only grows is one step a row.
    ahead = Window.partitionBy("_part", key).orderBy(F.desc("_m"), F.desc("_is_time")).rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumns({"_inside": F.min(time).over(ahead), "_ends": F.count_if(F.col("_is_time") == 0).over(ahead)}).filter("_is_time = 0")
    # One row per partition of the sort.
    first = F.min(F.when(F.col("_is_time") == 1, F.struct(F.col(key).alias("key"), F.col("_m").alias("m"))))
    later = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    heads = placed.groupBy("_part").agg(first.alias("_first")).select("_part", F.last("_first", ignorenulls=True).over(later).alias("_head"))
    found = inside.join(F.broadcast(heads), "_part")
    across = F.when(F.col("_head.key").eqNullSafe(F.col(key)) & F.col("_head").isNotNull(), F.col("_head.m"))
    block = F.expr(f"int((_ends - 1) div {BLOCK})").alias("_block")
    return found.select(key, "_t", F.coalesce("_inside", across).alias("_next"), "_part", block).filter("_next IS NOT NULL")


def _blocks(times: DataFrame, key: str, width: int) -> DataFrame:
    """One row per block: ``_part``, ``_block`` and ``_rows``, its times with their successor and ``n``, the place of it.

    Places count from 0; a successor outside the block has the place after the last.
    """
    near = Window.partitionBy("_part", key, "_block").orderBy("_t").rangeBetween(Window.unboundedPreceding, width - 1)
    placed = _followed(times, key, width).filter("_t IS NOT NULL").withColumn("_n", F.count("*").over(near).cast("int"))
    row = F.struct(F.col("_t").alias("t"), F.col("_n").alias("n"), F.col("_next").alias("next"))
    return placed.groupBy("_part", key, "_block").agg(F.sort_array(F.collect_list(row)).alias("_rows"))


# A round for each binary digit of the number of times, each round with jumps twice as far.
_DIGITS = "sequence(1, length(bin(size(_rows))))"
# The place where a chain leaves the block, for each place it may come in.
_LAST = f"""
    aggregate({_DIGITS}, transform(_rows, (r, i) -> if(r.n < size(_rows), r.n, i)), (far, _) -> transform(far, i -> get(far, i)))
"""
# The places of the chain that comes in at ``_at``, which is the first of them.
_CHAIN = f"""
    aggregate({_DIGITS}, struct(transform(_rows, r -> r.n) AS far, array(_at) AS chain),
        (done, _) -> struct(
            transform(done.far, i -> coalesce(get(done.far, i), i)) AS far,
            concat(done.chain, filter(transform(done.chain, i -> get(done.far, i)), i -> i < size(_rows))) AS chain),
        done -> done.chain)
"""


def _openings(times: DataFrame, key: str, width: int) -> DataFrame:
    """Event times that open a window: ``(key, _t)``."""
    spark = times.sparkSession
    blocks = checkpointed(spark, _blocks(times, key, width))
    # A chain comes from a time before the block, so not later than by the successor of the block's first time.
    ways = F.expr("transform(slice(_last, 1, _rows[0].n + 1), (last, i) -> struct(i AS at, get(_rows, i).t AS t, get(_rows, last).next AS next))")
    ins = blocks.withColumn("_last", F.expr(_LAST)).select("_part", key, "_block", F.inline(ways).alias("_at", "_t", "_next"))
    ins = checkpointed(spark, ins)
    jumps = ins.select(key, "_t", "_next")
    known = checkpointed(spark, times.groupBy(key).agg(F.min("_t").alias("_t")))
    while not jumps.isEmpty():
        on = jumps.select(F.col(key).alias("_key"), F.col("_t").alias("_from"), F.col("_next").alias("_to"))
        further = known.join(on, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_t") == F.col("_from"))).select(key, F.col("_to").alias("_t"))
        known = checkpointed(spark, known.union(further))
        twice = jumps.join(on, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_next") == F.col("_from")))
        jumps = checkpointed(spark, twice.select(key, "_t", F.col("_to").alias("_next")))
    # Where the chain comes into each block, and from there its other times in it.
    met = known.select(F.col(key).alias("_key"), F.col("_t").alias("_own"))
    came = ins.join(met, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_t") == F.col("_own")), "left_semi")
    came = came.select(F.col("_part").alias("_p"), F.col(key).alias("_key"), F.col("_block").alias("_b"), "_at")
    same_block = (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_b"))
    chains = blocks.join(came, same_block).withColumn("_chain", F.expr(_CHAIN))
    others = F.expr("transform(slice(_chain, 2, size(_chain)), i -> get(_rows, i).t)")
    return known.union(chains.select(key, F.explode(others).alias("_t")))
