"""Line dedup: maximal repeated runs of lines, by a suffix array over line ids.

All lines but blank ones make one long sequence of line ids, in the order of their
documents; runs never leave a document. Suffixes are ranked by prefix doubling: the rank
by 2k lines comes from the ranks by k lines at a place and k lines further on. A rank is
named by the first place that has it, so no round sorts. A suffix whose rank is its own has
no repeated prefix of that length and takes no further part, so each round handles only what
still repeats.

Suffixes of one rank are an interval of the suffix array. For every place that is not the
first of some interval, the rounds are gone through once more, from the longest prefixes
down, to find its deepest such interval: the longest common prefix with any earlier place,
which is the maximal run that is a later copy there. Within an interval, the suffixes that
agree on the next 2^k lines make an interval of their own; all but its first go on in that
one, the others look for shorter agreement where they are. So every place is in one interval
at a time, and an interval has one row besides, its first place.

A maximal run counts when its lines have ``min_words`` words together; lines without a letter
have none. Where ``max_copies`` is given, a single line with a letter that occurs more often
than that counts too. Every line that a later copy of such a run covers is deleted. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemirror.llm.shared import free_name, stored

MIN_WORDS = 5
NOT_BLANK = r"[^\x20\x09-\x0D]"
PLACE = ["doc", "row", "seq"]


def lines(docs: DataFrame) -> DataFrame:
    """Every line that is not blank: its document, number among these lines, place, words and 96-bit hash.

    A document is its id with a hash of its text, so rows that repeat both have the same places.
    """
    found = F.filter(
        F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))), lambda s: s["line"].rlike(NOT_BLANK)
    )
    return docs.select("doc", "row", F.posexplode(found).alias("seq", "one")).select(
        *PLACE,
        F.col("one.pos").alias("pos"),
        F.when(F.col("one.line").rlike(r"\p{L}"), F.size(F.split(F.trim("one.line"), r"\s+"))).otherwise(0).alias("words"),
        F.xxhash64("one.line").alias("h"),
        F.hash("one.line").alias("g"),
    )


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` that several places share, with the first of these; common keys are combined before the shuffle."""
    place = F.struct(*PLACE)
    return rows.groupBy(*keys).agg(F.min(place).alias("head"), F.max(place).alias("tail")).where("head < tail").drop("tail")


def _merged(df: DataFrame, other: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of two tables of places. It is never a broadcast: a round has several joins, and small
    tables would leave the relations of all rounds with the driver at once."""
    return df.join(other.hint("merge"), on, how)


def _kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Rows written once, and their number."""
    count = Observation()
    out = stored(df.observe(count, F.count("*").alias("rows")), name)
    return out, count.get["rows"]


def intervals(rows: DataFrame, rounds: int = 62) -> list[DataFrame]:
    """For prefixes of 1, 2, 4 … lines the suffixes that share theirs with another: place and ``first``, that of the first of them.

    Single lines have ``pos`` and ``words`` too.
    """
    single = _merged(rows, _groups(rows, ["h", "g"]), ["h", "g"]).select(*PLACE, "pos", "words", F.col("head").alias("first"))
    # Rows that repeat id and text share their places.
    level, size = _kept(single.dropDuplicates(PLACE), "lines-1")
    levels = []
    while size and len(levels) <= rounds:
        levels.append(level)
        step = 1 << (len(levels) - 1)
        ahead = Window.partitionBy("doc", "row").orderBy("seq").rangeBetween(step, step)
        # A suffix whose further part is unique, or that ends its document, is unique from here on.
        both = level.select(*PLACE, "first", F.first("first").over(ahead).alias("further")).where("further IS NOT NULL")
        twice = _merged(both, _groups(both, ["first", "further"]), ["first", "further"])
        level, size = _kept(twice.select(*PLACE, F.col("head").alias("first")), f"lines-{1 << len(levels)}")
    return levels


def later_runs(levels: list[DataFrame]) -> DataFrame:
    """``PLACE`` and ``length``: for every place with an earlier copy, the lines that the longest one shares with it."""
    place = F.struct(*PLACE)
    runs = None
    for k in reversed(range(len(levels))):
        level = levels[k]
        if runs is not None:
            # Where the lines after the shared ones agree on 2^k more, a longer interval begins.
            after = level.select("doc", "row", F.col("seq").alias("_next"), F.col("first").alias("further"))
            asked = _merged(runs.withColumn("_next", F.col("seq") + F.col("length")), after, ["doc", "row", "_next"], "left").drop("_next")
            deeper = _groups(asked.where("further IS NOT NULL"), ["length", "first", "further"])
            met = _merged(asked, deeper, ["length", "first", "further"], "left")
            old = F.struct("length", "first")
            new = F.struct((F.col("length") + (1 << k)).alias("length"), F.col("head").alias("first"))
            # The first place of the longer interval stays in the shorter one as well.
            stays = F.when(F.col("head").isNull(), F.array(old)).when(place > F.col("head"), F.array(new)).otherwise(F.array(old, new))
            runs = met.select(*PLACE, F.explode(stays).alias("in")).select(*PLACE, "in.*")
        later = level.where(place > F.col("first")).select(*PLACE, F.lit(1 << k).alias("length"), "first")
        if runs is not None:
            later = _merged(later, runs.where(place > F.col("first")).select(*PLACE), PLACE, "left_anti")
        heads = later.select("length", "first").distinct().select("first.*", "length", "first")
        runs = later.unionByName(heads) if runs is None else runs.unionByName(later).unionByName(heads)
        runs = stored(runs, f"runs-{1 << k}")
    return runs.where(place > F.col("first")).select(*PLACE, "length")


def deleted(rows: DataFrame, min_words: int = MIN_WORDS, max_copies: int | None = None, rounds: int = 62) -> DataFrame:
    """``doc``, ``row``, ``removed`` (places of deleted lines) and ``run_lines``, the lines of the longest deleted run.

    Runs are followed up to ``2 ** (rounds + 1) - 1`` lines.
    """
    levels = intervals(rows, rounds)
    if not levels:
        return rows.select("doc", "row", F.array("pos").alias("removed"), F.col("seq").alias("run_lines")).limit(0)
    single = levels[0]
    # A window over the lines of one document. All lines of a run repeat, so they stand side by side here.
    upto = Window.partitionBy("doc", "row").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = single.withColumn("upto", F.sum("words").over(upto))
    last = counted.select("doc", "row", F.col("seq").alias("last"), F.col("upto").alias("to"))
    runs = _merged(later_runs(levels), counted.select(*PLACE, (F.col("upto") - F.col("words")).alias("from")), PLACE)
    runs = _merged(runs.withColumn("last", F.col("seq") + F.col("length") - 1), last, ["doc", "row", "last"])
    runs = runs.where(F.col("to") - F.col("from") >= min_words).select(*PLACE, "length")
    if max_copies is not None:
        often = single.where("words > 0").groupBy("first").count().where(F.col("count") > max_copies).select("first")
        copies = _merged(single.where(F.struct(*PLACE) > F.col("first")), often, ["first"], "left_semi")
        runs = runs.unionByName(copies.select(*PLACE, F.lit(1).alias("length")))
    covered = runs.select("doc", "row", "length", F.explode(F.sequence("seq", F.col("seq") + F.col("length") - 1)).alias("seq"))
    covered = covered.groupBy(*PLACE).agg(F.max("length").alias("length"))
    places = _merged(covered, single.select(*PLACE, "pos"), PLACE)
    return places.groupBy("doc", "row").agg(F.collect_set("pos").alias("removed"), F.max("length").alias("run_lines"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, max_copies: int | None = None, rounds: int = 62) -> DataFrame:
    """All columns with ``text`` without its deleted lines, and ``n_lines``, ``n_removed`` and ``run_lines``.

    The first copy of a run is that of the smallest id, null ids last. Blank lines are never deleted and
    do not end a run. A null text stays null, an empty one empty. Rows that repeat id and
    text get the same result. An empty table gives an empty result; columns named as the
    added ones are replaced, all others are kept whatever their names.
    """
    docs = docs.drop("n_lines", "n_removed", "run_lines")
    doc, row, removed = (free_name(docs, f"_{c}") for c in ("doc", "row", "removed"))
    keyed = docs.withColumns({doc: F.coalesce(F.col(doc_id).cast("bigint"), F.lit(2**63 - 1)), row: F.xxhash64(F.col(doc_id).cast("bigint"), F.col(text))})
    gone = deleted(lines(keyed.select(F.col(doc).alias("doc"), F.col(row).alias("row"), F.col(text).alias("text"))), min_words, max_copies, rounds)
    gone = gone.select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("removed").alias(removed), "run_lines")
    parts = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), removed)
    cleaned = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    return (
        _merged(keyed, gone, [doc, row], "left")
        .withColumns(
            {
                "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("bigint"),
                "n_removed": F.coalesce(F.array_size(removed), F.lit(0)).cast("bigint"),
                "run_lines": F.coalesce("run_lines", F.lit(0)).cast("bigint"),
                text: F.when(F.col(removed).isNull(), F.col(text)).otherwise(cleaned),
            }
        )
        .drop(doc, row, removed)
    )
