"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask keeps some of ``SPAN`` consecutive words and ignores the others. Every inner place is ignored by one
mask, so that one substituted word leaves a seed intact. All positions of items and texts are hashed. A hit
fixes an alignment of text and item, and the overlap is then scored along it: one for an
equal word, less ``PENALTY`` for another, over the best stretch. Every alignment with a hit counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vectable.llm.common import GAP, as_text
from vectable.sources.tables import settle, small_side

MASKS = ("10110110111", "11011011011", "11101101101")
SPAN = len(MASKS[0])
PENALTY = 1
LEAST = SPAN
_BLANKS = " \t\n\x0b\x0c\r"


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words of a text."""
    return F.transform(F.split(F.btrim(F.lower(text), F.lit(_BLANKS)), GAP), lambda word: F.xxhash64(word))


def seeds(hashes: Column) -> Column:
    """Hashes of all masks at every position: place p is mask p % len(MASKS) at position p // len(MASKS). Empty
    for fewer than SPAN words."""

    def seed(place: Column) -> Column:
        start = (place / len(MASKS)).cast("int")
        kept = [
            F.xxhash64(*[F.get(hashes, start + i) for i, keep in enumerate(mask) if keep == "1"], F.lit(n)) for n, mask in enumerate(MASKS)
        ]
        return reduce(lambda rest, n: F.when(place % len(MASKS) == n, kept[n]).otherwise(rest), range(len(MASKS) - 1), kept[-1])

    places = F.sequence(F.lit(0), (F.size(hashes) - SPAN + 1) * len(MASKS) - 1)
    return F.when(F.size(hashes) >= SPAN, F.transform(places, seed)).otherwise(F.array().cast("array<bigint>"))


def _seeded(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, place, seed: one row per hashed window of ``rows`` with column ``hashes``, or one with NULLs."""
    # The outer form: the filter that Spark infers for the inner one would hash all windows a second time.
    return rows.select(*keys, seeds(F.col("hashes")).alias("s")).select(*keys, F.posexplode_outer("s").alias("place", "seed"))


def _with_previous(windows: DataFrame, *keys: str) -> DataFrame:
    """keys, seed, start, previous: the seed of the same mask one word earlier, NULL if ``windows`` lacks it."""
    mask = (F.col("place") % len(MASKS)).alias("mask")
    rows = windows.select(*keys, "seed", mask, (F.col("place") / len(MASKS)).cast("int").alias("start"))
    order = Window.partitionBy(*keys, "mask").orderBy("start")
    next_to = F.lag("start").over(order) == F.col("start") - 1
    return rows.select(*keys, "seed", "start", F.when(next_to, F.lag("seed").over(order)).alias("previous"))


def overlap(a: Column, b: Column, shift: Column) -> Column:
    """Score of the best stretch where word i of ``b`` stands at word i + shift of ``a``, and where it ends in b."""
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size(b), F.size(a) - shift) - 1
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("at"))

    def step(state: Column, i: Column) -> Column:
        now = F.when(F.get(a, i + shift) == F.get(b, i), state["now"] + 1).otherwise(F.greatest(state["now"] - PENALTY, F.lit(0)))
        better = now > state["best"]
        return F.struct(
            now.alias("now"), F.when(better, now).otherwise(state["best"]).alias("best"), F.when(better, i + 1).otherwise(state["at"]).alias("at")
        )

    return F.aggregate(F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>")), zero, step)


def best_overlap(a: Column, b: Column, shifts: Column) -> Column:
    """Score, end in a and end in b of the best overlap along all ``shifts`` of ``b`` in ``a``, the largest such struct.
    Shifts come in order of the most that they can reach, and are not scored where that is no more than the best."""

    def reach(shift: Column) -> Column:
        end = F.least(F.size(b), F.size(a) - shift)
        return F.struct((end - F.greatest(F.lit(0), -shift)).alias("score"), (end + shift).alias("doc_end"), end.alias("item_end"))

    def step(best: Column, found: Column) -> Column:
        # A list of one stands for a variable, so that an overlap is scored once.
        scored = F.transform(F.array(overlap(a, b, found["shift"])), lambda o: F.struct(
            o["best"].alias("score"), (o["at"] + found["shift"]).alias("doc_end"), o["at"].alias("item_end")
        ))
        return F.when(found["reach"] <= best, best).otherwise(F.greatest(best, F.get(scored, F.lit(0))))

    ordered = F.sort_array(F.transform(shifts, lambda s: F.struct(reach(s).alias("reach"), s.alias("shift"))), asc=False)
    none = F.struct(F.lit(0).alias("score"), F.lit(0).alias("doc_end"), F.lit(0).alias("item_end"))
    return F.aggregate(ordered, none, step)


def _whole_items(hashed: DataFrame, items: DataFrame, words: int) -> DataFrame:
    """key, twin, item, b: the places where items of so many words stand in a text word for word."""
    small = items.select("item", F.xxhash64(*[F.col("item_hashes")[i] for i in range(words)]).alias("whole"))
    starts = F.when(F.size("hashes") >= words, F.sequence(F.lit(0), F.size("hashes") - words)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda at: F.xxhash64(*[F.get("hashes", at + i) for i in range(words)]))
    placed = hashed.select("key", "twin", F.posexplode(windows).alias("at", "whole"))
    met = placed.join(small_side(settle(small)), "whole")
    b = F.struct(F.lit(words).alias("score"), (F.col("at") + words).alias("doc_end"), F.lit(words).alias("item_end"))
    return met.groupBy("key", "twin", "item").agg(F.max(b).alias("b"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    least: int = LEAST,
) -> DataFrame:
    """Overlaps of texts and benchmark items: key, twin (hash of the text), item, score, doc_end and item_end
    (the word after the best stretch); one row per key, text and item.

    All places of a window that repeats within a text or an item count. Of hits one word apart along an alignment only the
    first is a row, so hits of long repetitions grow with the words and not with their square.
    An overlap counts from a score of ``least`` on, or of the item's words if it has fewer. Words are
    lower-cased. An item of 1 to SPAN - 1 words is found where it stands word for word (doc_end: its last place). Empty and NULL
    texts and items overlap with nothing; a NULL key or item id is kept as it is. Repeated rows give one row. Empty tables give an empty result.
    Other columns are not read.
    """
    texts = docs.select(F.col(key).alias("key"), as_text(text).alias("text"))
    texts = texts.withColumn("twin", F.xxhash64("text"))
    items = benchmark.select(F.col(item).alias("item"), word_hashes(as_text(item_text)).alias("item_hashes"))
    items = items.filter((F.size("item_hashes") > 0) & (items["item_hashes"][0] != F.xxhash64(F.lit("")))).distinct()
    short, items = items.filter(F.size("item_hashes") < SPAN), items.filter(F.size("item_hashes") >= SPAN)
    windows = _with_previous(_seeded(items.withColumnRenamed("item_hashes", "hashes"), "item"), "item")
    # Items may share an id: what is not next to it in all of them is listed apart, and a shift too many is only scored.
    listed = [F.col("item"), F.col("seed").alias("item_seed"), F.col("previous").alias("item_previous")]
    windows = settle(windows.groupBy(*listed).agg(F.collect_set("start").alias("item_starts")))
    hashed = texts.select("key", "twin", word_hashes(F.col("text")).alias("hashes"))
    asked = small_side(settle(windows.select("item_seed").distinct()))
    hits = _seeded(hashed, "key", "twin").join(asked, F.col("seed") == F.col("item_seed"), "left_semi")
    # A NULL is no match: at the head of a text, of an item or of a row of hits, the window is the first.
    hits = settle(_with_previous(hits.distinct(), "key", "twin"))
    hits = hits.join(small_side(windows), F.col("seed") == F.col("item_seed"))
    hits = hits.filter(F.coalesce(F.col("previous") != F.col("item_previous"), F.lit(True)))
    hits = hits.select("key", "twin", "item", "start", F.explode("item_starts").alias("item_start"))
    hits = settle(hits.groupBy("key", "twin", "item").agg(F.collect_set(F.col("start") - F.col("item_start")).alias("shifts")))
    hit = hits.select(F.col("key").alias("k"), F.col("twin").alias("t")).distinct()
    held = texts.join(small_side(settle(hit)), F.col("key").eqNullSafe(F.col("k")) & (F.col("twin") == F.col("t")), "left_semi")
    held = held.distinct().select(F.col("key").alias("k"), F.col("twin").alias("t"), word_hashes(F.col("text")).alias("hashes"))
    known = small_side(settle(items.withColumnRenamed("item", "i")))
    pairs = hits.join(held, F.col("key").eqNullSafe(F.col("k")) & (F.col("twin") == F.col("t"))).join(known, F.col("item").eqNullSafe(F.col("i")))
    best = best_overlap(F.col("hashes"), F.col("item_hashes"), F.col("shifts"))
    scored = pairs.select("key", "twin", "item", F.size("item_hashes").alias("n"), best.alias("b"))
    found = scored.filter(F.col("b.score") >= F.least(F.lit(least), F.col("n")))
    found = found.select("key", "twin", "item", "b")
    for words in [r[0] for r in short.select(F.size("item_hashes").alias("n")).distinct().orderBy("n").collect()]:  # under SPAN of them
        found = found.unionByName(_whole_items(hashed, short.filter(F.size("item_hashes") == words), words))
    # Items may share an id.
    return found.groupBy("key", "twin", "item").agg(F.max("b").alias("b")).select(
        F.col("key").alias(key), "twin", F.col("item").alias(item), "b.*"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap with a benchmark item; see ``leaks``."""
    gone = leaks(docs, benchmark, key=key, text=text).select(F.col(key).alias("__gone"), F.col("twin").alias("__t")).distinct()
    rows = docs.withColumn("__twin", F.xxhash64(as_text(text)))
    same = F.col(key).eqNullSafe(F.col("__gone")) & (F.col("__twin") == F.col("__t"))
    return rows.join(settle(gone), same, "left_anti").drop("__twin")
