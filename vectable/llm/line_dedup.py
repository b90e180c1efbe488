"""Line deduplication by pairwise alignment of overlapping documents.

Lines with words are taken in runs: from every line on, as few lines as hold ``BLOCK_WORDS`` words, and up to every
line, as few as do. A line of that many words is a run by itself; lists, headings and verse make runs of several
lines. Whatever block of lines two documents share, if it has so many words, is covered by the runs inside
it. Such a run is rare enough to link two documents: each has a holder, the smallest key that has it, and links every
later document with it to its holder, so that links grow with the lines and never with the square of a
group. Linked documents are aligned as patience diff does: their common runs, each unique by its number of
occurrence, in the longest sequence that rises in both. The lines of aligned runs go from the later document, with the
blank lines after them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from vectable.llm.common import as_bytes, values
from vectable.sources.tables import settle, small_side

BLOCK_WORDS = 10

RUN = "key bigint, twin bigint, high bigint, low bigint, nth int, place int, line int, end int"
RUN_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
FLUSH = 100_000
SPAN_BYTES = 64 * 1024 * 1024


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def runs(text: bytes, least: int = BLOCK_WORDS) -> list[tuple]:
    """high, low (of the run's hash), nth, place, line, end: the shortest runs of at least ``least`` words from and up to every
    line with words, in order. place orders the runs of a document; lines from line up to end go with the run."""
    marks, sizes, starts = [], [], []
    lines = text.split(b"\n")
    for number, line in enumerate(lines):
        words = len(line.split())
        if words:
            marks.append(xxhash.xxh3_128_digest(line))
            sizes.append(words)
            starts.append(number)
    spans, first, total = set(), 0, 0
    for last, words in enumerate(sizes):
        total += words
        while total - sizes[first] >= least:  # ``first`` starts a run that ended before or here, and another starts later
            total -= sizes[first]
            first += 1
        if total >= least:
            spans.add((first, last))  # the shortest run up to this line
    last, total = -1, 0
    for first, words in enumerate(sizes):
        while total < least and last + 1 < len(sizes):
            last += 1
            total += sizes[last]
        if total < least:
            break
        spans.add((first, last))  # the shortest run from this line
        total -= words
    seen: Counter = Counter()
    bounds = [0, *starts[1:], len(lines)]  # blank lines go with the line before them, those at the head with the first
    out = []
    for first, last in sorted(spans):
        whole = xxhash.xxh3_128_intdigest(b"".join(marks[first : last + 1]))
        seen[whole] += 1
        out.append((_signed(whole >> 64), _signed(whole & (1 << 64) - 1), seen[whole], first + last, bounds[first], bounds[last + 1]))
    return out


def longest_rise(numbers: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    ends: list[int] = []
    places: list[int] = []
    before: list[int] = []
    for place, number in enumerate(numbers):
        at = bisect_left(ends, number)
        before.append(places[at - 1] if at else -1)
        ends[at : at + 1], places[at : at + 1] = [number], [place]
    out = []
    place = places[-1] if places else -1
    while place >= 0:
        out.append(place)
        place = before[place]
    return out[::-1]


def aligned_lines(matches: list[dict]) -> list[int]:
    """Line spans (start, end, start, end) to delete from the later document of a pair, joined where they touch.

    ``matches``: place, line, end of the common runs in the later document; place_a in the earlier.
    """
    matches = sorted(matches, key=lambda m: m["place"])
    spans: list[int] = []
    for m in (matches[i] for i in longest_rise([m["place_a"] for m in matches])):
        if spans and m["line"] <= spans[-1]:
            spans[-1] = max(spans[-1], m["end"])
        else:
            spans += [m["line"], m["end"]]
    return spans


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _align(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([aligned_lines(matches) for matches in values(batch)], pa.list_(pa.int32()))


align = _align.asNondeterministic()  # or Spark computes it again wherever its result is filtered


def cut_lines(text: bytes, spans: list[int] | None) -> tuple[bytes, int, int]:
    """The text without the lines in the spans, its number of lines before, and of those removed."""
    lines = text.split(b"\n") if text else []
    gone = {n for a, b in zip(*[iter(spans or [])] * 2) for n in range(a, b)}
    return b"\n".join(line for n, line in enumerate(lines) if n not in gone), len(lines), len(gone)


CUT = T.StructType([
    T.StructField("kept", T.BinaryType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()),
])
CUT_ARROW = pa.struct([("kept", pa.binary()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])


@F.arrow_udf(CUT)
def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, covers in batches:
        rows = (cut_lines(text, spans) for text, spans in zip(values(texts), values(covers)))
        yield pa.array([dict(zip(CUT.names, row)) for row in rows], CUT_ARROW)


cut = _cut.asNondeterministic()


def line_runs(docs: DataFrame) -> DataFrame:
    """One row per run of ``docs`` (key bigint, twin bigint, text binary)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list) -> pa.RecordBatch:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), RUN_ARROW)]
            return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in RUN.split(", ")])

        rows: list = []
        for batch in batches:
            for key, twin, text in zip(*(values(batch.column(i)) for i in range(3))):
                rows += [(key, twin, *run) for run in runs(text)]
                if len(rows) >= FLUSH:
                    yield made(rows)
                    rows = []
        if rows:
            yield made(rows)

    return docs.mapInArrow(scan, RUN)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """key, twin, spans: the line spans to delete from ``docs`` (key bigint, twin bigint, text binary)."""
    found = settle(line_runs(docs))
    run = ["high", "low", "nth"]
    held = found.groupBy(*run).agg(F.min(F.struct("key", "twin", "place")).alias("a"), F.max("key").alias("last")).filter("last > a.key")
    holders = settle(held.select(*[F.col(c).alias(f"{c}_a") for c in run], "a"))
    same = [F.col(c) == F.col(f"{c}_a") for c in run]
    met = found.join(holders, same[0] & same[1] & same[2]).filter("key > a.key")
    match = F.struct("place", "line", "end", F.col("a.place").alias("place_a"))
    # Rows that are the same in key and text give the same matches: a set, or they would align with themselves twice.
    pairs = met.groupBy("key", "twin", F.col("a.key").alias("a_key"), F.col("a.twin").alias("a_twin"))
    spans = pairs.agg(F.collect_set(match).alias("matches")).select("key", "twin", align("matches").alias("spans"))
    return spans.groupBy("key", "twin").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` cut, and the columns n_lines (before the cut) and n_removed.

    All documents are judged on the input. Lines are what line feeds part; an empty or NULL text has none
    and comes out empty. ``key`` holds integers. One row per input row with all its columns (n_lines and n_removed replace columns of
    these names). Rows with one key never lose lines to each other; a NULL key holds nothing and loses
    nothing. Of equal lines the smallest key keeps its own. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(  # the row travels as one struct, so that no column can clash with a name used here
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{key}`").cast("bigint").alias("id"), as_bytes(text).alias("bytes")
    ).withColumn("hash", F.xxhash64("bytes"))
    spans = repeated_lines(rows.filter("id IS NOT NULL").select(F.col("id").alias("key"), F.col("hash").alias("twin"), F.col("bytes").alias("text")))
    spans = small_side(settle(spans), max_bytes=SPAN_BYTES)  # texts stay where they are while few enough documents are cut
    joined = rows.join(spans, (F.col("id") == F.col("key")) & (F.col("hash") == F.col("twin")), "left")
    out = joined.select("row", cut("bytes", "spans").alias("cut"))
    fields = [F.decode("cut.kept", "UTF-8").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in kept]
    return out.select(*fields, F.col("cut.n_lines").alias("n_lines"), F.col("cut.n_removed").alias("n_removed"))
