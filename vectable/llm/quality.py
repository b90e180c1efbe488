"""Quality rules: counts of each text, and its divergence from references of its language.

A reference holds two distributions, counted over all texts of a language: character classes, and
the language's common words (those with at least ``COMMON_SHARE`` of its words, so 1 / COMMON_SHARE at
most) with everything else as one more outcome. A text is compared by Jensen-Shannon distance (base
2, 0 to 1) once it is long enough for its histogram to mean something.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vectable.llm.common import as_bytes, values
from vectable.sources.tables import settle, small_side

COMMON_SHARE = 0.002
LANGUAGE_SHARE = 0.001
ENTRIES_HELD = 300_000

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
# Character classes by first byte of a character; continuation bytes belong to none.
CLASSES = ("lower", "upper", "digit", "blank", "stop", "symbol", "control", "beyond")


def _class_of(byte: int) -> int | None:
    char = bytes([byte])
    if byte >= 0x80:
        return 7 if byte >= 0xC0 else None
    if char.islower() or char.isupper() or char.isdigit():
        return 0 if char.islower() else 1 if char.isupper() else 2
    if char in BLANKS:
        return 3
    if byte < 0x20 or byte == 0x7F:
        return 6
    return 4 if char in b".,;:!?'\"()-" else 5


_TO_CLASS = np.zeros((256, len(CLASSES)))
for _byte in range(256):
    if _class_of(_byte) is not None:
        _TO_CLASS[_byte, _class_of(_byte)] = 1


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _TO_CLASS


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms with positive sums."""
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / middle), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


@dataclass(frozen=True)
class Limits:
    """A text is judged by a distance only from ``min_chars`` characters or ``min_words`` words on."""

    class_distance: float = 0.3
    word_distance: float = 0.65
    min_chars: int = 400
    min_words: int = 100


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[bytes, int] = field(default_factory=dict)
    shares: np.ndarray = field(default_factory=lambda: np.zeros(1))


def language_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, word, n over all texts. A NULL word counts all words of a language; ``#class`` words,
    marked by ``of_class``, count characters. Words have A-Z in lower case. Tasks add up what they
    read before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict = defaultdict(Counter)
        classes: dict = defaultdict(lambda: np.zeros(len(CLASSES)))

        def rows() -> pa.RecordBatch:
            out = [(k, w, None, n) for k, seen in words.items() for w, n in seen.items()]
            out += [(k, None, None, sum(seen.values())) for k, seen in words.items()]
            out += [(k, None, c, int(n)) for k, found in classes.items() for c, n in enumerate(found)]
            kinds = (pa.string(), pa.binary(), pa.int32(), pa.int64())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out) if out else [[]] * 4, kinds)]
            words.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "of_class", "n"])

        for batch in batches:
            for value, name in zip(values(batch.column(0)), values(batch.column(1))):
                words[name].update(value.lower().split())
                classes[name] += class_counts(value)
                if sum(map(len, words.values())) > ENTRIES_HELD:
                    yield rows()
        yield rows()

    rows = docs.select(as_bytes(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counted = rows.mapInArrow(count, "lang string, word binary, of_class int, n bigint")
    return counted.groupBy("lang", "word", "of_class").agg(F.sum("n").alias("n"))


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str | None, Reference]:
    """References by language, from all texts. A language
    with under ``LANGUAGE_SHARE`` of all words is in ``rare_references``. What comes to the driver is bounded: at
    most 1 / LANGUAGE_SHARE languages with at most 1 / COMMON_SHARE words each."""
    return _frequent_references(settle(language_counts(docs, text, lang)))


TOTAL = "word IS NULL AND of_class IS NULL"


def _bounds(counts: DataFrame) -> tuple[int, float]:
    """All words, and how many of them a language needs to be frequent."""
    whole = counts.filter(TOTAL).agg(F.sum("n")).first()[0] or 0
    return whole, max(1, LANGUAGE_SHARE * whole)


def _frequent_references(counts: DataFrame) -> dict[str | None, Reference]:
    _, least = _bounds(counts)
    listed = [(r["lang"], r["n"]) for r in counts.filter(TOTAL).filter(F.col("n") >= least).collect()]
    names = F.broadcast(counts.sparkSession.createDataFrame(listed, "name string, total bigint"))
    common = F.col("word").isNull() | (F.col("n") >= COMMON_SHARE * F.col("total"))
    own = counts.join(names, F.col("lang").eqNullSafe(F.col("name"))).filter(common)
    return _references(own.select("lang", "word", "of_class", "n").collect())


def rare_references(counts: DataFrame) -> DataFrame:
    """name (of a language), entries (word, of_class, n) of each language that has no frequent reference, from the counts of
    ``language_counts``. A language with under 1 / COMMON_SHARE words, where any word is common, has none."""
    _, least = _bounds(counts)
    names = counts.filter(TOTAL).filter((F.col("n") < least) & (F.col("n") >= 1 / COMMON_SHARE)).select(F.col("lang").alias("name"), F.col("n").alias("total"))
    own = counts.join(names, F.col("lang").eqNullSafe(F.col("name")))
    own = own.filter(F.col("word").isNull() | (F.col("n") >= COMMON_SHARE * F.col("total")))
    return own.groupBy("name").agg(F.collect_list(F.struct("word", "of_class", "n")).alias("entries"))


def _references(rows: list) -> dict[str | None, Reference]:
    found: dict = defaultdict(lambda: ({}, np.zeros(len(CLASSES)), []))
    for lang, word, of_class, n in rows:
        words, classes, total = found[lang]
        if word is not None:
            words[bytes(word)] = n
        elif of_class is not None:
            classes[of_class] = n
        else:
            total.append(n)
    out = {}
    for lang, (words, classes, total) in found.items():
        if total and total[0]:
            shares = np.array([*words.values(), total[0] - sum(words.values())], float)
            out[lang] = Reference(classes, {w: i for i, w in enumerate(words)}, shares)
    return out


def word_distance(words: list[bytes], reference: Reference) -> float:
    seen = Counter(filter(reference.words.__contains__, words))
    found = np.zeros(len(reference.shares))
    for word, n in seen.items():
        found[reference.words[word]] = n
    found[-1] = len(words) - found.sum()
    return js_distance(found, reference.shares)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    again = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


FIELDS = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("class_distance", pa.float64()), ("word_distance", pa.float64()),
])
FIELDS_DDL = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "class_distance:double,word_distance:double>"
)


def measured(text: bytes, reference: Reference | None, limits: Limits) -> dict:
    words = text.split()
    chars = len(text.decode())
    judged = reference is not None
    return {
        "n_words": len(words),
        "word_chars": chars - sum(map(text.count, (BLANKS[i : i + 1] for i in range(len(BLANKS))))),
        "n_symbols": sum(map(text.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))),
        "n_dup_lines": repeated_lines(text),
        "n_repeat_words": repeated_words(words),
        "class_distance": js_distance(class_counts(text), reference.classes) if judged and chars >= limits.min_chars else None,
        "word_distance": word_distance(text.lower().split(), reference) if judged and len(words) >= limits.min_words else None,
    }


def measure(references: dict, limits: Limits, spark) -> Callable[[Column, Column, Column], Column]:
    """Column function of (text bytes, language, entries of a rare language): the counts and distances of a text."""
    shared = spark.sparkContext.broadcast(references)

    @F.arrow_udf(FIELDS_DDL)
    def measures(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known, rare = shared.value, {}

        def reference(name: str | None, entries: list | None) -> Reference | None:
            if entries is None:
                return known.get(name)
            if name not in rare:
                if len(rare) >= 1 / LANGUAGE_SHARE:
                    rare.clear()
                rare[name] = _references([(name, e["word"], e["of_class"], e["n"]) for e in entries]).get(name)
            return rare[name]

        for texts, langs, entries in batches:
            rows = zip(values(texts), values(langs), values(entries))
            yield pa.array([measured(t, reference(k, e), limits) for t, k, e in rows], FIELDS)

    return measures


def quality(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    references: dict | None = None, limits: Limits = Limits(),
) -> DataFrame:
    """Per row of ``docs``: key, counts, class_distance, word_distance (NULL under the guards), base_failed, kept.

    base_failed: under 50 words, or over half of them in repeated three-word windows. kept: neither
    that nor a distance beyond its limit. One row per input row, repeated and NULL keys included; a
    NULL or empty text has no words and fails; a NULL language is a language of its own. An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    rows, found, passes = _judged(docs, text, lang, references, limits)
    out = rows.select(F.col(key), found.alias("__m")).select(key, "__m.*")
    return out.withColumn("base_failed", passes[0]).withColumn("kept", passes[1])


def _judged(
    docs: DataFrame, text: str, lang: str, references: dict | None, limits: Limits
) -> tuple[DataFrame, Column, tuple[Column, Column]]:
    """``docs`` beside what measures them, the measures of a row, and (base_failed, kept) in terms of their fields."""
    entries, rows = F.lit(None).cast("array<struct<word:binary,of_class:int,n:bigint>>"), docs
    if references is None:
        counts = settle(language_counts(docs, text, lang))
        # The same rule however a reference is made: with under 1 / COMMON_SHARE words, where any word is common, there is none.
        references = {k: r for k, r in _frequent_references(counts).items() if r.shares.sum() >= 1 / COMMON_SHARE}
        rare = settle(rare_references(counts).select(F.col("name").alias("__name"), F.col("entries").alias("__entries")))
        if not rare.isEmpty():
            rows = docs.join(small_side(rare), F.col(lang).cast("string").eqNullSafe(F.col("__name")), "left")
            entries = F.col("__entries")
    found = measure(references, limits, docs.sparkSession)(as_bytes(text), F.col(lang).cast("string"), entries)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = [F.coalesce(F.col(f"{kind}_distance") <= getattr(limits, f"{kind}_distance"), F.lit(True)) for kind in ("class", "word")]
    return rows, found, (failed, ~failed & near[0] & near[1])


def keep_good(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", references: dict | None = None, limits: Limits = Limits()
) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their columns as they are."""
    judged, found, (_, kept) = _judged(docs, text, lang, references, limits)
    # The row goes along in one struct, so no column of the measures can clash with one of its own.
    rows = judged.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), found.alias("__m")).select("__row", "__m.*")
    return rows.filter(kept).select("__row.*")
