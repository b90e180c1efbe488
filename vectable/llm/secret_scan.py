"""Secrets in texts, in DataFrame functions only: certain ones by pattern, weak ones by their company.

Certain kinds (assign, access, hex) stand for themselves. A weak part is reported only within a scope
of ``SCOPE`` characters around complementary parts: a bare token beside an identifier or an endpoint, an
identifier beside a secret, an endpoint beside both. Parts are linked by an interval join: scopes cut a text
into strips, each strip keeps the first and last place of each role, and a part looks into its own strip and the two next to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from vectable.llm.common import as_text
from vectable.sources.tables import settle

SCOPE = 200
PIECE = 256  # matches folded at once
TOUCHES = 10_000  # pairs of a weak and a certain part that are compared within a row

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# kind: pattern, group to measure, least length of it
CERTAIN = {
    "assign": (rf"(?i)(password|passwd|secret|token|api_?key){_VALUE}([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
WEAK = {
    "ident": (rf"(?i)(?<![a-z0-9_])(user(?:_?name)?|login|account|client_?id|access_?key_?id){_VALUE}([A-Za-z0-9@+/_.=-]+)", 2, 3),
    "bare": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
    "endpoint": (r"(?i)(?<![a-z0-9])[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20\"'<>]+", 0, 8),
}
KINDS = [*CERTAIN, *WEAK]
ROLE = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "bare": "secret", "endpoint": "endpoint"}
ROLES = ("ident", "secret", "endpoint")

SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of a kind in code points, from the lengths of the matches and of what lies between them."""
    # Only runs that are long enough count, so shorter ones need not be matched one by one.
    pattern = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}.get(kind, pattern)

    def lengths(parts: Column) -> Column:
        return F.transform(parts, lambda part: F.length(part))

    whole = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    measured = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))) if group else whole
    rows = F.arrays_zip(lengths(F.slice(F.split(text, pattern), 1, F.size(whole))).alias("gap"), whole.alias("size"), measured.alias("part"))

    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + row["size"]).alias("end"))
        kept = F.when(row["part"] >= least, F.array(span)).otherwise(none)
        return F.struct((start + row["size"]).alias("at"), F.concat(state["out"], kept).alias("out"))

    return F.when(text.rlike(pattern), _bound(rows, lambda r: F.when(F.size(r) > 0, _places(r, step, none)).otherwise(none))).otherwise(none)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: a list of one stands for a variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _places(rows: Column, step: Callable, none: Column) -> Column:
    """The spans of all matches. A fold that appends copies what it has, so it runs over pieces of the list, each starting at
    the place where the one before it ends: matches x PIECE steps instead of their square."""

    def fold(part: Column, at: Column) -> Column:
        return F.aggregate(part, F.struct(at.alias("at"), none.alias("out")), step)["out"]

    def width(piece: Column) -> Column:
        return F.aggregate(piece, F.lit(0), lambda total, row: total + row["gap"] + row["size"])

    def pieced(pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        ends = F.aggregate(F.transform(pieces, width), start, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))
        each = F.arrays_zip(pieces.alias("rows"), ends["out"].alias("at"))
        return F.flatten(F.transform(each, lambda p: fold(p["rows"], p["at"])))

    last = F.ceil(F.size(rows) / PIECE).cast("int") - 1
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(rows, i * PIECE + 1, F.lit(PIECE)))
    return F.when(F.size(rows) <= PIECE, fold(rows, F.lit(0))).otherwise(_bound(cut, pieced))


def _all(text: Column, kinds: dict) -> Column:
    return F.concat(*[_spans(text, kind, *rule) for kind, rule in kinds.items()])


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """key, twin, linked: the weak spans of each text whose complementary parts lie within the scope."""
    parts = found.select("key", "twin", F.explode(F.concat("certain", "weak")).alias("s")).distinct().select("key", "twin", "s.*")
    own = F.col("kind") < len(CERTAIN)
    ahead, behind = (Window.partitionBy("key", "twin").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc("start"), F.desc("start")))
    touched = (F.max(F.when(own, F.col("end"))).over(ahead) > F.col("start")) | (F.min(F.when(own, F.col("start"))).over(behind) < F.col("end"))
    parts = parts.withColumn("touched", F.coalesce(touched, F.lit(False))).filter(own | ~F.col("touched")).drop("touched")
    parts = parts.withColumn("strip", F.floor(F.col("start") / scope).cast("int"))
    kind = F.get(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind"))
    places = [f(F.when(kind == role, F.col("start"))).alias(f"{f.__name__}_{role}") for role in ROLES for f in (F.min, F.max)]
    strips = parts.groupBy(F.col("key").alias("k"), F.col("twin").alias("t"), F.col("strip").alias("there")).agg(*places)
    weak = parts.filter(F.col("kind") >= len(CERTAIN)).withColumn("look", F.explode(F.array(*[F.col("strip") + i for i in (-1, 0, 1)])))
    joined = weak.join(strips, F.col("key").eqNullSafe(F.col("k")) & (F.col("twin") == F.col("t")) & (F.col("look") == F.col("there")))

    def near(role: str) -> Column:
        before, after = F.col(f"max_{role}"), F.col(f"min_{role}")
        here = F.when(F.col("look") < F.col("strip"), before >= F.col("start") - scope)
        here = here.when(F.col("look") > F.col("strip"), after <= F.col("start") + scope).otherwise(before.isNotNull())
        return F.max(F.coalesce(here, F.lit(False))).alias(role)

    company = joined.groupBy("key", "twin", "start", "kind", "end").agg(*map(near, ROLES))
    rule = {"ident": F.col("secret"), "bare": F.col("ident") | F.col("endpoint"), "endpoint": F.col("secret") & F.col("ident")}
    whole = F.lit(False)
    for name, holds in rule.items():
        whole = whole | ((F.col("kind") == KINDS.index(name)) & holds)
    span = F.struct("start", "kind", "end")
    return company.filter(whole).groupBy(F.col("key").alias("k"), F.col("twin").alias("t")).agg(F.collect_list(span).alias("linked"))


def scan_secrets(docs: DataFrame, *, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: key, n_assign, n_access, n_hex, certain and spans: kind:start:end by start, then kind.

    Places are code points, end exclusive. certain lists the certain kinds, spans adds the linked weak
    ones; a weak part that touches a certain one is none. One row per input row, repeated and
    NULL keys included; a NULL or empty text has no spans. An empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), as_text(text).alias("text"))
    found = rows.select("key", F.xxhash64("text").alias("twin"), _all(F.col("text"), CERTAIN).alias("certain"), _all(F.col("text"), WEAK).alias("weak"))
    touching: Callable = lambda w: lambda c: (c["start"] < w["end"]) & (w["start"] < c["end"])
    apart = F.filter("weak", lambda w: ~F.exists("certain", touching(w)))  # of texts with few; others are told apart where parts are rows
    few = F.size("weak").cast("bigint") * F.size("certain") <= TOUCHES
    found = settle(found.withColumn("weak", F.when(few, apart).otherwise(F.col("weak"))))
    linked = _linked(found.filter(F.size("weak") > 0), scope)
    joined = found.join(linked, F.col("key").eqNullSafe(F.col("k")) & (F.col("twin") == F.col("t")), "left")

    def count(kind: str) -> Column:
        return F.size(F.filter("certain", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    both = F.concat("certain", F.coalesce("linked", F.array().cast(f"array<{SPAN}>")))
    return joined.select(F.col("key").alias(key), *map(count, CERTAIN), _listed(F.col("certain")).alias("certain"), _listed(both).alias("spans"))
