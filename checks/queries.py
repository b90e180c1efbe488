"""One Spark query per operator, over the whole given tables. ``checks.oracle`` has the SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vectable.functions.embedders import counts_of
from vectable.functions.predicates import where
from vectable.functions.vectors import cosine, inner_product, l2_distance
from vectable.operators import approx, delete, fetch, hamming_index, ingest, pruned, refine, search, validate
from vectable.operators.mmr import mmr
from vectable.plans import ingest as ingest_plan
from vectable.plans.retrieve import retrieve, topk_by_text
from vectable.sources import buckets
from vectable.sources.tables import checkpoint_dir, corpus_scan, semi_filter, settle
from vectable.table import VectorTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

letter_model = counts_of("e", "t")
shape_model = counts_of(" ", "[A-Z]", "[0-9]")

DOCS = VectorTable(dims=2)
SPACED = VectorTable(dims=2, namespace="namespace")
VECTORS = VectorTable(id="vec_id", dims=64)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


# ---- inputs ---------------------------------------------------------------------------------------


def read(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return corpus_scan(spark, f"{sf}/{name}.parquet", columns or None)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with struct metadata; quality and toxic are missing where no label exists."""
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("namespace"),
        "text",
        F.struct("lang", "n_chars", "quality", "toxic").alias("metadata"),
    )


def letter_vector(text: str = "text") -> Column:
    """What ``letter_model`` gives, in Spark."""
    counts = [F.length(text) - F.length(F.replace(F.col(text), F.lit(letter), F.lit(""))) for letter in "et"]
    return F.array(*[n.cast("float") for n in counts])


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The current table of the write checks: a ``note`` column no batch knows."""
    return documents(spark, sf).select(
        "id", "namespace", "text", letter_vector().alias("embedding"),
        F.struct("metadata.lang", "metadata.n_chars").alias("metadata"),
        F.concat(F.lit("note "), "namespace").alias("note"),
    )


def batch(spark: SparkSession, sf: str) -> DataFrame:
    """Changed versions of the labelled documents, and all conversations as new documents."""
    changed = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("namespace"),
        F.concat(F.lit("v2 "), "text").alias("text"),
        F.struct(F.lit("xx").alias("lang"), F.col("quality").cast("bigint").alias("n_chars")).alias("metadata"),
    )
    return with_vector(changed.unionByName(conversations(spark, sf)))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"),
        F.col("role").alias("namespace"),
        "text",
        F.struct(F.lit("en").alias("lang"), F.col("turn").alias("n_chars")).alias("metadata"),
    )


def with_vector(df: DataFrame) -> DataFrame:
    return df.withColumn("embedding", letter_vector())


def flat(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "namespace", F.md5("text").alias("text_md5"), F.col("embedding")[0].cast("double").alias("emb0"),
        F.col("metadata.lang").alias("lang"), F.col("metadata.n_chars").alias("n_chars"), "note",
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "embeddings").select("vec_id", "embedding", "label", F.struct("label").alias("metadata"))


def all_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as a query."""
    return read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), F.col("label")
    )


def mean_vector(spark: SparkSession, sf: str) -> list[float]:
    """One query: the mean of all vectors, computed by Spark; 64 numbers come back."""
    each = read(spark, sf, "embeddings").select(F.posexplode("embedding").alias("at", "x"))
    rows = each.groupBy("at").agg(F.avg(F.col("x").cast("double")).alias("m")).orderBy("at").collect()
    return [row["m"] for row in rows]


def label_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Given centroids: the mean vector of each label."""
    each = read(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = each.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    gathered = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "m"))).alias("ms"))
    return gathered.select(F.col("label").alias("list_id"), F.col("ms.m").alias("centroid"))


def hits(df: DataFrame) -> DataFrame:
    return df.select("query_id", "rank", F.col("id").alias("vec_id"), r6("score").alias("score"))


def marked(deleted: delete.Deleted) -> DataFrame:
    """Both halves of a delete, flagged."""
    kept = deleted.kept.select("id", F.lit(False).alias("deleted"))
    return kept.unionByName(deleted.gone.select("id", F.lit(True).alias("deleted")))


def labelled_ids(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("wanted"))


# ---- scans and writes -----------------------------------------------------------------------------


@query
def corpus_scan_query(spark, sf):
    return read(spark, sf, "documents", "doc_id", "lang", "n_chars")


@query
def embed_corpus(spark, sf):
    docs = read(spark, sf, "documents", "doc_id", "text")
    out = ingest.embed_corpus(docs, VectorTable(id="doc_id", dims=2), letter_model)
    return out.select("doc_id", *[F.col("embedding")[i].cast("double").alias(f"emb{i}") for i in range(2)])


@query
def embed_corpus_shapes(spark, sf):
    docs = read(spark, sf, "documents", "doc_id", "text")
    out = ingest.embed_corpus(docs, VectorTable(id="doc_id", dims=3), shape_model)
    cells = [F.col("embedding")[i].cast("double").alias(f"emb{i}") for i in range(3)]
    return out.select("doc_id", *cells)


def _appended(spark, sf):
    rows = with_vector(conversations(spark, sf))
    blank = F.when(F.col("namespace") == "assistant", F.lit(" ")).otherwise(F.col("id"))
    return ingest.append_documents(stored(spark, sf), rows.withColumn("id", blank), DOCS)


@query
def append_documents(spark, sf):
    given = F.when(F.col("namespace") == "assistant", F.lit("generated")).otherwise(F.col("id"))
    return flat(_appended(spark, sf)).withColumn("id", given)


@query
def append_generated_ids(spark, sf):
    out = _appended(spark, sf)
    return out.groupBy("namespace").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count_if(F.col("id").isNull() | (F.trim("id") == "")).alias("blank_ids"),
    )


@query
def upsert_replace(spark, sf):
    return flat(ingest.upsert_replace(stored(spark, sf), batch(spark, sf), DOCS))


@query
def upsert_merge(spark, sf):
    return flat(ingest.upsert_merge(stored(spark, sf), batch(spark, sf), DOCS))


@query
def upsert_merge_reordered(spark, sf):
    """The batch has the metadata fields in another order."""
    turned = batch(spark, sf).withColumn("metadata", F.struct("metadata.n_chars", "metadata.lang"))
    return flat(ingest.upsert_merge(stored(spark, sf), turned, DOCS))


@query
def upsert_merge_new_field(spark, sf):
    """The batch has a metadata field that the table does not have, and lacks one."""
    other = batch(spark, sf).withColumn("metadata", F.struct(F.lit("new").alias("extra"), "metadata.lang"))
    out = ingest.upsert_merge(stored(spark, sf), other, DOCS)
    return out.select("id", F.col("metadata.lang").alias("lang"), F.col("metadata.n_chars").alias("n_chars"), F.col("metadata.extra").alias("extra"))


@query
def ingest_without_metadata(spark, sf):
    """New texts with nothing but an id, some given twice with the same text."""
    turns = read(spark, sf, "conversations").select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"), "text")
    return flat(ingest_plan.ingest(stored(spark, sf), turns.union(turns), DOCS, model=letter_model).table)


@query
def ingest_mixed(spark, sf):
    """A merge in which some rows bring a text and others a vector only."""
    docs = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang"), "text")
    one = F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")
    mixed = docs.filter("lang IN ('de', 'fr')").select(
        "id", F.when(F.col("lang") == "de", F.concat(F.lit("v2 "), "text")).alias("text"), F.when(F.col("lang") == "fr", one).alias("embedding")
    )
    return flat(ingest_plan.ingest(stored(spark, sf), mixed, DOCS, model=letter_model, merge=True).table)


@query
def upsert_embedding_only(spark, sf):
    return flat(ingest.upsert_embeddings(stored(spark, sf), batch(spark, sf), DOCS))


@query
def upsert_namespaced(spark, sf):
    moved = batch(spark, sf).withColumn(
        "namespace", F.when(F.col("metadata.n_chars") == 0, F.lit("elsewhere")).otherwise(F.col("namespace"))
    )
    return flat(ingest.upsert_merge(stored(spark, sf), moved, SPACED))


def versions(spark, sf):
    """Documents with a version and a delete mark; labelled ones are new in version 3, toxic ones deleted in version 4."""
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.lit("docs").alias("namespace"), "text", F.lit(1).alias("version"), F.lit(False).alias("gone"))
    labelled = rows.join(labels.select(F.col("doc_id").cast("string").alias("id"), "toxic"), "id")

    def at(df: DataFrame, version: int, gone: bool = False) -> DataFrame:
        return df.select("id", "namespace", F.concat(F.lit(f"v{version} "), "text").alias("text"), F.lit(version).alias("version"), F.lit(gone).alias("gone"))

    return rows, at(labelled, 3), at(rows, 2), at(labelled.filter("toxic = 1"), 4, True), at(rows, 0, True)


@query
def upsert_versioned(spark, sf):
    """Batches out of order: the newest version of a key wins, a late older one or an old delete changes nothing."""
    table, *batches = versions(spark, sf)
    for late in batches:
        table = settle(ingest.upsert_versioned(table, late, DOCS, "version", mark="gone"))
    return ingest.live(table, "gone").select("id", "version", F.md5("text").alias("text_md5"))


def bucketed(spark, rows: DataFrame, count: int = 8) -> buckets.BucketTable:
    return buckets.BucketTable.create(rows, f"{checkpoint_dir(spark)}/settled-{uuid.uuid4().hex}", DOCS, count)


@query
def upsert_buckets(spark, sf):
    table = bucketed(spark, stored(spark, sf))
    table.upsert(batch(spark, sf), merge=True)
    return flat(table.read())


@query
def delete_buckets(spark, sf):
    """Deletes by id, by filter and in a namespace, one after the other, in a table in buckets."""
    table = bucketed(spark, documents(spark, sf))
    gone = [table.delete_by_ids(labelled_ids(spark, sf)), table.delete_by_filter({"lang": "de"})]
    spaced = buckets.BucketTable(spark, table.path, DOCS)
    gone.append(spaced.delete_by_filter(F.col("namespace") == "src2"))
    return table.read().select("id", "namespace", F.md5("text").alias("text_md5"), *[F.lit(n).cast("bigint").alias(f"gone{i}") for i, n in enumerate(gone)])


@query
def dedupe_before_embed(spark, sf):
    known = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id", "left_semi")
    out = ingest.drop_known(
        read(spark, sf, "documents"), known, on="text", duplicate=F.col("lang") == "de"
    )
    out = ingest.embed_corpus(out, VectorTable(id="doc_id", dims=2), letter_model)
    return out.select("doc_id", F.col("embedding")[0].cast("double").alias("emb0"))


@query
def latest_per_id(spark, sf):
    turns = read(spark, sf, "conversations").withColumn("id", F.col("conv_id").cast("string"))
    out = ingest.latest_per_id(turns, DOCS, "turn")
    return out.select("id", "turn", "role", F.md5("text").alias("text_md5"))


def damaged(spark, sf):
    """Vectors spoiled by label, so that each kind of reject occurs."""
    x, label = F.col("embedding"), F.col("label")

    def put(value: float | None) -> Column:
        spoiled = F.lit(value).cast("float")
        return F.concat(F.slice(x, 1, 10), F.array(spoiled), F.slice(x, 12, 53))

    bad = (
        F.when(label == 0, F.slice(x, 1, 63)).when(label == 1, F.lit(None)).when(label == 2, put(float("nan")))
        .when(label == 3, put(float("inf"))).when(label == 4, put(float("-inf"))).when(label == 5, put(None))
    )
    return read(spark, sf, "embeddings").withColumn("embedding", bad.otherwise(F.when(label > 5, x)))


@query
def validate_vectors(spark, sf):
    out = validate.validate_vectors(damaged(spark, sf), VECTORS)
    return out.valid.select("vec_id", F.lit("ok").alias("reason")).unionByName(out.rejects)


@query
def validate_rows(spark, sf):
    docs = documents(spark, sf)
    spoiled = docs.select(
        F.when(F.col("metadata.lang") == "de", F.lit("  ")).otherwise(F.col("id")).alias("id"),
        F.when(F.col("metadata.lang") != "fr", F.col("text")).alias("text"),
        F.when(F.col("metadata.quality").isNotNull(), F.col("metadata")).alias("metadata"),
    )
    out = validate.validate_rows(spoiled, DOCS)
    return out.valid.select("id", F.lit("ok").alias("reason")).unionByName(out.rejects)


@query
def ingest_batch(spark, sf):
    """All steps at once: known texts dropped, embedded, checked, newest per id, merged."""
    turns = read(spark, sf, "conversations").select(
        F.concat(F.lit("c-"), "conv_id").alias("id"), F.col("role").alias("namespace"),
        F.when(F.col("role") != "system", F.col("text")).alias("text"),
        F.struct(F.lit("en").alias("lang"), F.col("turn").alias("n_chars")).alias("metadata"), F.col("turn").alias("ord"),
    )
    again = stored(spark, sf).select("id", "namespace", "text", "metadata", F.lit(0).cast("bigint").alias("ord"))
    changed = again.filter("metadata.lang = 'fr'").withColumn("text", F.concat("text", F.lit(" v2")))
    out = ingest_plan.ingest(
        stored(spark, sf), again.unionByName(changed).unionByName(turns), DOCS, model=letter_model, skip_known=True,
        order="ord", merge=True,
    )
    return flat(out.table)


# ---- deletes --------------------------------------------------------------------------------------


@query
def delete_by_ids(spark, sf):
    return marked(delete.delete_by_ids(documents(spark, sf), labelled_ids(spark, sf), DOCS))


@query
def delete_by_filter(spark, sf):
    return marked(delete.delete_by_filter(documents(spark, sf), {"toxic": 1}, DOCS))


@query
def delete_in_namespace(spark, sf):
    out = delete.delete_in_namespace(
        documents(spark, sf), labelled_ids(spark, sf), SPACED, namespace="src1", condition={"lang": "en"}
    )
    return marked(out)


@query
def delete_all_namespace(spark, sf):
    return marked(delete.delete_all(documents(spark, sf), SPACED, namespace="src2"))


@query
def delete_counts(spark, sf):
    out = delete.delete_by_filter(documents(spark, sf), {"lang": "en", "quality": {"$gte": 1}}, SPACED)
    return delete.delete_counts(out.gone, SPACED)


# ---- fetches and projections ----------------------------------------------------------------------


@query
def get_by_ids(spark, sf):
    found = fetch.get_by_ids(documents(spark, sf), labelled_ids(spark, sf), DOCS)
    return found.select("id", F.md5("text").alias("text_md5"))


@query
def filtered_fetch(spark, sf):
    out = fetch.filtered_fetch(
        documents(spark, sf), {"lang": "en"}, DOCS, 20, order=[("namespace", True), ("metadata.n_chars", False)], skip=10
    )
    return out.select("id", "namespace", "metadata.n_chars")


@query
def filtered_fetch_deep(spark, sf):
    """The way taken for pages too deep for a top-k; the page is the second half of the matches."""
    rows = documents(spark, sf)
    matches = where(rows, DOCS, {"lang": "en"}).count()
    out = fetch.filtered_fetch(
        rows, {"lang": "en"}, DOCS, matches, order=[("metadata.n_chars", False)], skip=matches // 2, deep=0
    )
    return out.select("id", "namespace", "metadata.n_chars")


@query
def to_documents(spark, sf):
    rows = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"), "text", letter_vector().alias("embedding"),
        F.when(F.col("quality").isNotNull(), F.struct("quality", F.lit("old").alias("source"))).alias("metadata"),
        "source", "lang", F.lit("x").alias("__internal"),
    )
    out = fetch.to_documents(rows, VectorTable(internal=("__internal",)))
    return out.select(
        "id", F.md5("text").alias("text_md5"), *[F.col(f"metadata.{n}").alias(n) for n in ("quality", "source", "lang")]
    )


def _dynamic(spark, sf, metadata: Column) -> DataFrame:
    """Documents with schemaless metadata beside a new column and one that is a metadata field already."""
    docs = documents(spark, sf)
    return docs.select("id", "text", metadata.alias("metadata"), F.col("namespace").alias("shelf"), F.upper("metadata.lang").alias("lang"))


def _folded(out: DataFrame, field: Callable[[str, str], Column]) -> DataFrame:
    return out.select("id", F.md5("text").alias("text_md5"), field("lang", "string").alias("lang"), field("shelf", "string").alias("shelf"),
                      field("quality", "int").alias("quality"), field("n_chars", "bigint").alias("n_chars"))


@query
def to_documents_json(spark, sf):
    """Metadata as JSON text: columns are folded into it and win."""
    out = fetch.to_documents(_dynamic(spark, sf, F.to_json("metadata")), DOCS)
    return _folded(out, lambda name, kind: F.get_json_object("metadata", f"$.{name}").cast(kind))


@query
def to_documents_variant(spark, sf):
    out = fetch.to_documents(_dynamic(spark, sf, F.parse_json(F.to_json("metadata"))), DOCS)
    return _folded(out, lambda name, kind: F.try_variant_get("metadata", f"$.{name}", kind))


@query
def nested_paths(spark, sf):
    rows = read(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.struct(F.col("text").alias("words"), letter_vector().alias("point")).alias("body"),
        F.struct(F.col("lang").alias("tongue")).alias("facts"),
        F.col("source").alias("shelf"),
    )
    rows = fetch.set_path(rows, "facts.size.chars", F.length(fetch.get_path(rows, "body.words")))
    rows = fetch.set_path(rows, "text_md5", F.md5(fetch.get_path(rows, "body.words")))
    for path in ("body.point", "body.words", "facts.tongue"):
        rows = fetch.remove_path(rows, path)
    return rows.select("id", "shelf", "text_md5", "facts.size.chars")


NAMES = {"number": "doc_id", "words": "text", "tongue": "lang", "size": "n_chars"}


@query
def storage_rename(spark, sf):
    records = fetch.from_storage(read(spark, sf, "documents"), NAMES)
    chosen = records.filter((F.col("size") > 500) & (F.col("tongue") != "en"))
    return chosen.select("number", "tongue", "size", F.md5("words").alias("words_md5"))


@query
def to_storage(spark, sf):
    """Properties back to storage names; a property without one is left out."""
    records = fetch.from_storage(read(spark, sf, "documents"), NAMES).withColumn("scratch", F.lit(1))
    return fetch.to_storage(records, {"number": "_id", "tongue": "language", "size": "length"})


@query
def fetch_without_vectors(spark, sf):
    return fetch.without_vectors(read(spark, sf, "embeddings"))


# ---- filters --------------------------------------------------------------------------------------

FILTERS = {
    "filter_eq": {"lang": "en"},
    "filter_ne": {"quality": {"$ne": 1}},
    "filter_gt": {"n_chars": {"$gt": 1000}},
    "filter_gte": {"metadata.quality": {"$gte": 1}},
    "filter_lt": {"n_chars": {"$lt": 1000}},
    "filter_lte": {"toxic": {"$lte": 0}},
    "filter_in": {"lang": {"$in": ["de", "fr"]}},
    "filter_nin": {"quality": {"$nin": [0, 2]}},
    "filter_contains": {"lang": {"$contains": "e"}},
    "filter_and": {"lang": "en", "n_chars": {"$gte": 200, "$lt": 3000}, "$and": [{"quality": 1}]},
    "filter_or": {"$or": [{"quality": 0}, {"lang": "es"}]},
    "filter_not": {"toxic": {"$not": {"$gte": 1}}},
    "filter_nor": {"$nor": [{"toxic": 0}, {"lang": "en"}]},
    "filter_null": {"quality": None},
}


def _filter_query(condition: dict) -> Query:
    def run(spark, sf):
        return where(documents(spark, sf), DOCS, condition).select("id", "namespace")

    return run


for _name, _condition in FILTERS.items():
    QUERIES[_name] = _filter_query(_condition)


@query
def filter_namespace(spark, sf):
    rows = search.scope_to(documents(spark, sf), SPACED, "src1")
    return where(rows, SPACED, {"quality": {"$ne": 0}}).select("id", "namespace")


@query
def filter_dynamic(spark, sf):
    """Metadata without a schema: JSON read as VARIANT."""
    rows = read(spark, sf, "events").select("event_id", "event_type", F.try_parse_json("props").alias("metadata"))
    table = VectorTable(id="event_id")
    return where(rows, table, {"k": {"$gte": 50, "$ne": 75}}).select("event_id", "event_type")


@query
def filter_json_string(spark, sf):
    """Metadata as JSON text."""
    rows = read(spark, sf, "events").select("event_id", "event_type", F.col("props").alias("metadata"))
    return where(rows, VectorTable(id="event_id"), {"k": {"$gte": 50, "$ne": 75}}).select("event_id", "event_type")


@query
def delete_by_filter_json(spark, sf):
    rows = read(spark, sf, "events").select("event_id", F.col("props").alias("metadata"))
    out = delete.delete_by_filter(rows, {"k": {"$ne": 75}}, VectorTable(id="event_id"))
    return out.kept.select("event_id")


@query
def filter_in_table(spark, sf):
    toxic = read(spark, sf, "labels").filter("toxic = 1")
    listed = read(spark, sf, "documents").join(toxic, "doc_id", "left_semi").select("source")
    return semi_filter(documents(spark, sf), "namespace", listed).select("id", "namespace")


# ---- scores and exact search ----------------------------------------------------------------------


def _pair_scores(name: str, score: Callable[[Column, Column], Column]) -> Query:
    def run(spark, sf):
        """Every vector against the mean of its label."""
        means = label_centroids(spark, sf).withColumnRenamed("list_id", "label")
        joined = read(spark, sf, "embeddings").join(means, "label")
        return joined.select("vec_id", r6(score(F.col("embedding"), F.col("centroid"))).alias(name))

    return run


QUERIES["score_cosine"] = _pair_scores("score", cosine)
QUERIES["score_l2"] = _pair_scores("distance", l2_distance)
QUERIES["score_ip"] = _pair_scores("score", inner_product)


@query
def score_all(spark, sf):
    """One query vector against every row."""
    out = search.scored(vectors(spark, sf), mean_vector(spark, sf), VECTORS, metric="L2")
    return out.select("vec_id", r6("score").alias("score"), r6("distance").alias("distance"))


def _topk(metric: str) -> Query:
    def run(spark, sf):
        out = search.topk(vectors(spark, sf), mean_vector(spark, sf), VECTORS, 10, metric=metric)
        return out.select("rank", F.col("id").alias("vec_id"), r6("score").alias("score"))

    return run


QUERIES["topk_cosine"], QUERIES["topk_l2"], QUERIES["topk_ip"] = _topk("COS"), _topk("L2"), _topk("IP")


@query
def batch_topk(spark, sf):
    return hits(search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 10))


@query
def batch_topk_l2(spark, sf):
    out = search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 10, metric="L2")
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), r6("score").alias("score"), r6("distance").alias("distance"))


@query
def batch_topk_grid(spark, sf):
    """The way taken when the queries are too many to share with every task."""
    out = search.batch_topk(
        vectors(spark, sf), all_queries(spark, sf), VECTORS, 10, metric="IP", engine="grid", cell_bytes=100 * 64 * 8
    )
    return hits(out)


@query
def batch_topk_seeded(spark, sf):
    """A first look at a sample bounds the k-th score; the result is the whole exact one."""
    return hits(search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 10, seed_fraction=0.2))


@query
def topk_second_vector(spark, sf):
    table = VectorTable(id="vec_id", dims=64, embedding="primary_vec")
    two = vectors(spark, sf).select(
        "vec_id", F.col("embedding").alias("primary_vec"), F.reverse("embedding").alias("secondary_vec")
    )
    return hits(search.batch_topk(two, all_queries(spark, sf), table, 4, vector_col="secondary_vec"))


def text_corpus(spark, sf):
    return ingest.embed_corpus(documents(spark, sf), DOCS, letter_model)


def text_queries(spark, sf):
    return read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


@query
def topk_by_text_query(spark, sf):
    out = topk_by_text(text_corpus(spark, sf), text_queries(spark, sf), DOCS, letter_model, 4, metric="L2")
    return out.select("query_id", "rank", "id", r6("score").alias("score"), r6("distance").alias("distance"))


@query
def topk_prefilter(spark, sf):
    condition = {"label": {"$in": [1, 3]}}
    return hits(search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 4, condition=condition))


@query
def topk_namespace(spark, sf):
    table = VectorTable(id="vec_id", dims=64, namespace="label")
    return hits(search.batch_topk(vectors(spark, sf), all_queries(spark, sf), table, 4))


@query
def topk_namespace_ties(spark, sf):
    """All vectors of a label are one, so its smallest ids win, as numbers."""
    one = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i == F.col("label")).cast("float"))
    corpus = vectors(spark, sf).withColumn("embedding", one)
    asked = all_queries(spark, sf).withColumn("query_vector", one)
    return hits(search.batch_topk(corpus, asked, VectorTable(id="vec_id", dims=64, namespace="label"), 4))


@query
def topk_threshold(spark, sf):
    return hits(search.threshold(search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 10), 0.3))


@query
def topk_relevance(spark, sf):
    out = search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 10)
    return hits(search.relevance(out, lambda score: (1 + score) / 2, 0.65))


@query
def topk_page(spark, sf):
    out = search.batch_topk(vectors(spark, sf), all_queries(spark, sf), VECTORS, 6)
    return hits(search.page(out, top=4, skip=2, minimum=0.25))


@query
def topk_postfilter(spark, sf):
    corpus = vectors(spark, sf)
    out = search.batch_topk(corpus, all_queries(spark, sf), VECTORS, 10)
    out = search.attach(out, corpus, VECTORS, ["label"])
    out = search.post_stages(out, lambda h: h.filter("label < 5"), lambda h: h.filter("score < 0.9"))
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), r6("score").alias("score"), "label")


@query
def mmr_query(spark, sf):
    """Queries are all vectors read backwards, so that no query is itself a candidate."""
    asked = all_queries(spark, sf).withColumn("query_vector", F.reverse("query_vector"))
    return hits(mmr(vectors(spark, sf), asked, VECTORS, 4, 20, 0.5))


def _retrieved(df: DataFrame) -> DataFrame:
    return df.select(
        "query_id", "rank", "id", r6("score").alias("score"), F.md5("text").alias("text_md5"),
        F.col("metadata.lang").alias("lang"), F.col("metadata.namespace").alias("namespace"),
    )


@query
def retrieve_query(spark, sf):
    out = retrieve(
        text_corpus(spark, sf), text_queries(spark, sf), DOCS, 4, model=letter_model, metric="L2",
        condition={"lang": {"$ne": "de"}},
    )
    return _retrieved(out)


@query
def retrieve_mmr(spark, sf):
    """Queries are all vectors read backwards, as for ``mmr``."""
    corpus = vectors(spark, sf).withColumn("text", F.concat(F.lit("row "), F.col("vec_id").cast("string")))
    asked = all_queries(spark, sf).withColumn("query_vector", F.reverse("query_vector")).select("query_id", "query_vector")
    out = retrieve(corpus, asked, VECTORS, 4, search_type="mmr", fetch_k=20, lambda_mult=0.5)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), r6("score").alias("score"), "text", F.col("metadata.label").alias("label"))


@query
def retrieve_gather(spark, sf):
    """One row per query with its hits in order."""
    out = retrieve(
        text_corpus(spark, sf), text_queries(spark, sf), DOCS, 4, model=letter_model, metric="L2",
        condition={"lang": {"$ne": "de"}}, gather=True,
    )
    return out.select("query_id", F.array_join(F.transform("hits", lambda h: h["id"]), ",").alias("ids"), F.size("hits").cast("bigint").alias("n"))


@query
def retrieve_threshold(spark, sf):
    out = retrieve(
        text_corpus(spark, sf), text_queries(spark, sf), DOCS, 4, model=letter_model, metric="L2",
        search_type="similarity_score_threshold", minimum=0.2,
    )
    return _retrieved(out)


# ---- approximate search ---------------------------------------------------------------------------


@query
def ivf_assign(spark, sf):
    return approx.ivf_assign(vectors(spark, sf), label_centroids(spark, sf), VECTORS).select("vec_id", "list_id")


@query
def ivf_search(spark, sf):
    centroids = label_centroids(spark, sf)
    indexed = approx.ivf_assign(vectors(spark, sf), centroids, VECTORS)
    return hits(approx.ivf_search(indexed, all_queries(spark, sf), centroids, VECTORS, 5, nprobes=3))


@query
def candidate_rerank(spark, sf):
    return hits(approx.candidate_rerank(vectors(spark, sf), all_queries(spark, sf), axes(spark), VECTORS, 5, 40))


def _edges(df: DataFrame) -> DataFrame:
    return df.select("src", "dst", "rank", r6("score").alias("score"))


@query
def knn_graph(spark, sf):
    return _edges(approx.knn_graph(vectors(spark, sf), VECTORS, 5))


@query
def knn_graph_in_lists(spark, sf):
    indexed = approx.ivf_assign(vectors(spark, sf), label_centroids(spark, sf), VECTORS)
    return _edges(approx.knn_graph(indexed, VECTORS, 5, within="list_id"))


def axes(spark: SparkSession) -> DataFrame:
    """Planes that are the axes: one sign bit per element."""
    return spark.range(64).select(
        F.col("id").cast("int").alias("plane_id"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i == F.col("id")).cast("double")).alias("plane"),
    )


@query
def knn_graph_from_candidates(spark, sf):
    return _edges(approx.knn_graph(vectors(spark, sf), VECTORS, 5, 30, planes=axes(spark)))


@query
def ivf_trained(spark, sf):
    """k-means centroids, all lists probed: whatever the training gives, this equals exact search."""
    corpus = vectors(spark, sf)
    centroids = approx.train_centroids(corpus, VECTORS, 10)
    indexed = approx.ivf_assign(corpus, centroids, VECTORS)
    return hits(approx.ivf_search(indexed, all_queries(spark, sf), centroids, VECTORS, 5, nprobes=10))


@query
def ivf_assign_tree(spark, sf):
    """Down a tree over the given centroids."""
    tree = pruned.centroid_tree(label_centroids(spark, sf), VECTORS, 3)
    return pruned.ivf_assign_tree(vectors(spark, sf), tree, VECTORS).select("vec_id", "list_id")


@query
def batch_topk_pruned(spark, sf):
    """Lists that their bounds rule out are not read."""
    centroids = label_centroids(spark, sf)
    indexed = settle(approx.ivf_assign(vectors(spark, sf), centroids, VECTORS))
    bounds = settle(pruned.list_bounds(indexed, centroids, VECTORS))
    return hits(pruned.batch_topk_pruned(indexed, all_queries(spark, sf), bounds, VECTORS, 10).hits)


@query
def candidate_rerank_indexed(spark, sf):
    """The first stage from bands of sketch bits: the same as a comparison with every sketch."""
    index = hamming_index.sketch_index(vectors(spark, sf), axes(spark), VECTORS, 40)
    return hits(hamming_index.candidate_rerank_indexed(vectors(spark, sf), all_queries(spark, sf), axes(spark), VECTORS, index, 5, 40))


@query
def knn_graph_refined(spark, sf):
    return _edges(refine.knn_graph_refined(vectors(spark, sf), VECTORS, 5).edges)


# Names under which the checks are listed, where the function name was taken.
for _own, _listed in (
    ("corpus_scan_query", "corpus_scan"), ("topk_by_text_query", "topk_by_text"),
    ("mmr_query", "mmr"), ("retrieve_query", "retrieve"),
):
    QUERIES[_listed] = QUERIES.pop(_own)
