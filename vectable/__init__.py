"""Tables of embedded documents on Spark: bulk writes, metadata filters, vector search."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from vectable.functions.predicates import where  # noqa: E402
from vectable.operators.approx import (  # noqa: E402
    Tuning,
    add_sketch,
    candidate_rerank,
    ivf_assign,
    ivf_search,
    knn_graph,
    random_planes,
    train_centroids,
)
from vectable.operators.delete import (  # noqa: E402
    delete_all,
    delete_by_filter,
    delete_by_ids,
    delete_counts,
    delete_in_namespace,
)
from vectable.operators.fetch import (  # noqa: E402
    filtered_fetch,
    from_storage,
    get_by_ids,
    get_path,
    remove_path,
    set_path,
    to_documents,
    to_storage,
    without_vectors,
)
from vectable.operators.hamming_index import SketchIndex, candidate_rerank_indexed, sketch_candidates, sketch_index  # noqa: E402
from vectable.operators.ingest import (  # noqa: E402
    append_documents,
    assign_ids,
    bucket_of,
    drop_known,
    drop_marks,
    embed_corpus,
    embed_query,
    latest_per_id,
    live,
    upsert_buckets,
    upsert_embeddings,
    upsert_merge,
    upsert_replace,
    upsert_versioned,
)
from vectable.operators.mmr import mmr  # noqa: E402
from vectable.operators.pruned import (  # noqa: E402
    CentroidTree,
    batch_topk_pruned,
    centroid_tree,
    ivf_assign_tree,
    list_bounds,
    train_centroid_tree,
)
from vectable.operators.refine import knn_graph_refined  # noqa: E402
from vectable.operators.search import attach, batch_topk, page, post_stages, relevance, scored, threshold, topk  # noqa: E402
from vectable.operators.validate import validate_rows, validate_vectors  # noqa: E402
from vectable.plans.ingest import ingest  # noqa: E402
from vectable.plans.retrieve import retrieve, topk_by_text  # noqa: E402
from vectable.sources.buckets import BucketTable, Conflict  # noqa: E402
from vectable.sources.tables import (  # noqa: E402
    clear_settled,
    corpus_scan,
    save_bucketed,
    save_snapshot,
    semi_filter,
    settle,
)
from vectable.table import VectorTable  # noqa: E402

__all__ = [
    "BucketTable", "CentroidTree", "Conflict", "drop_marks", "live", "upsert_versioned", "SketchIndex", "Tuning", "VectorTable", "batch_topk_pruned", "candidate_rerank_indexed", "centroid_tree",
    "ivf_assign_tree", "knn_graph_refined", "list_bounds", "sketch_candidates", "sketch_index", "train_centroid_tree", "add_sketch", "append_documents", "assign_ids", "attach", "batch_topk", "bucket_of",
    "candidate_rerank", "clear_settled", "corpus_scan", "delete_all", "delete_by_filter", "delete_by_ids", "delete_counts",
    "delete_in_namespace", "drop_known", "embed_corpus", "embed_query", "filtered_fetch", "from_storage", "get_by_ids", "get_path",
    "ingest", "ivf_assign", "ivf_search", "knn_graph", "latest_per_id", "mmr", "page", "post_stages", "random_planes",
    "relevance", "remove_path", "retrieve", "save_bucketed", "save_snapshot", "scored", "semi_filter", "set_path",
    "settle", "threshold", "to_documents", "to_storage", "topk", "topk_by_text", "train_centroids", "upsert_buckets",
    "upsert_embeddings", "upsert_merge", "upsert_replace", "validate_rows", "validate_vectors", "where",
    "without_vectors",
]
