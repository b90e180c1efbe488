"""The SQL twin of each query in ``checks.queries``, for DuckDB over the same tables."""

from __future__ import annotations

DOCS = """docs AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS namespace, d.text, d.lang, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))"""



def letters(text: str, letter: str = "e") -> str:
    """How often a letter occurs: the letter embedding's elements."""
    return f"CAST(length({text}) - length(replace({text}, '{letter}', '')) AS DOUBLE)"


STORED = f"""stored AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS namespace, text, {letters('text')} AS emb0,
         lang, n_chars, 'note ' || source AS note FROM documents)"""

CONVERSATIONS = f"""SELECT 'c-' || conv_id || '-' || turn AS id, role AS namespace, text,
         {letters('text')} AS emb0, 'en' AS lang, turn AS n_chars FROM conversations"""

BATCH = f"""batch AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS namespace, 'v2 ' || d.text AS text,
         {letters('d.text')} AS emb0, 'xx' AS lang, CAST(l.quality AS BIGINT) AS n_chars
  FROM documents d JOIN labels l USING (doc_id)
  UNION ALL {CONVERSATIONS})"""

FLAT = "id, namespace, md5(text) AS text_md5, emb0, lang, n_chars, note"


def merge_sql(batch: str, keys: list[str], new: list[str]) -> str:
    on = " AND ".join(f"s.{k} = b.{k}" for k in keys)
    shown = {"id": "coalesce(s.id, b.id)"}
    for c in ("namespace", "text", "emb0", "lang", "n_chars", "note"):
        shown[c] = f"CASE WHEN b.id IS NOT NULL THEN b.{c} ELSE s.{c} END" if c in new else f"s.{c}"
    if "namespace" in keys:
        shown["namespace"] = "coalesce(s.namespace, b.namespace)"
    columns = ", ".join(f"{expr} AS {name}" for name, expr in shown.items())
    return f"""WITH {STORED}, {batch}, merged AS (
      SELECT {columns} FROM stored s FULL OUTER JOIN batch b ON {on})
      SELECT {FLAT} FROM merged"""


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


E = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
V = f"v AS (SELECT vec_id, label, {E} AS e FROM embeddings)"
MEAN = """m AS (SELECT list(x ORDER BY i) AS q FROM (
  SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) t(i) GROUP BY i))"""
CENTROIDS = """c AS (SELECT label AS list_id, list(x ORDER BY i) AS centroid FROM (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) t(i) GROUP BY label, i)
  GROUP BY label)"""
RANK = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order}, vec_id) AS INTEGER) AS rank"


def pairs(score: str, join: str = "true", query: str = "q.e", order: str = "score DESC") -> str:
    """All (query, row) pairs ranked per query."""
    rank = RANK.format(order=order)
    return f"""pairs AS (SELECT q.vec_id AS query_id, v.vec_id, v.label, {score.format(q=query, v='v.e')} AS score
      FROM v q JOIN v ON {join}),
    ranked AS (SELECT *, {rank} FROM pairs)"""


COS = "list_cosine_similarity({q}, {v})"
IP = "list_inner_product({q}, {v})"
L2 = "1 / (1 + list_distance({q}, {v}))"
HITS = f"query_id, rank, vec_id, {r6('score')} AS score"


def batch(score: str = COS, k: int = 10, where: str = "true", **options: str) -> str:
    return f"WITH {V}, {pairs(score, **options)} SELECT {HITS} FROM ranked WHERE rank <= {k} AND {where}"


def single(score: str, order: str = "DESC") -> str:
    return f"""WITH {V}, {MEAN}, s AS (SELECT vec_id, {score.format(q='q', v='e')} AS score FROM v, m),
      r AS (SELECT *, CAST(row_number() OVER (ORDER BY score {order}, vec_id) AS INTEGER) AS rank FROM s)
      SELECT rank, vec_id, {r6('score')} AS score FROM r WHERE rank <= 10"""


def against_label_mean(expr: str, name: str) -> str:
    return f"""WITH {V}, {CENTROIDS}
      SELECT vec_id, {r6(expr.format(q='centroid', v='e'))} AS {name} FROM v JOIN c ON v.label = c.list_id"""


def filtered(condition: str) -> str:
    return f"WITH {DOCS} SELECT id, namespace FROM docs WHERE {condition}"


def deleted(condition: str) -> str:
    return f"WITH {DOCS} SELECT id, coalesce({condition}, false) AS deleted FROM docs"


LABELLED = "id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"


def text_search(condition: str, k: int = 4) -> str:
    """Letter embedding under L2."""
    apart = " + ".join(f"pow({letters('b.text', x)} - {letters('d.text', x)}, 2)" for x in "et")
    return f"""WITH {DOCS}, pairs AS (
      SELECT b.item_id AS query_id, d.*, sqrt({apart}) AS distance
      FROM benchmark b, docs d WHERE {condition}),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank,
      1 / (1 + distance) AS score FROM pairs), hits AS (SELECT * FROM ranked WHERE rank <= {k})"""


RETRIEVED = f"query_id, rank, id, {r6('score')} AS score, md5(text) AS text_md5, lang, namespace"


def mmr_sql(k: int, fetch_k: int, weight: float) -> str:
    """One CTE per greedy step over the fetched candidates."""
    steps = []
    for n in range(1, k + 1):
        gain = "c.score"
        if n > 1:
            alike = " UNION ALL ".join(f"SELECT * FROM pick{j}" for j in range(1, n))
            gain = f"""{weight} * c.score - {1 - weight} * (SELECT max(list_cosine_similarity(c.e, p.e))
              FROM ({alike}) p WHERE p.query_id = c.query_id)"""
        taken = "".join(
            f" AND NOT EXISTS (SELECT 1 FROM pick{j} p WHERE p.query_id = c.query_id AND p.vec_id = c.vec_id)"
            for j in range(1, n)
        )
        steps.append(f"""pick{n} AS MATERIALIZED (SELECT query_id, vec_id, e, score, {n} AS rank FROM (
          SELECT c.query_id, c.vec_id, c.e, c.score, row_number() OVER (
            PARTITION BY c.query_id ORDER BY round({gain}, 9) DESC, c.rank) AS place
          FROM cand c WHERE true{taken}) WHERE place = 1)""")
    union = " UNION ALL ".join(f"SELECT query_id, rank, vec_id, score FROM pick{n}" for n in range(1, k + 1))
    return f"""WITH {V}, {pairs(COS, query='list_reverse(q.e)')},
      cand AS MATERIALIZED (SELECT r.*, v.e FROM ranked r JOIN v USING (vec_id) WHERE rank <= {fetch_k}),
      {', '.join(steps)} SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, vec_id,
      {r6('score')} AS score FROM ({union})"""


ASSIGNED = """cs AS (SELECT vec_id, list_id, row_number() OVER (PARTITION BY vec_id
    ORDER BY list_cosine_similarity(e, centroid) DESC, list_id) AS near FROM v, c),
  ix AS (SELECT vec_id, list_id FROM cs WHERE near = 1)"""

BITS = "list_transform(e, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END)"


def graph(join: str) -> str:
    return f"""p AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_cosine_similarity(a.e, b.e) AS score
      FROM {join} AND a.vec_id <> b.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS INTEGER) AS rank FROM p)
    SELECT src, dst, rank, {r6('score')} AS score FROM r WHERE rank <= 5"""


ORACLE: dict[str, str] = {
    "corpus_scan": "SELECT doc_id, lang, n_chars FROM documents",
    "embed_corpus": f"SELECT doc_id, {letters('text')} AS emb0, {letters('text', 't')} AS emb1 FROM documents",
    "embed_corpus_shapes": "SELECT doc_id, " + ", ".join(
        f"CAST(len(regexp_extract_all(text, '{p}')) AS DOUBLE) AS emb{n}" for n, p in enumerate((" ", "[A-Z]", "[0-9]"))
    ) + " FROM documents",
    "append_documents": f"""WITH {STORED}, added AS ({CONVERSATIONS})
      SELECT {FLAT} FROM stored UNION ALL
      SELECT CASE WHEN namespace = 'assistant' THEN 'generated' ELSE id END, namespace, md5(text), emb0, lang,
        n_chars, NULL FROM added""",
    "append_generated_ids": """SELECT namespace, count(*) AS n, count(*) AS distinct_ids, CAST(0 AS BIGINT) AS blank_ids
      FROM (SELECT source AS namespace FROM documents UNION ALL SELECT role FROM conversations) GROUP BY namespace""",
    "upsert_replace": f"""WITH {STORED}, {BATCH}
      SELECT {FLAT} FROM stored s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.id = s.id)
      UNION ALL SELECT id, namespace, md5(text), emb0, lang, n_chars, NULL FROM batch""",
    "upsert_merge": merge_sql(BATCH + ", b0 AS (SELECT 1)", ["id"], ["text", "emb0", "lang", "n_chars"]).replace(
        "FROM stored s FULL OUTER JOIN batch b", "FROM stored s FULL OUTER JOIN (SELECT *, NULL AS note FROM batch) b"),
    "upsert_merge_new_field": f"""WITH {STORED}, {BATCH} SELECT coalesce(s.id, b.id) AS id,
      CASE WHEN b.id IS NOT NULL THEN b.lang ELSE s.lang END AS lang, CASE WHEN b.id IS NULL THEN s.n_chars END AS n_chars,
      CASE WHEN b.id IS NOT NULL THEN 'new' END AS extra FROM stored s FULL OUTER JOIN batch b ON s.id = b.id""",
    "ingest_without_metadata": f"""WITH {STORED}, added AS ({CONVERSATIONS}) SELECT {FLAT} FROM stored
      UNION ALL SELECT id, NULL, md5(text), emb0, NULL, NULL, NULL FROM added""",
    "ingest_mixed": f"""WITH {STORED} SELECT id, namespace, md5(CASE WHEN lang = 'de' THEN 'v2 ' || text ELSE text END) AS text_md5,
      CASE WHEN lang = 'fr' THEN 1 ELSE emb0 END AS emb0, lang, n_chars, note FROM stored""",
    "upsert_embedding_only": merge_sql(BATCH, ["id"], ["emb0"]),
    "upsert_namespaced": merge_sql(
        BATCH.replace("batch AS (", "batch0 AS (") + """, batch AS (SELECT id, CASE WHEN n_chars = 0 THEN 'elsewhere'
          ELSE namespace END AS namespace, text, emb0, lang, n_chars FROM batch0)""",
        ["namespace", "id"], ["text", "emb0", "lang", "n_chars"]),
    "dedupe_before_embed": f"""SELECT doc_id, {letters('text')} AS emb0 FROM documents d
      WHERE NOT coalesce(lang = 'de', false) AND NOT EXISTS (
        SELECT 1 FROM documents k JOIN labels l USING (doc_id) WHERE md5(k.text) = md5(d.text))""",
    "latest_per_id": """SELECT CAST(conv_id AS VARCHAR) AS id, turn, role, md5(text) AS text_md5 FROM conversations
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "ingest_batch": f"""WITH {STORED}, turns AS (
      SELECT 'c-' || conv_id AS id, role AS namespace, text, {letters('text')} AS emb0, 'en' AS lang,
        turn AS n_chars FROM conversations WHERE role <> 'system'
        AND NOT EXISTS (SELECT 1 FROM documents d WHERE md5(d.text) = md5(conversations.text))
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1),
    changed AS (SELECT id, text || ' v2' AS text, emb0 FROM stored s WHERE lang = 'fr'
      AND NOT EXISTS (SELECT 1 FROM documents d WHERE md5(d.text) = md5(s.text || ' v2')))
    SELECT s.id, namespace, md5(coalesce(c.text, s.text)) AS text_md5, coalesce(c.emb0, s.emb0) AS emb0, lang, n_chars, note
    FROM stored s LEFT JOIN changed c ON c.id = s.id
    UNION ALL SELECT id, NULL, md5(text), emb0, lang, n_chars, NULL FROM turns""",
    "validate_vectors": """WITH spoiled AS (SELECT vec_id, CASE label
        WHEN 0 THEN embedding[1:63] WHEN 1 THEN NULL
        WHEN 2 THEN embedding[1:10] || [CAST('nan' AS FLOAT)] || embedding[12:64]
        WHEN 3 THEN embedding[1:10] || [CAST('inf' AS FLOAT)] || embedding[12:64]
        WHEN 4 THEN embedding[1:10] || [CAST('-inf' AS FLOAT)] || embedding[12:64]
        WHEN 5 THEN embedding[1:10] || [CAST(NULL AS FLOAT)] || embedding[12:64]
        ELSE embedding END AS e FROM embeddings)
      SELECT vec_id, CASE WHEN e IS NULL THEN 'missing vector' WHEN len(e) <> 64 THEN 'wrong dimensions'
        WHEN len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'not finite' ELSE 'ok' END AS reason
      FROM spoiled""",
    "validate_rows": f"""WITH {DOCS} SELECT CASE WHEN lang = 'de' THEN '  ' ELSE id END AS id,
      CASE WHEN lang = 'de' THEN 'blank key' WHEN lang = 'fr' THEN 'neither text nor vector'
        ELSE 'ok' END AS reason FROM docs""",
    "delete_by_ids": deleted(LABELLED),
    "delete_by_filter": deleted("toxic = 1"),
    "delete_in_namespace": deleted(f"namespace = 'src1' AND lang = 'en' AND {LABELLED}"),
    "delete_all_namespace": deleted("namespace = 'src2'"),
    "delete_counts": f"""WITH {DOCS} SELECT namespace, count(*) AS deleted FROM docs
      WHERE lang = 'en' AND quality >= 1 GROUP BY namespace""",
    "get_by_ids": f"WITH {DOCS} SELECT id, md5(text) AS text_md5 FROM docs WHERE {LABELLED}",
    "filtered_fetch": f"""WITH {DOCS} SELECT id, namespace, n_chars FROM docs WHERE lang = 'en'
      ORDER BY namespace, n_chars DESC, id LIMIT 20 OFFSET 10""",
    "filtered_fetch_deep": f"""WITH {DOCS}, r AS (SELECT id, namespace, n_chars, count(*) OVER () AS n,
        row_number() OVER (ORDER BY n_chars DESC, id) AS place FROM docs WHERE lang = 'en')
      SELECT id, namespace, n_chars FROM r WHERE place > n // 2""",
    "to_documents": f"""WITH {DOCS} SELECT id, md5(text) AS text_md5, quality, namespace AS source, lang FROM docs""",
    "nested_paths": """SELECT CAST(doc_id AS VARCHAR) AS id, source AS shelf, md5(text) AS text_md5,
      CAST(length(text) AS INTEGER) AS chars FROM documents""",
    "storage_rename": """SELECT doc_id AS number, lang AS tongue, n_chars AS size, md5(text) AS words_md5
      FROM documents WHERE n_chars > 500 AND lang <> 'en'""",
    "fetch_without_vectors": "SELECT vec_id, label FROM embeddings",
    "filter_eq": filtered("lang = 'en'"),
    "filter_ne": filtered("NOT coalesce(quality = 1, false)"),
    "filter_gt": filtered("n_chars > 1000"),
    "filter_gte": filtered("quality >= 1"),
    "filter_lt": filtered("n_chars < 1000"),
    "filter_lte": filtered("toxic <= 0"),
    "filter_in": filtered("lang IN ('de', 'fr')"),
    "filter_nin": filtered("NOT coalesce(quality IN (0, 2), false)"),
    "filter_contains": filtered("contains(lang, 'e')"),
    "filter_and": filtered("lang = 'en' AND n_chars >= 200 AND n_chars < 3000 AND quality = 1"),
    "filter_or": filtered("quality = 0 OR lang = 'es'"),
    "filter_not": filtered("NOT coalesce(toxic >= 1, false)"),
    "filter_nor": filtered("NOT coalesce(toxic = 0 OR lang = 'en', false)"),
    "filter_null": filtered("quality IS NULL"),
    "filter_namespace": filtered("namespace = 'src1' AND NOT coalesce(quality = 0, false)"),
    "filter_dynamic": """SELECT event_id, event_type FROM events
      WHERE CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) >= 50
        AND CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) <> 75""",
    "filter_json_string": """SELECT event_id, event_type FROM events
      WHERE CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) >= 50
        AND CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) <> 75""",
    "delete_by_filter_json": """SELECT event_id FROM events WHERE regexp_extract(props, '"k": (\\d+)', 1) = '75'""",
    "filter_in_table": filtered("namespace IN (SELECT namespace FROM docs WHERE toxic = 1)"),
    "score_cosine": against_label_mean(COS, "score"),
    "score_l2": against_label_mean("list_distance({q}, {v})", "distance"),
    "score_ip": against_label_mean(IP, "score"),
    "score_all": f"""WITH {V}, {MEAN} SELECT vec_id, {r6('1 / (1 + list_distance(q, e))')} AS score,
      {r6('list_distance(q, e)')} AS distance FROM v, m""",
    "topk_cosine": single(COS),
    "topk_l2": single(L2),
    "topk_ip": single(IP),
    "batch_topk": batch(),
    "batch_topk_l2": f"WITH {V}, {pairs('list_distance({q}, {v})', order='score')} SELECT query_id, rank, vec_id, "
      f"{r6('1 / (1 + score)')} AS score, {r6('score')} AS distance FROM ranked WHERE rank <= 10",
    "batch_topk_grid": batch(IP),
    "batch_topk_seeded": batch(),
    "topk_second_vector": batch(COS, 4, query="list_reverse(q.e)"),
    "topk_by_text": text_search("true") + f" SELECT query_id, rank, id, {r6('score')} AS score, {r6('distance')} AS distance FROM hits",
    "topk_prefilter": batch(COS, 4, join="v.label IN (1, 3)"),
    "topk_namespace": batch(COS, 4, join="v.label = q.label"),
    "topk_namespace_ties": f"WITH {V}, {pairs('CAST(1 AS DOUBLE)', join='v.label = q.label')} SELECT {HITS} FROM ranked WHERE rank <= 4",
    "topk_threshold": batch(COS, 10, "score >= 0.3"),
    "topk_relevance": f"""WITH {V}, {pairs(COS)} SELECT query_id, rank, vec_id, {r6('(1 + score) / 2')} AS score
      FROM ranked WHERE rank <= 10 AND (1 + score) / 2 >= 0.65""",
    "topk_page": f"""WITH {V}, {pairs(COS)}, t AS (SELECT query_id, vec_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY rank) AS INTEGER) AS place FROM ranked WHERE rank <= 6 AND score >= 0.25)
      SELECT query_id, CAST(place - 2 AS INTEGER) AS rank, vec_id, {r6('score')} AS score FROM t
      WHERE place BETWEEN 3 AND 6""",
    "topk_postfilter": f"""WITH {V}, {pairs(COS)} SELECT {HITS}, label FROM ranked
      WHERE rank <= 10 AND label < 5 AND score < 0.9""",
    "mmr": mmr_sql(4, 20, 0.5),
    "retrieve": text_search("d.lang <> 'de'") + f" SELECT {RETRIEVED} FROM hits",
    "retrieve_threshold": text_search("true") + f" SELECT {RETRIEVED} FROM hits WHERE score >= 0.2",
    "ivf_assign": f"WITH {V}, {CENTROIDS}, {ASSIGNED} SELECT vec_id, list_id FROM ix",
    "ivf_search": f"""WITH {V}, {CENTROIDS}, {ASSIGNED},
      pairs AS (SELECT p.vec_id AS query_id, ix.vec_id, list_cosine_similarity(q.e, v.e) AS score
        FROM cs p JOIN ix USING (list_id) JOIN v q ON q.vec_id = p.vec_id JOIN v ON v.vec_id = ix.vec_id
        WHERE p.near <= 3),
      ranked AS (SELECT *, {RANK.format(order='score DESC')} FROM pairs) SELECT {HITS} FROM ranked WHERE rank <= 5""",
    "candidate_rerank": f"""WITH {V}, s AS (SELECT vec_id, e, {BITS} AS bits FROM v),
      pairs AS (SELECT q.vec_id AS query_id, s.vec_id, list_cosine_similarity(q.e, s.e) AS score,
        list_distance(CAST(q.bits AS DOUBLE[]), CAST(s.bits AS DOUBLE[])) AS apart FROM s q, s),
      cand AS (SELECT query_id, vec_id, score FROM pairs QUALIFY row_number() OVER (
        PARTITION BY query_id ORDER BY apart, vec_id) <= 40),
      ranked AS (SELECT *, {RANK.format(order='score DESC')} FROM cand) SELECT {HITS} FROM ranked WHERE rank <= 5""",
    "ivf_trained": batch(COS, 5),
    "knn_graph": f"WITH {V}, " + graph("v a JOIN v b ON true"),
    "knn_graph_from_candidates": f"""WITH {V}, s AS (SELECT vec_id, e, CAST({BITS} AS DOUBLE[]) AS bits FROM v),
      c AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_cosine_similarity(a.e, b.e) AS score FROM s a, s b
        QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.bits, b.bits), b.vec_id) <= 31),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS INTEGER) AS rank
        FROM c WHERE src <> dst) SELECT src, dst, rank, {r6('score')} AS score FROM r WHERE rank <= 5""",
    "knn_graph_in_lists": f"WITH {V}, {CENTROIDS}, {ASSIGNED}, w AS (SELECT * FROM v JOIN ix USING (vec_id)), "
      + graph("w a JOIN w b ON a.list_id = b.list_id"),
}

ORACLE["upsert_versioned"] = """WITH docs AS (SELECT CAST(doc_id AS VARCHAR) AS id, text, toxic, labels.doc_id IS NOT NULL AS labelled
    FROM documents LEFT JOIN labels USING (doc_id)),
  versions AS (SELECT id, text, 1 AS version, false AS gone FROM docs
    UNION ALL SELECT id, 'v3 ' || text, 3, false FROM docs WHERE labelled
    UNION ALL SELECT id, 'v2 ' || text, 2, false FROM docs
    UNION ALL SELECT id, 'v4 ' || text, 4, true FROM docs WHERE toxic = 1
    UNION ALL SELECT id, 'v0 ' || text, 0, true FROM docs),
  newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1)
  SELECT id, version, md5(text) AS text_md5 FROM newest WHERE NOT gone"""
ORACLE["upsert_buckets"] = ORACLE["upsert_merge"]
ORACLE["delete_buckets"] = f"""WITH {DOCS}, known AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels),
  a AS (SELECT * FROM docs WHERE id NOT IN (SELECT id FROM known)), b AS (SELECT * FROM a WHERE lang <> 'de'),
  c AS (SELECT * FROM b WHERE namespace <> 'src2')
  SELECT id, namespace, md5(text) AS text_md5, (SELECT count(*) FROM docs) - (SELECT count(*) FROM a) AS gone0,
    (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS gone1, (SELECT count(*) FROM b) - (SELECT count(*) FROM c) AS gone2 FROM c"""
ORACLE["to_documents_json"] = f"WITH {DOCS} SELECT id, md5(text) AS text_md5, upper(lang) AS lang, namespace AS shelf, quality, n_chars FROM docs"
ORACLE["to_documents_variant"] = ORACLE["to_documents_json"]
ORACLE["to_storage"] = "SELECT doc_id AS _id, lang AS language, n_chars AS length FROM documents"
ORACLE["retrieve_gather"] = text_search("d.lang <> 'de'") + """ SELECT query_id, string_agg(id, ',' ORDER BY rank) AS ids, count(*) AS n FROM hits GROUP BY query_id"""
ORACLE["retrieve_mmr"] = f"""WITH found AS ({mmr_sql(4, 20, 0.5)})
  SELECT query_id, rank, vec_id, score, 'row ' || vec_id AS text, label FROM found JOIN embeddings USING (vec_id)"""
ORACLE["upsert_merge_reordered"] = ORACLE["upsert_merge"]
ORACLE["ivf_assign_tree"] = ORACLE["ivf_assign"]
ORACLE["batch_topk_pruned"] = ORACLE["batch_topk"]
ORACLE["candidate_rerank_indexed"] = ORACLE["candidate_rerank"]
