"""Queries over the training-text tables, each with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vectable.llm.byte_bpe import encode_texts
from vectable.llm.decontaminate import leaks
from vectable.llm.html_extract import extract
from vectable.llm.learned_index import neighbours
from vectable.llm.line_dedup import dedup_lines
from vectable.llm.merkle import fold, leaf_hash, manifest, proof_hash
from vectable.llm.ngram_lm import score_texts
from vectable.llm.quality import quality
from vectable.llm.secret_scan import scan_secrets
from vectable.llm.simhash import near_duplicates
from vectable.llm.substring_dedup import remove_repeats
from vectable.llm.token_counts import count_tokens
from vectable.llm.turn_trie import prefix_trie, regrown, sequences
from vectable.sources.tables import settle

JSON_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("twin")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("certain", 256).alias("base_sha256"), "spans")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), JSON_TOKENIZER)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def byte_bpe_digests(docs: DataFrame) -> DataFrame:
    encoded = encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digests(_table(spark, sf_dir, "documents"))


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op11_learned_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(_table(spark, sf_dir, "embeddings"))


def merkle_rows(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, and the roots that leaves lead to where every seventh row (by CRC) claims one character more."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = [F.col(f).cast("decimal(20,0)") + 1 if f == "n_chars" else F.col(f) for f in fields]
    changed = (_crc("doc_id") % 7 == 0) & F.col("n_chars").isNotNull()
    claimed = F.when(changed, leaf_hash(more)).otherwise(leaf_hash([F.col(f) for f in fields]))
    out = manifest(docs, fields, claimed=claimed)
    folded = fold(F.col("claimed"), F.col("proof"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc(key: str) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(_table(spark, sf_dir, "documents"))


def trie_rows(turns: DataFrame) -> DataFrame:
    """The trie of conversations whose first turns (up to 8, by CRC) are those of the first of their five."""
    convs = settle(sequences(turns))
    key = F.col("conv_id")
    return prefix_trie(regrown(convs, 8, _crc("conv_id") % 9, key - key % 5))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_rows(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_secret_scan": op3_secret_scan,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_counts": op5_token_counts,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_lm": op10_ngram_lm,
    "op11_learned_index": op11_learned_index,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_trie": op13_conversation_trie,
}


def _crc_sql(key: str) -> str:
    """CRC-32 of a number in decimal: DuckDB has no function for it."""
    eight = "list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    digits = f"list_transform(string_split(CAST({key} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, b: {eight}), 4294967295)"


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_UP = "list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))"

# The others need XXH64, tokenizers or trained models and are tested by brute force.
ORACLE: dict[str, str] = {
    "op8_substring_dedup": r"""
      WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
        FROM documents),
      windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM w, unnest(range(1, len(ws) - 11)) t(i)),
      firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
      gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM windows JOIN firsts USING (s), range(0, 13) r(k) WHERE doc_id > first),
      words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
      kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
        FROM words WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = words.doc_id AND g.pos = words.pos) GROUP BY doc_id)
      SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op12_merkle_manifest": f"""
      WITH RECURSIVE leaves AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
          CASE WHEN {_crc_sql("doc_id")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS claimed FROM documents),
      placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
      levels AS (SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
        UNION ALL SELECT lang, level + 1, {_UP} FROM levels WHERE len(nodes) > 1),
      tops AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1),
      upper AS (SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM tops
        UNION ALL SELECT level + 1, {_UP} FROM upper WHERE len(nodes) > 1),
      ways AS (SELECT p.doc_id, p.leaf, p.claimed, t.subroot, l.level, (p.pos >> l.level) AS spot, l.nodes
        FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang JOIN levels l ON p.lang IS NOT DISTINCT FROM l.lang
        UNION ALL SELECT p.doc_id, p.leaf, p.claimed, t.subroot, 1000 + u.level, (t.place >> u.level), u.nodes
        FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang CROSS JOIN upper u),
      steps AS (SELECT doc_id, leaf, claimed, subroot, level, len(nodes) > 1 AS paired, coalesce(nodes[xor(spot, 1) + 1], '') AS beside,
          CASE WHEN spot % 2 = 1 THEN 'L' ELSE 'R' END AS side FROM ways),
      proofs AS (SELECT doc_id, leaf, claimed, subroot, sha256(coalesce(string_agg(beside, '' ORDER BY level) FILTER (WHERE paired), '')) AS proof_sha256,
          list_reduce(list_prepend(claimed, coalesce(list(side || beside ORDER BY level) FILTER (WHERE paired), [])),
            lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
        FROM steps GROUP BY doc_id, leaf, claimed, subroot),
      top AS (SELECT nodes[1] AS root FROM upper WHERE len(nodes) = 1)
      SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM proofs CROSS JOIN top""",
    "op13_conversation_trie": f"""
      WITH convs AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
          ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
      cut AS (SELECT *, {_crc_sql("conv_id")} % 9 AS h FROM convs),
      rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.seq[1:c.h], []), c.seq[c.h + 1:]) AS seq
        FROM cut c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5),
      members AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt),
      nodes AS (SELECT seq[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
          sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '')) AS ends_sha256
        FROM members GROUP BY ALL),
      fans AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
      own AS (SELECT nodes.*, coalesce(fans.n, 0) AS n_children,
          CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[depth].text) END AS saved FROM nodes LEFT JOIN fans USING (path)),
      parts AS (SELECT path, depth, unnest(range(0, depth + 1)) AS up, n_children, saved FROM own),
      sums AS (SELECT path[1:up] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved FROM parts GROUP BY ALL)
      SELECT own.conv_id, own.depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, CAST(sums.n_leaves AS BIGINT) AS n_leaves,
        CAST(sums.saved AS BIGINT) AS saved_tokens, own.ends_sha256
      FROM own JOIN sums USING (path) LEFT JOIN nodes parent ON own.depth > 0 AND parent.path = own.path[1:own.depth - 1]""",
}
