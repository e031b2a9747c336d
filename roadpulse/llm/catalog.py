"""The registered queries of the corpus operators: one per operator, and the pipeline."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import collocations, embedding_dedup, fingerprints, huffman, mixing, ngram_join, packing, quality, secrets, substring_dedup, token_counts, toxicity, vector_codes
from roadpulse.llm.common import table


#: The tree of the mixture. A source's domain follows from its number.
_NUMBER = "try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT)"
DOMAIN = f"CASE WHEN {_NUMBER} < 8 THEN 'web' WHEN {_NUMBER} < 14 THEN 'books' ELSE 'reference' END"
LEVELS = {"domain": DOMAIN, "lang": "lang", "source": "source"}
WEIGHTS = {
    "domain": {"web": 5, "books": 3, "reference": 4},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2, "src9": 3, "src14": 4},
}


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Four fifths of the corpus' tokens, with up to two epochs of a source."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, LEVELS, WEIGHTS, share=(4, 5), max_epochs=2, seed=17, columns=["doc_id"])
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"), F.col("mix_tokens").alias("n_tokens"), F.col("mix_epoch").alias("epoch"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_components(table(spark, folder, "documents"))


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    at = huffman.new_folder(spark)
    huffman.write(table(spark, folder, "documents"), at)
    return huffman.read(spark, at, with_ids=False)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, weights)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_vector_codes": op11_vector_codes,
    "op12_quality": op12_quality,
    "op13_collocations": op13_collocations,
}



def _level_sql(previous: str, path: list[str], weight_sql: str) -> str:
    """One level of the budget tree: ``previous`` holds the parents' budgets."""
    own, level = path[-1], ", ".join(path)
    parents = ", ".join(path[:-1])
    part = f"PARTITION BY {parents}" if parents else ""
    return f"""
 c_{own} AS (SELECT {level}, sum(cap) AS cap, max({weight_sql}) AS w FROM usable GROUP BY {level}),
 s_{own} AS (SELECT *, CAST(sum(cap) OVER (f ROWS UNBOUNDED PRECEDING) AS HUGEINT) AS upto,
   coalesce(sum(w) OVER (f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS aft
   FROM c_{own} {f"JOIN {previous} USING ({parents})" if parents else f"CROSS JOIN {previous}"}
   WINDOW f AS ({part} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {own})),
 u_{own} AS (SELECT *, (budget - upto) * w >= cap * aft AS filled FROM s_{own}),
 o_{own} AS (SELECT *, greatest(budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER (e), 0) AS rest_,
   sum(CASE WHEN filled THEN 0 ELSE w END) OVER (e) AS open_,
   sum(CASE WHEN filled THEN 0 ELSE w END) OVER (f ROWS UNBOUNDED PRECEDING) AS run_
   FROM u_{own} WINDOW e AS ({part}), f AS ({part} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {own})),
 b_{own} AS (SELECT {level}, CAST(CASE WHEN filled THEN cap ELSE CAST(rest_ AS HUGEINT) * run_ // open_ - CAST(rest_ AS HUGEINT) * (run_ - w) // open_ END AS HUGEINT) AS budget FROM o_{own})"""


def _case_sql(column: str, weights: dict[str, int]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def mixing_sql(share: tuple[int, int], max_epochs: int, seed: int) -> str:
    return f"""WITH d AS (SELECT doc_id, {DOMAIN} AS domain,
   coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
 leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS supply FROM d WHERE n_tokens > 0 GROUP BY ALL),
 usable AS (SELECT *, CAST(supply * {max_epochs} AS HUGEINT) AS cap FROM leaf),
 root AS (SELECT CAST(coalesce(sum(supply), 0) * {share[0]} // {share[1]} AS HUGEINT) AS budget FROM leaf),
 {_level_sql("root", ["domain"], _case_sql("domain", WEIGHTS["domain"]))},
 {_level_sql("b_domain", ["domain", "lang"], _case_sql("lang", WEIGHTS["lang"]))},
 {_level_sql("b_lang", ["domain", "lang", "source"], _case_sql("source", WEIGHTS["source"]))},
 given AS (SELECT *, CAST(budget // supply AS BIGINT) AS whole, CAST(budget % supply AS BIGINT) AS rest FROM leaf JOIN b_source USING (domain, lang, source)),
 placed AS (SELECT d.*, whole, rest, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
   ORDER BY md5('{seed}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
   FROM d JOIN given USING (domain, lang, source) WHERE n_tokens > 0),
 copies AS (SELECT *, whole + CASE WHEN start < rest THEN 1 ELSE 0 END AS n FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(n)) AS INTEGER) AS epoch FROM copies WHERE n > 0"""


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Repeated windows of 35 words, by counting all windows.
SUBSTRING_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
 windows AS (SELECT rid, i, md5(array_to_string(w[i:i+34], ' ')) AS h FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
 again AS (SELECT rid, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
 words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
 marked AS (SELECT rid, word, i, i - coalesce(max(begun) OVER (PARTITION BY rid ORDER BY i), -100) < 35 AS gone FROM words LEFT JOIN (SELECT rid, i, i AS begun FROM again) a USING (rid, i)),
 kept AS (SELECT rid, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM marked GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""

#: Links by comparing all vectors of a label, components by following links from every vector.
EMBEDDING_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
 reached(id, root) AS (SELECT a, a FROM links UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id),
 least AS (SELECT id, min(root) AS root FROM reached GROUP BY id), numbers AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN numbers ON a = vec_id LEFT JOIN least ON id = vec_id"""

#: Overlaps of all pairs of different sets that share a shingle.
NGRAM_SQL = f"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
   ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) END AS shingles FROM d),
 named AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, CASE WHEN len(shingles) > 0 THEN md5(array_to_string(shingles, chr(10))) END AS k, shingles FROM s),
 sets AS MATERIALIZED (SELECT k, any_value(n) AS n, any_value(shingles) AS shingles FROM named WHERE k IS NOT NULL GROUP BY k),
 postings AS MATERIALIZED (SELECT k, n, unnest(shingles) AS x FROM sets),
 links AS MATERIALIZED (SELECT a.k AS a, b.k AS b FROM postings a JOIN postings b ON a.x = b.x AND a.k <> b.k
   GROUP BY a.k, b.k HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
 reached(k, root) AS (SELECT k, k FROM sets UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.k),
 class AS (SELECT k, min(root) AS root FROM reached GROUP BY k),
 least AS (SELECT root, min(doc_id) AS least FROM named JOIN class USING (k) GROUP BY root)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(least, doc_id) AS component_id FROM named LEFT JOIN class USING (k) LEFT JOIN least USING (root)"""

ORACLES: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_SQL,
    "op3_embedding_dedup": EMBEDDING_SQL,
    "op4_ngram_join": NGRAM_SQL,
    "op1_mixing": mixing_sql((4, 5), 2, 17),
    "op11_vector_codes": vector_codes.vector_codes_sql(),
    "op13_collocations": collocations.collocations_sql(),
}
