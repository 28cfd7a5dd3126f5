"""One query per operator over its whole table, and the SQL each is checked against where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from . import chat, decontaminate, grid_join, licenses, line_dedup, mixing, ngram_join, perplexity, prefix_trie, quality, separators, site_templates, vector_codes
from .common import WORD, Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words per document, targets per source, words taken."""
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, F.regexp_count("text", F.lit(WORD)), mixing.quality_weight("text")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and the digests of what is read back from the output."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = turns.union(more.select(F.col("conv_id").cast(turns.schema["conv_id"].dataType), "turn", "role", "text"))
    chats = chat.format_chats(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    chats = Scratch(spark, "chat").save(chats, "formatted")
    told = chat.read_back(chats).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "role", "text", "loss"))).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    digests = told.select(
        F.col("conv_id").alias("c"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
    )
    sizes = chats.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"))
    return sizes.join(digests, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def op3_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by separators in flat token streams of the whole corpus."""
    return separators.count_tokens(_table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: runs of four words, similarity 0.85."""
    found = ngram_join.ngram_components(_table(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated runs of lines."""
    return line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item that a document holds, over all passages of all documents."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences of all documents, laid out as files below their source and language.

    Documents that open with a line on a licence are licence files one directory above the others.
    """
    docs = _table(spark, sf_dir, "documents")
    top = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"))
    opens = F.regexp_extract("text", r"^[^\n]*", 0).rlike("(?i)licen[cs]e")
    name = F.when(opens, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat_ws("/", F.floor(F.col("doc_id") / 100).cast("string"), F.concat("doc_id", F.lit(".txt"))))
    found = licenses.scan_licenses(docs.withColumn("path", F.concat_ws("/", top, name)))
    return found.select("path", F.array_join("licenses", " ").alias("licenses"), "origin", "distance")


def op9_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label at cosine 0.93."""
    return grid_join.embedding_links(_table(spark, sf_dir, "embeddings"))


def op10_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return site_templates.extract_main_text(_table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt to open with the first turns of one in twenty."""
    turns = _table(spark, sf_dir, "conversations").filter("conv_id IS NOT NULL")
    turns = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", prefix_trie.turn_id(F.col("role"), F.col("text")).alias("id"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    turns = Scratch(spark, "rebuilt").save(turns.select("conv_id", "id", F.row_number().over(order).alias("no")), "turns")
    members = turns.select("conv_id").distinct()
    borrowed = lambda c: F.crc32(c.cast("string").cast("binary")) % 4
    heads = turns.filter("conv_id % 20 = 0 AND no <= 3").select(F.col("conv_id").alias("donor"), "id", F.col("no").alias("turn"))
    heirs = members.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("donor"))
    heads = heirs.join(heads, "donor").filter(F.col("turn") <= borrowed(F.col("conv_id"))).select("conv_id", "turn", "id")
    own = turns.filter(F.col("no") > borrowed(F.col("conv_id"))).select("conv_id", F.col("no").alias("turn"), "id")
    return prefix_trie.prefix_trie(heads.union(own), members)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as codes of eight parts, with their errors and the digest of the codebooks."""
    return vector_codes.code_report(_table(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and rules of all documents, and the verdict of the perplexity bands of their language."""
    return perplexity.rate_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_chat": op2_chat,
    "op3_separators": op3_separators,
    "op4_ngram_join": op4_ngram_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_grid_join": op9_grid_join,
    "op10_site_templates": op10_site_templates,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_quality_rules": op13_quality_rules,
}

SQL: dict[str, str] = {}

SQL["op2_chat"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       -- six code points open a turn, one ends its role, eight close it; a backslash and a < take two
       sum(15 + length(role) + length(text) + length(text) - length(replace(replace(text, '\', ''), '<', '')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

SQL["op5_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents
), worded AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines
), placed AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY no) AS upto FROM worded WHERE words > 0
), windows AS (
    SELECT doc_id, no, max(no) OVER run AS last, list(line) OVER run AS content, sum(words) OVER run AS total
    FROM placed WINDOW run AS (PARTITION BY doc_id ORDER BY upto - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION ALL
    SELECT doc_id, min(no) OVER run, no, list(line) OVER run, sum(words) OVER run
    FROM placed WINDOW run AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), later AS (
    SELECT doc_id, no, last FROM windows WHERE total >= 50
    -- a place may hold one window of either kind: both have the same rank
    QUALIFY rank() OVER (PARTITION BY content ORDER BY doc_id, no) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(no, last)) AS no FROM later
), left_over AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.no) FILTER (g.no IS NULL) AS text, count(*) AS n_lines, count(g.no) AS n_removed
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN left_over o ON d.doc_id = o.doc_id
"""

SQL["op8_licenses"] = r"""
WITH files AS (
    SELECT doc_id, concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR) AS top,
           regexp_matches(split_part(text, chr(10), 1), 'licen[cs]e', 'i') AS opens, string_split(text, chr(10)) AS lines
    FROM documents
), owned AS (
    SELECT *, CASE WHEN list_contains(lines, 'Licensed under the Apache License, Version 2.0.') THEN 'Apache-2.0'
                   WHEN list_contains(lines, 'Released under the MIT License.') THEN 'MIT'
                   WHEN list_contains(lines, 'This work is licensed under the GNU General Public License, version 3.') THEN 'GPL-3.0'
                   WHEN list_contains(lines, 'Licensed under CC BY-NC 4.0.') THEN 'CC-BY-NC-4.0' END AS own,
           CASE WHEN opens THEN top || '/LICENSE-' || doc_id ELSE top || '/' || (doc_id // 100) || '/' || doc_id || '.txt' END AS path
    FROM files
), declared AS (
    SELECT top, string_agg(DISTINCT own, ' ' ORDER BY own) AS names FROM owned WHERE opens AND own IS NOT NULL GROUP BY top
)
SELECT path, coalesce(own, names, '') AS licenses,
       CASE WHEN own IS NOT NULL THEN 'own' WHEN names IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own IS NULL AND names IS NOT NULL THEN CASE WHEN opens THEN 0 ELSE 1 END END::INTEGER AS distance
FROM owned LEFT JOIN declared USING (top)
"""

SQL["op11_prefix_trie"] = r"""
WITH RECURSIVE placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS no
    FROM conversations WHERE conv_id IS NOT NULL
), members AS (
    -- CRC-32 by its rule: every byte is followed by eight shifts
    SELECT conv_id, (xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)))::BIGINT % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS (
    SELECT m.conv_id, p.no, p.role, p.text FROM members m JOIN placed p ON p.conv_id = m.conv_id - m.conv_id % 20 AND p.no <= m.h
    UNION ALL SELECT m.conv_id, p.no, p.role, p.text FROM members m JOIN placed p ON p.conv_id = m.conv_id AND p.no > m.h
), paths AS (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY no) AS path FROM rebuilt GROUP BY conv_id
), whole AS (
    SELECT m.conv_id, coalesce(path, []) AS path FROM members m LEFT JOIN paths p ON p.conv_id = m.conv_id
), prefixes AS (
    SELECT conv_id, unnest(generate_series(0, len(path))) AS depth, path FROM whole
), spots AS (
    SELECT conv_id, depth, md5(path[:depth]::VARCHAR) AS prefix, md5(path[:depth - 1]::VARCHAR) AS above, len(path) = depth AS ends,
           CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM prefixes
), nodes AS (
    SELECT depth, prefix, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM spots GROUP BY depth, prefix
), hung AS (
    SELECT c.*, p.conv_id AS parent_conv_id FROM nodes c LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.prefix = c.above
), children AS (
    SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM hung WHERE depth > 0 GROUP BY ALL
), up AS (
    SELECT depth, conv_id, depth AS of_depth, conv_id AS of_conv FROM nodes
    UNION ALL SELECT h.depth - 1, h.parent_conv_id, u.of_depth, u.of_conv FROM up u JOIN hung h ON h.depth = u.depth AND h.conv_id = u.conv_id WHERE h.depth > 0
), below AS (
    SELECT u.depth, u.conv_id, sum(n.own) AS saved_tokens, count(*) FILTER (c.n_children IS NULL) AS n_leaves
    FROM up u JOIN nodes n ON n.depth = u.of_depth AND n.conv_id = u.of_conv
    LEFT JOIN children c ON c.depth = u.of_depth AND c.conv_id = u.of_conv GROUP BY u.depth, u.conv_id
)
SELECT h.conv_id, h.depth, h.parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM hung h JOIN below b ON b.depth = h.depth AND b.conv_id = h.conv_id
LEFT JOIN children c ON c.depth = h.depth AND c.conv_id = h.conv_id
"""


def _codes_sql(rounds: int) -> str:
    """Plain Lloyd steps: all distances of all parts in each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
    SELECT c.vec_id, p, b.k, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS error FROM cells c JOIN book{r} b USING (p, i) GROUP BY c.vec_id, p, b.k
    QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY error, b.k) = 1
)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
    SELECT b.p, b.k, b.i, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
        SELECT p, n.k, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM cells JOIN near{r} n USING (vec_id, p) GROUP BY p, n.k, i
    ) m USING (p, k, i)
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, embedding, len(embedding) // 8 AS width, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
    SELECT vec_id, place, j // width AS p, j % width AS i, floor(4096 * embedding[j + 1]::DOUBLE)::BIGINT AS x
    FROM (SELECT *, unnest(generate_series(0, len(embedding) - 1)) AS j FROM kept)
), book0 AS MATERIALIZED (SELECT p, place AS k, i, x FROM cells WHERE place < 16),{",".join(steps)},
coded AS (
    SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(error)::BIGINT AS error FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, k, i)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


SQL["op12_vector_codes"] = _codes_sql(6)
