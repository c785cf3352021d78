"""The operators as queries over the sample tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.llm import chat, divergence, language, lm, mixing, neardup, packing, phrases, quality, sharding, topk, toxicity, warc
from trafficloom.llm.common import WORD, new_folder, shipped, stored, table, word_count


#: Names and weights of the shards of the sharding query; one is twice as large.
SHARDS = {f"shard-{k:02d}": 2 if k == 0 else 1 for k in range(48)}


def table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, whole, written in a folder per shard and read back from there."""
    path = f"{new_folder(spark, 'shards')}/rows"
    docs = table(spark, sf_dir, "documents")
    sharding.write_shards(docs, "doc_id", SHARDS, path, files=4)
    shards = spark.read.schema(T.StructType([*docs.schema]).add("slot", "long").add("shard", "string")).parquet(path)
    return shards.select("doc_id", "slot", "shard", "source", F.octet_length("text").cast("long").alias("text_bytes"))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    page = lambda name: F.regexp_extract(name, r"^<urn:x-page:(-?\d+)>$", 1)
    number = lambda name: F.when(page(name) != "", page(name).cast("long"))
    return records.filter(F.col("type").isin("response", "revisit")).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
        "target_uri",
    )


def as_mails(messages: DataFrame) -> DataFrame:
    """The messages as mails: each quotes the message of the turn before, and in it the one
    before that, as it is, wrapped anew, or without its first and last two words."""
    spoken = messages.groupBy("conv_id", "turn").agg(F.min(F.struct("text", "role")).alias("said"))
    for back in (1, 2):
        before = spoken.select(
            F.col("conv_id").alias("c"), (F.col("turn") + back).alias("t"), F.col("said.text").alias(f"text_{back}"), F.col("said.role").alias(f"role_{back}")
        )
        messages = messages.join(before, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left").drop("c", "t")
    long = word_count(F.col("text_1")) >= 12
    wrapped = F.regexp_replace(F.regexp_replace("text_1", r"\s+", " "), r"((?:[^ ]+ ){4}[^ ]+) ", "$1\n")
    inner = F.regexp_replace(F.regexp_replace("text_1", r"^\s*\S+\s+\S+\s+", ""), r"\s+\S+\s+\S+\s*$", "")
    shown = F.when((F.col("turn") % 3 == 0) & long, inner).when(F.col("turn") % 3 == 2, wrapped).otherwise(F.col("text_1"))

    def quoted(back: int, text, marker: str):
        head = F.concat(F.lit("On turn "), (F.col("turn") - back).cast("string"), F.lit(", "), F.coalesce(f"role_{back}", F.lit("nobody")), F.lit(" wrote:"))
        lines = F.concat(F.lit(marker), F.regexp_replace(text, "\n", f"\n{marker}"))
        return F.when(F.col(f"text_{back}").rlike(WORD), F.concat(F.lit("\n" + marker[:-2]), head, F.lit("\n"), lines))

    text = F.coalesce("text", F.lit(""))
    mail = F.concat(text, F.lit("\n"), F.coalesce(quoted(1, shown, "> "), F.lit("")), F.coalesce(quoted(2, F.col("text_2"), "> > "), F.lit("")))
    return messages.select("conv_id", "turn", "role", mail.alias("text"))


def quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations come back from mails that quote each other: texts without quotations,
    which message each replies to, and their order."""
    return chat.reply_ordered(stored(as_mails(table(spark, sf_dir, "conversations")), "chat-mails"))


def language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages together: the text model is fitted on labelled documents, the
    evidence of declarations, suffixes and hosts comes from both."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, "doc_id", "text", "lang")
    pages = table(spark, sf_dir, "pages")
    address = language.address_parts(F.col("url"))
    of_pages = language.with_evidence(
        pages, model, language.visible_text(F.col("html")), language.declared_in(F.col("html")), **address
    )
    no_id = F.lit(None).cast("long")
    evidence = stored(
        language.document_evidence(docs, model)
        .select("doc_id", no_id.alias("page_id"), "evidence")
        .union(of_pages.select(no_id.alias("doc_id"), "page_id", "evidence")),
        "language-evidence",
    )
    verdicts = language.judged(evidence, model, language.tables_of(evidence, len(model.classes)))
    return verdicts.select("doc_id", "page_id", "language_of.language", "language_of.posterior", F.col("language_of.accepted").alias("kept"))


def context_mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=50, k=5)


def rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.ledger(table(spark, sf_dir, "documents"))
    base_failed = F.col("failures").bitwiseAND(F.lit(quality.BASE).cast("long")) != 0
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality.passes()).alias("kept"),
        "n_lines",
        "failures",
        F.lit(quality.CURRENT.version).alias("policy"),
        *(quality.passes(p).alias(f"kept_by_{p.version.replace('-', '_')}") for p in quality.POLICIES),
        quality.sole_failure().alias("sole_rule"),
    )


def target_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stored(mixing.sized(table(spark, sf_dir, "documents")), "mix-sizes")
    copied = mixing.with_copies(sizes, mixing.source_rates(sizes))
    return copied.select(
        "doc_id",
        "size",
        F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def bayesian_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def burst_trie_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_table_sharding": shipped(table_sharding),
    "op2_warc_round_trip": shipped(warc_round_trip),
    "op3_quotation_threads": shipped(quotation_threads),
    "op4_language_fusion": shipped(language_fusion),
    "op5_context_mixing_scores": shipped(context_mixing_scores),
    "op6_pattern_packing": shipped(pattern_packing),
    "op7_pivot_top_k": shipped(pivot_top_k),
    "op8_rule_ledger": shipped(rule_ledger),
    "op9_target_mix": shipped(target_mix),
    "op10_bayesian_near_duplicates": shipped(bayesian_near_duplicates),
    "op11_burst_trie_phrases": shipped(burst_trie_phrases),
    "op12_source_divergence": shipped(source_divergence),
    "op13_counterfactual_toxicity": shipped(counterfactual_toxicity),
}

#: Words, lines and windows are listed per row; a window is its eight words joined by blanks.
RULE_LEDGER_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), listed AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT r, k, array_to_string(words[k:k + 7], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS k FROM listed WHERE len(words) >= 8)
), found AS (
    SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), gaps AS (
    SELECT r, least(8, coalesce(lead(k) OVER (PARTITION BY r ORDER BY k) - k, 8)) AS gap FROM found
), repeated AS (
    SELECT r, sum(gap) AS n FROM gaps GROUP BY r
), measured AS (
    SELECT doc_id, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words
    FROM listed LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
           + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (word_chars < 2 * n_words)::INT
           + 16 * (word_chars > 20 * n_words)::INT + 32 * (2 * n_dup_lines > n_lines)::INT AS failures
    FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, n_lines::BIGINT AS n_lines,
       failures::BIGINT AS failures, '2025-full' AS policy,
       failures & 3 = 0 AS kept_by_2024_base, failures & 7 = 0 AS kept_by_2024_symbols, failures = 0 AS kept_by_2025_full,
       CASE failures WHEN 1 THEN 'too_few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbol_heavy'
            WHEN 8 THEN 'short_words' WHEN 16 THEN 'long_words' WHEN 32 THEN 'repeated_lines' END AS sole_rule
FROM judged
"""

TARGET_MIX_SQL = r"""
WITH sized AS (
    SELECT row_number() OVER () AS r, doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, 2.0::DOUBLE * source_size AS room,
           [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM totals
), placed AS (
    SELECT *, row_number() OVER (ORDER BY room / weight, source NULLS LAST) AS place FROM weighed
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(room) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM placed
    WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
    SELECT arg_min(level, place) AS level FROM levels WHERE level <= room / weight
), targets AS (
    SELECT source, source_size, coalesce(least(room, (SELECT level FROM chosen) * weight), room) AS target
    FROM weighed
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
), coins AS (
    SELECT r, seed, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || seed // 4), 1 + 8 * (seed % 4), 8))::BIGINT
                    / 4294967296.0::DOUBLE AS coin
    FROM sized, range(16) AS s(seed)
), drawn AS (
    SELECT r, d.source, size, source_size, target, seed, floor(rate)::BIGINT + (coin < rate - floor(rate))::BIGINT AS copies
    FROM sized AS d JOIN rates AS t ON d.source IS NOT DISTINCT FROM t.source JOIN coins USING (r)
), tried AS (
    SELECT source, seed, abs(sum(size * copies) - any_value(target)) AS missed FROM drawn GROUP BY ALL
), seeds AS (
    SELECT source, seed FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY missed, seed) = 1
)
SELECT doc_id, d.size, source_size, target, (d.size * copies)::BIGINT AS taken, copies
FROM drawn AS d JOIN seeds AS s ON d.source IS NOT DISTINCT FROM s.source AND d.seed = s.seed
JOIN sized USING (r)
"""

#: Five hexadecimal digits of the digest are twenty bits, which are four letters in base 32.
WARC_SQL = """
WITH digested AS (
    SELECT page_id, url, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages
), coded AS (
    SELECT *, max(page_id) OVER (PARTITION BY digest) AS largest,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(digest, 1 + 5 * (k // 4)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31)::INT, 1)
               FOR k IN range(32)], '') AS base32
    FROM digested
)
SELECT page_id, bytes::BIGINT AS payload_bytes, base32 AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to,
       url AS target_uri
FROM coded
"""

#: What the mails were made of: turns of a conversation follow each other without a gap.
QUOTATION_THREADS_SQL = """
WITH chained AS (
    SELECT *, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM conversations
), placed AS (
    SELECT *, min(turn) OVER thread AS first, row_number() OVER (thread ORDER BY turn) - 1 AS nth
    FROM chained WINDOW thread AS (PARTITION BY conv_id, run)
)
SELECT conv_id, turn, role, text, least(nth, 2)::INT AS n_quotes, least(nth, 2)::BIGINT AS n_linked,
       CASE WHEN nth > 0 THEN turn - 1 END AS parent_turn, first AS thread_root, nth::INT AS depth
FROM placed
"""

PIVOT_TOP_K_SQL = """
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, q.r AS query, c.vec_id, c.r,
           coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
    FROM vectors AS q JOIN vectors AS c ON q.vec_id % 50 = 0 AND q.r <> c.r
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

#: Words hold no blank, so a phrase is its words joined by blanks.
BURST_TRIE_PHRASES_SQL = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents WHERE text IS NOT NULL
), pieces AS (
    SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM texts
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), counted AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
    FROM starts, range(1, 6) AS t(m) WHERE i + m - 1 <= len(w) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, m, phrase, f AS a, n, string_split(phrase, ' ') AS w FROM counted JOIN totals USING (lang)
    WHERE m >= 2 AND f >= 100
), cuts AS (
    SELECT *, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
), scores AS (
    SELECT c.lang, c.phrase, a, n, k, x.f AS l, y.f AS r, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts AS c JOIN counted AS x ON x.lang = c.lang AND x.phrase = first
    JOIN counted AS y ON y.lang = c.lang AND y.phrase = rest
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM candidates), range(2, 5) AS t(s)
    WHERE s < m AND i + s - 1 <= m GROUP BY ALL
), kept AS (
    SELECT l.* FROM lowest AS l LEFT JOIN inside USING (lang, phrase)
    WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM kept
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000
"""
SOURCE_DIVERGENCE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counted AS (
    SELECT r, lang, source, term, count(*) AS c FROM (SELECT r, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(c)::BIGINT AS total FROM counted GROUP BY lang, term HAVING count(*) >= 3
), sizes AS (
    SELECT lang, count(*) AS v, sum(total)::BIGINT AS n FROM kept GROUP BY lang
), own AS (
    SELECT lang, source, term, sum(c)::BIGINT AS c FROM counted JOIN kept USING (lang, term) GROUP BY ALL
), whole AS (
    SELECT lang, source, coalesce(sum(c), 0)::BIGINT AS n FROM groups LEFT JOIN own USING (lang, source) GROUP BY ALL
), chances AS (
    SELECT w.lang, w.source, term, coalesce(c, 0) AS c,
           1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (w.n + v) AS p,
           1 + (1000000000::HUGEINT * (total + 1)) // (s.n + v) AS q
    FROM whole AS w JOIN sizes AS s USING (lang) JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)
), compared AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM chances AS a JOIN chances AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN compared AS c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM chances WHERE c > 0 AND p > q
)
SELECT *, (row_number() OVER best)::INT AS rank FROM found
WINDOW best AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR row_number() OVER best <= 200
"""

ORACLES: dict[str, str] = {
    "op2_warc_round_trip": WARC_SQL,
    "op3_quotation_threads": QUOTATION_THREADS_SQL,
    "op7_pivot_top_k": PIVOT_TOP_K_SQL,
    "op8_rule_ledger": RULE_LEDGER_SQL,
    "op9_target_mix": TARGET_MIX_SQL,
    "op11_burst_trie_phrases": BURST_TRIE_PHRASES_SQL,
    "op12_source_divergence": SOURCE_DIVERGENCE_SQL,
}
