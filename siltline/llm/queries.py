"""The operators over whole tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline import scratch
from siltline.llm import bpe, chat, decontaminate, html_extract, line_crf, lm_score, piece_bpe, quality_rules
from siltline.llm import secrets, simhash, spelling, turn_repair, warc

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(VOCABULARY)
    found = bpe.encode(docs, "text", path, public_tokenizers.PATTERN, "ids", "decoded")
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        bpe.digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def lm_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    log10 = F.col("micro_log10") / F.lit(1e6)
    return found.select(
        "doc_id", "n_words", "n_backoff", log10.alias("log10_score"),
        F.when(F.col("n_words") > 0, log10 / F.col("n_words")).alias("log10_per_word"),
    )


LM_STUPID_BACKOFF_SQL = r"""
    WITH lists AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS l
        FROM documents
    ), words AS (
        SELECT doc_id, unnest(l) AS w, unnest(range(len(l))) AS i FROM lists
    ), pairs AS (
        SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM words
    ), singles AS (SELECT w, count(*) AS n FROM words GROUP BY w),
    doubles AS (SELECT p, w, count(*) AS n FROM pairs WHERE p IS NOT NULL GROUP BY p, w),
    total AS (SELECT count(*) AS n FROM words),
    terms AS (
        SELECT pairs.doc_id, pairs.p IS NOT NULL AND doubles.n < 2 AS backed,
            CASE WHEN pairs.p IS NULL THEN own.n / total.n
                WHEN doubles.n >= 2 THEN doubles.n / before.n
                ELSE 0.4::DOUBLE * (own.n / total.n) END AS s
        FROM pairs CROSS JOIN total JOIN singles own ON own.w = pairs.w
        LEFT JOIN singles before ON before.w = pairs.p
        LEFT JOIN doubles ON doubles.p = pairs.p AND doubles.w = pairs.w
    ), sums AS (
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (backed) AS n_backoff,
            sum(round_even(1000000 * log10(s), 0)::BIGINT)::BIGINT AS micro
        FROM terms GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff,
        coalesce(micro, 0) / 1e6::DOUBLE AS log10_score,
        CASE WHEN n_words > 0 THEN micro / 1e6::DOUBLE / n_words END AS log10_per_word
    FROM lists LEFT JOIN sums USING (doc_id)
"""


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    best = F.max_by(F.struct("start", "words"), F.struct("similarity", -F.col("start"))).alias("w")
    found = found.groupBy(F.col("_row.doc_id").alias("doc_id"), "item_id").agg(
        best, F.max("similarity").alias("similarity"), F.count_distinct("start").alias("n_windows")
    )
    return found.select(
        "doc_id", "item_id", F.col("w.start").cast("bigint").alias("start_word"),
        F.col("w.words").cast("bigint").alias("n_words"), "similarity", "n_windows",
    )


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "archive")
    warc.write(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    found = warc.read_pages(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_ARCHIVE_SQL = """
    WITH payloads AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (
        SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM payloads LEFT JOIN firsts USING (payload_digest)
"""


def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_extract.extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = quality_rules.assess(docs, ["doc_id"]).select("doc_id", "quality.*")
    distances = ("char_distance", "word_distance")
    return found.withColumns({c: F.round(c, 6) for c in distances})


_CLASSES = ("a-z", "A-Z", "0-9", r"\x20\x09-\x0D", r"#*$%&|<>", r".,;:!?'\"()\-")
_COUNTS = ", ".join(
    "length(t) - length(regexp_replace(t, '[{}]', '', 'g'))".format(c.replace("'", "''")) for c in _CLASSES
)
_LISTS = " ".join(
    f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in quality_rules.COMMON_WORDS.items()
)


def _js(a: str, b: str) -> str:
    """Jensen-Shannon distance of two lists of counts in SQL."""
    pairs = f"list_zip(list_transform({a}, lambda x: x / list_sum({a})), list_transform({b}, lambda x: x / list_sum({b})))"
    term = "CASE WHEN z[{0}] > 0 THEN z[{0}] * log2(2 * z[{0}] / (z[1] + z[2])) / 2 ELSE 0 END"
    sums = f"list_sum(list_transform({pairs}, lambda z: {term.format(1)} + {term.format(2)}))"
    return f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest({sums}, 0)) END"


QUALITY_DIVERGENCE_SQL = rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS t,
            CASE WHEN lang IN ('de', 'en', 'es', 'fr') THEN lang ELSE 'other' END AS language
        FROM documents
    ), counted AS (
        SELECT doc_id, language, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, length(t) AS n, [{_COUNTS}] AS c,
            regexp_split_to_array(lower(t), '[^\p{{L}}]+') AS plain, CASE language {_LISTS} END AS common,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM texts
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM counted)
    ), repeated AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) CROSS JOIN range(8) r(k)
        WHERE n > 1 GROUP BY doc_id
    ), hits AS (
        SELECT *, len(words) AS n_words, list_append(c, n - list_sum(c)) AS chars,
            list_transform(common, lambda x: len(list_filter(plain, lambda y: y = x))) AS h
        FROM counted
    ), shaped AS (
        SELECT *, CASE WHEN h IS NOT NULL THEN list_append(h, greatest(n_words - list_sum(h), 0)) END AS bins FROM hits
    ), shares AS (
        SELECT language, 'c' AS kind, unnest(range(1, len(chars) + 1)) AS k,
            unnest(list_transform(chars, lambda x: floor(x * 1000000 / greatest(list_sum(chars), 1)))) AS share
        FROM shaped WHERE n_words >= {quality_rules.CHAR_GUARD}
        UNION ALL
        SELECT language, 'b', unnest(range(1, len(bins) + 1)),
            unnest(list_transform(bins, lambda x: floor(x * 1000000 / greatest(list_sum(bins), 1))))
        FROM shaped WHERE n_words >= {quality_rules.CHAR_GUARD} AND bins IS NOT NULL
    ), sums AS (
        SELECT language, kind, k, sum(share) AS share FROM shares GROUP BY ALL
    ), refs AS (
        SELECT language, list(share ORDER BY k) FILTER (kind = 'c') AS rc, list(share ORDER BY k) FILTER (kind = 'b') AS rb
        FROM sums GROUP BY language
    ), judged AS (
        SELECT doc_id, n_words, n - c[4] AS word_chars, c[5] AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words, {_js('chars', 'rc')} AS cd, {_js('bins', 'rb')} AS bd
        FROM shaped LEFT JOIN refs USING (language) LEFT JOIN repeated USING (doc_id)
    ), based AS (
        SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
        FROM judged
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
        round(cd, 6) AS char_distance, round(bd, 6) AS word_distance, base_failed,
        NOT base_failed
            AND NOT (n_words >= {quality_rules.CHAR_GUARD} AND coalesce(cd, 0) > {quality_rules.MAX_CHAR_DISTANCE})
            AND NOT (n_words >= {quality_rules.WORD_GUARD} AND coalesce(bd, 0) > {quality_rules.MAX_WORD_DISTANCE}) AS kept
    FROM based
"""


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, sliding=True)

    def count(kind: str):
        number = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "_row.doc_id",
        *[count(kind) for kind in secrets.STRONG],
        F.sha2(secrets.described(F.col("base")), 256).alias("base_sha256"),
        secrets.described(F.col("spans")).alias("spans"),
    )


def chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(_table(spark, sf_dir, "conversations"))


CHAT_SNAPSHOTS_SQL = r"""
    WITH turns AS (
        SELECT DISTINCT conv_id, coalesce(turn, -1) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), whole AS (
        SELECT conv_id, list({'p': place, 'r': role, 't': text} ORDER BY place, role, text) AS l FROM turns GROUP BY conv_id
    ), firsts AS (
        SELECT l, min(conv_id) AS conv_id FROM whole GROUP BY l
    ), prefixes AS (
        SELECT DISTINCT l[:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM whole)
        WHERE l[k].p < l[k + 1].p
    ), kept AS (
        SELECT conv_id FROM firsts ANTI JOIN prefixes USING (l)
    ), numbered AS (
        SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY floor(place / 1024)) - 1 AS part
        FROM turns SEMI JOIN kept USING (conv_id)
    )
    SELECT conv_id, part::BIGINT AS part, count(*)::BIGINT AS n_turns,
        string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place, role, text) AS text
    FROM numbered GROUP BY conv_id, part
"""


def line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~line_crf.held_out(F.col("doc_id")))
    score = line_crf.scorer(line_crf.train(docs, labels))
    found = docs.select("doc_id", line_crf.held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the log; those of which no row is left have nothing to repair."""
    log = _table(spark, sf_dir, "conversations")
    found = turn_repair.report(turn_repair.damaged(log))
    lost = log.select(F.col("conv_id").alias("conv")).distinct().withColumn("repaired_sha256", F.sha2(F.lit(""), 256))
    found = found.unionByName(lost.join(found, lost.conv.eqNullSafe(found.conv), "left_anti"), allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        F.col("conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), "repaired_sha256",
    )


def piece_bpe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = piece_bpe.encode(docs, "text", public_tokenizers.path(PIECES), "ids", "decoded")
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        piece_bpe.digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_byte_bpe": byte_bpe,
    "op2_lm_stupid_backoff": lm_stupid_backoff,
    "op3_benchmark_decontamination": benchmark_decontamination,
    "op4_warc_archive": warc_archive,
    "op5_quality_divergence": quality_divergence,
    "op6_secret_scan": secret_scan,
    "op7_chat_snapshots": chat_snapshots,
    "op8_line_crf_quality": line_crf_quality,
    "op9_simhash_near_dedup": simhash_near_dedup,
    "op10_html_main_text": html_main_text,
    "op11_conversation_repair": conversation_repair,
    "op12_sentencepiece": piece_bpe_ids,
    "op13_spelling_variants": spelling_variants,
}

ORACLES: dict[str, str] = {
    "op2_lm_stupid_backoff": LM_STUPID_BACKOFF_SQL,
    "op4_warc_archive": WARC_ARCHIVE_SQL,
    "op5_quality_divergence": QUALITY_DIVERGENCE_SQL,
    "op7_chat_snapshots": CHAT_SNAPSHOTS_SQL,
}
