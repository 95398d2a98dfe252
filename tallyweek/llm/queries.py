"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    exact_dedup,
    html_text,
    jaccard_join,
    language_id,
    merkle_log,
    mixing,
    periodic_runs,
    ppm,
    prefix_tokens,
    quality_rules,
    sharding,
    substring_dedup,
)
from .common import WORD, crc_of_id, table

#: Documents of more tokens are over the limit.
TOKEN_LIMIT = 4096


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.removal(table(spark, sf_dir, "documents"), texts=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def corpus_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ppm.scored(docs, ppm.training(docs))
    return found.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify_all(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def planted_repetitions(docs: DataFrame) -> DataFrame:
    """doc_id and text, the tail of about every tenth text being the repetition of its first words.

    With h the id's crc32 and g = floor(h / 10), the words from a = g mod n on repeat every
    p = 1 + floor((n - a) / (3 + g mod 8)) words where 10 divides h; the other texts are as they are.
    """
    tenth = F.col("h") % 10 == 0
    hashed = docs.select("doc_id", "text", crc_of_id(F.col("doc_id")).alias("h"))
    split = hashed.withColumns(
        {"words": F.when(tenth, F.filter(F.split("text", WORD.replace("[^", "[")), lambda w: w != "")), "g": F.expr("h div 10")}
    )
    sized = split.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    placed = sized.withColumns({"a": F.col("a").cast("int"), "p": period})
    left = F.col("n") - F.col("a")
    copies = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))
    words = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(copies), F.lit(1), left))
    return placed.select("doc_id", F.when(tenth & (F.col("n") > 0), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row the number of runs, the one with most periods, and digests of all runs and of the collapsed words."""
    found = periodic_runs.find_runs(docs)
    # runs come by start, then period, so the first of equals stays
    most = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("most", most).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "most.*",
        F.expr("1000 * most.length div most.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(planted_repetitions(table(spark, sf_dir, "documents")))


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(table(spark, sf_dir, "documents"))


def verified_manifest(docs: DataFrame, levels: int = merkle_log.LEVELS) -> DataFrame:
    """Every document's proof, checked with its text, of every second document without line feeds."""

    def leaf(text):
        return merkle_log.digest_of([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text])

    touched = (crc_of_id(F.col("doc_id")) % 2 == 0) & F.col("text").contains("\n")
    tampered = F.when(touched, leaf(F.translate("text", "\n", "")))
    leaves = docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), tampered.alias("tampered"))
    proofs = merkle_log.manifest(leaves, "source", "doc_id", "leaf", levels).proofs()
    checked = proofs.withColumn("folded_root", merkle_log.folded(F.coalesce("tampered", "leaf"), F.col("siblings")))
    return checked.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle_log.proof_digest(F.col("siblings")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_tokens.token_counts(table(spark, sf_dir, "documents"), piece_model_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES = {
    "op1_mix_sources": mix_sources,
    "op2_substring_dedup": repeated_passages,
    "op3_shard_documents": shard_documents,
    "op4_ngram_jaccard": near_copies,
    "op5_exact_dedup": exact_copies,
    "op6_bpe_round_trip": bpe_round_trip,
    "op7_ppm_score": corpus_scores,
    "op8_language_id": language,
    "op9_quality_rules": quality,
    "op10_html_text": page_text,
    "op11_periodic_runs": repetitions,
    "op12_merkle_manifest": dataset_manifest,
    "op13_prefix_tokens": token_counts,
}

SIZED = r"""
sized AS (
    SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
    FROM documents
)"""

ORACLES = {
    "op1_mix_sources": f"""
WITH {SIZED},
totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
),
-- sources fill up in the order of most-possible per weight; the level after each is what the rest would get
filling AS (
    SELECT *, 3 * source_size / weight AS fills_at,
        (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level,
        row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place
    FROM totals
    WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT arg_min(level, place) FILTER (WHERE fills_at > level) AS level FROM filling),
targets AS (
    SELECT source, source_size,
        CASE WHEN level IS NULL OR fills_at <= level THEN (3 * source_size)::DOUBLE ELSE weight * level END AS target
    FROM (SELECT f.source, f.source_size, f.weight, f.fills_at, l.level FROM filling f, level l)
),
lined AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, least(3 * t.source_size, round(t.target)::BIGINT) AS words,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '')), s.size) - s.size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (greatest(least(words - start, size), 0) + greatest(least(words - start - source_size, size), 0)
        + greatest(least(words - start - 2 * source_size, size), 0))::BIGINT AS taken
FROM lined
""",
    "op2_substring_dedup": r"""
WITH split AS (
    SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS words FROM documents
),
starts AS (
    SELECT doc_id, unnest(range(1, len(words) - 11)) AS place, words FROM split WHERE len(words) >= 13
),
windows AS (SELECT doc_id, place, md5(array_to_string(words[place:place + 12], ' ')) AS window_hash FROM starts),
earliest AS (SELECT doc_id, place, min(doc_id) OVER (PARTITION BY window_hash) AS first_id FROM windows),
covered AS (
    SELECT DISTINCT doc_id, place + step AS place FROM earliest, range(0, 13) steps(step) WHERE first_id < doc_id
),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split),
kept AS (
    SELECT p.doc_id, count(c.place) AS n_removed, string_agg(p.word, ' ' ORDER BY p.place) FILTER (WHERE c.place IS NULL) AS words
    FROM placed p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.place = c.place GROUP BY p.doc_id
)
SELECT s.doc_id, len(s.words) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.words, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
""",
    "op4_ngram_jaccard": r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(words[place:place + 3], ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS place FROM split WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common_counts AS (
    SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT one, other FROM common_counts JOIN sizes x ON one = x.doc_id JOIN sizes y ON other = y.doc_id
    WHERE 100 * common >= 85 * (x.n + y.n - common)
),
reached(doc_id, met) AS (
    SELECT doc_id, doc_id FROM split UNION SELECT r.doc_id, l.other FROM reached r JOIN links l ON r.met = l.one
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(met) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""",
    "op5_exact_dedup": """
WITH folded AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(folded) AS text_sha256
FROM folded WINDOW same AS (PARTITION BY folded)
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE crcs AS (
    -- crc32 of the id's digits, bit by bit
    SELECT DISTINCT doc_id, xor(list_reduce(
        [4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
        lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda r, bit: xor(r >> 1, 3988292384 * (r & 1)))
    ), 4294967295) AS crc
    FROM documents WHERE doc_id IS NOT NULL
),
parts AS (
    SELECT d.doc_id, source, text, coalesce(crc, 0) % 2 = 0 AS tampers, list_transform(
        [d.doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
        lambda v: CASE WHEN v IS NULL THEN '-' ELSE strlen(v)::VARCHAR || ':' || v END
    ) AS parts
    FROM documents d LEFT JOIN crcs c ON d.doc_id = c.doc_id
),
digests AS (
    SELECT doc_id, source, sha256(array_to_string(parts, '') || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
        CASE WHEN tampers AND text IS NOT NULL THEN
            sha256(array_to_string(parts, '') || strlen(replace(text, chr(10), ''))::VARCHAR || ':' || replace(text, chr(10), ''))
        END AS tampered
    FROM parts
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS n
    FROM digests
),
nodes(source, level, place, n, digest) AS (
    SELECT source, 0, place, n, leaf FROM leaves
    UNION ALL
    SELECT source, level + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY source, level, place // 3
),
sources AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
tops(level, place, n, digest) AS (
    SELECT 0, place, n, subroot FROM sources
    UNION ALL
    SELECT level + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place // 3
),
beside AS (
    SELECT a.source, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
    FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.place // 3 = b.place // 3
    WHERE a.n > 1 GROUP BY a.source, a.level, a.place
),
beside_top AS (
    SELECT a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
    FROM tops a JOIN tops b ON a.level = b.level AND a.place // 3 = b.place // 3
    WHERE a.n > 1 GROUP BY a.level, a.place
),
paths AS (
    SELECT l.source, l.place, list(before || '|' || after ORDER BY level) AS steps
    FROM leaves l JOIN beside b ON l.source IS NOT DISTINCT FROM b.source AND l.place // pow(3, b.level)::BIGINT = b.place
    GROUP BY l.source, l.place
),
top_paths AS (
    SELECT s.source, list(before || '|' || after ORDER BY level) AS steps
    FROM sources s JOIN beside_top b ON s.place // pow(3, b.level)::BIGINT = b.place GROUP BY s.source
),
proven AS (
    SELECT l.doc_id, l.leaf, l.tampered, s.subroot, r.digest AS root, coalesce(p.steps, []) || coalesce(t.steps, []) AS steps
    FROM leaves l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source
    JOIN (SELECT digest FROM tops WHERE n = 1) r ON true
    LEFT JOIN paths p ON l.source IS NOT DISTINCT FROM p.source AND l.place = p.place
    LEFT JOIN top_paths t ON l.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM (
    SELECT *, list_reduce([coalesce(tampered, leaf)] || steps, lambda node, step: sha256(split_part(step, '|', 1) || node || split_part(step, '|', 2)))
        AS folded_root FROM proven
)
""",
}
