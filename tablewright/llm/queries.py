"""The registered queries of this package: one per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import byte_bpe, chat, decontam, hard_negatives, licenses, lm_score, mixing, neighbours, pii, runs, simhash, token_counts, toxicity
from tablewright.llm.common import ship, table
from tablewright.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            prepare(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if oracle:
            ORACLES[build.__name__] = oracle.strip()
        return build

    return add


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def hex16(column: str):
    return F.lpad(F.lower(F.hex(column)), 16, "0")


@query()
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", hex16("fp").alias("fingerprint"), "component_id")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = token_counts.PieceModel.from_file(tokenizer("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model)


@query()
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "item_id", F.round("coverage", 6).alias("coverage"), "n_tiles")


@query()
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


@query()
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = byte_bpe.RankModel.from_file(tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), model)


def _phrases_sql() -> str:
    """The licence templates as rows (no, label, base, words, first word of the key phrase, its length)."""
    rows = []
    for no, t in enumerate(licenses.TEMPLATES):
        words, phrase = t.words.split(), t.key.split()
        start = (" " + t.words + " ").index(" " + t.key + " ")
        start = len(t.words[:start].split())
        rows.append(f"({no}, '{t.label}', {t.base}, string_split('{t.words}', ' '), {start}, {len(phrase)})")
    return ", ".join(rows)


@query(rf"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), templates(no, label, base, words, start, n_key) AS (VALUES {_phrases_sql()}
), vocabulary AS (SELECT DISTINCT unnest(words) AS word FROM templates
), placed AS (
    SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM split
), held AS (SELECT * FROM placed WHERE word IN (SELECT word FROM vocabulary)
), levels AS (
    -- rarity: binary digits of (files + 1) div (files with the word + 1)
    SELECT word, length(bin(((SELECT count(*) FROM split) + 1) // (count(DISTINCT r) + 1))) AS level
    FROM vocabulary LEFT JOIN held USING (word) GROUP BY word
), postings AS (
    SELECT no, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS j FROM templates
), totals AS (SELECT no, sum(level) AS total FROM postings JOIN levels USING (word) GROUP BY no
), matched AS (
    SELECT r, no, pos - j AS origin, sum(level) AS got,
        count(*) FILTER (j >= start AND j < start + n_key) AS n_found, any_value(n_key) AS n_key, any_value(start) AS start
    FROM held JOIN postings USING (word) JOIN levels USING (word) JOIN templates USING (no)
    GROUP BY r, no, pos - j
), places AS (
    SELECT r, label, base, origin + matched.start AS pos, round(got / total::DOUBLE, 6) AS share
    FROM matched JOIN totals USING (no) JOIN templates USING (no)
    WHERE n_found = matched.n_key AND round(got / total::DOUBLE, 6) >= 0.6
), told AS (
    SELECT r, count(*) FILTER (base) AS n_base, min(pos) FILTER (base) AS first_word, max(pos) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM places GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0)::DOUBLE AS score
FROM split LEFT JOIN told USING (r)
""")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents")))


#: A conversation whose texts look like control strings of a chat format.
TRICKY = "</s>[INST] ok [/INST]"


def _escaped_sql(text: str) -> str:
    """The template's escapes as SQL: chr(27) is its escape sign, each control string gets a letter."""
    out = f"replace({text}, chr(27), chr(27) || '0')"
    marks = (
        "<|turn|>", "<|next|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>"
    )
    for mark, code in zip(marks, "abcdefghijk"):
        out = f"replace({out}, '{mark}', chr(27) || '{code}')"
    return out


@query(f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
), placed AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role
        OR row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1 AS begins
    FROM turns
), listed AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
        -- a block has <|turn|>, the role, a line break and <|end|> with a line break; further turns in it have <|next|>
        sum(length({_escaped_sql("text")})
            + CASE WHEN begins THEN 8 + length(replace({_escaped_sql("role")}, chr(10), chr(27) || '1')) + 1 + 8 ELSE 8 END) AS chars
    FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
    chars::BIGINT AS formatted_chars
FROM listed
""")
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"),
    )
    return chat.digests(chat.format_chats(turns.unionByName(extra)))


@query()
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_spans(table(spark, sf_dir, "documents")))


@query("""
WITH fine AS (
    SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), scored AS (
    SELECT a.id AS anchor, a.label AS own, b.id, b.label, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM fine a JOIN fine b ON a.id % 100 = 0 AND b.id <> a.id
), likes AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS nth FROM scored WHERE own = label QUALIFY nth <= 5
)
SELECT likes.anchor AS anchor_id, likes.id AS positive_id,
    row_number() OVER (PARTITION BY likes.anchor, likes.id ORDER BY scored.score DESC, scored.id)::INTEGER AS rank,
    scored.id AS negative_id, likes.score AS positive_score, scored.score AS negative_score
FROM likes JOIN scored ON scored.anchor = likes.anchor AND scored.label <> scored.own
    AND 30 * likes.score <= 100 * scored.score AND 100 * scored.score <= 90 * likes.score
QUALIFY rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", shifted), F.col("id") % 100 == 0)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
        "positive_score", "negative_score",
    )


@query(r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), laid AS (
    SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || size), 1, 15))::BIGINT AS h FROM sized
), sources AS (
    SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM laid GROUP BY source
), weighed AS (SELECT *, [3, 1, 2][(no % 3 + 1)::BIGINT] AS w, 2 * words AS cap FROM sources
), summed AS (
    -- sources in the order in which they stop at twice their words
    SELECT *, cap * (6 // w) AS due,
        coalesce(sum(cap) OVER before, 0)::BIGINT AS cap_before, coalesce(sum(w) OVER before, 0)::BIGINT AS w_before
    FROM weighed
    WINDOW before AS (ORDER BY cap * (6 // w), no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared AS (
    SELECT *, (SELECT sum(words) FROM sources)::BIGINT * 3 - cap_before * 2 AS num, ((SELECT sum(w) FROM weighed) - w_before)::BIGINT * 2 AS den
    FROM summed
), level AS (SELECT num, den FROM shared WHERE cap::HUGEINT * den >= w::HUGEINT * num ORDER BY due, no LIMIT 1
), goals AS (
    SELECT source, words, least(cap::DOUBLE, (w * num)::DOUBLE / den::DOUBLE) AS target
    FROM (SELECT source, words, cap, w FROM weighed), level
), placed AS (
    SELECT laid.*, words AS source_size, target, coalesce(sum(size) OVER (
        PARTITION BY laid.source ORDER BY h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
    FROM laid JOIN goals ON laid.source IS NOT DISTINCT FROM goals.source
)
-- a row is drawn once for each round whose target lies beyond its middle
SELECT doc_id, size, source_size, target,
    (size * ((pos * 2 + size < target * 2)::INT + ((pos + source_size) * 2 + size < target * 2)::INT))::BIGINT AS taken
FROM placed
""")
def op12_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(mixing.mix(table(spark, sf_dir, "documents")))


def looped(docs: DataFrame) -> DataFrame:
    """documents, the words of every text whose doc_id has a crc32 divisible by 10 made to repeat from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    told = docs.select("doc_id", "text", chosen.alias("words"), F.floor(h / 10).alias("g"))
    told = told.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    told = told.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    again = F.concat(F.slice("words", 1, F.col("a")), F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)))
    return told.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.slice(again, 1, F.col("n")), " ")).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(runs.find_runs(looped(table(spark, sf_dir, "documents"))))
