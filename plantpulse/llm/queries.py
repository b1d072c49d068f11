"""The operators as queries over the standard tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.llm import class_lm, fertility, main_text
from plantpulse.llm.common import fold, read, ready
from plantpulse.llm.conversation_repair import damaged, summaries
from plantpulse.llm.personal_data import examples, trained, with_spans
from plantpulse.llm.piece_sampling import segmentations
from plantpulse.llm.simhash_dedup import fingerprint_text, near_duplicates
from plantpulse.llm.sketches import edited_likeness
from plantpulse.llm.source_mix import copies
from plantpulse.llm.target_resampling import resampled
from plantpulse.llm.token_counts import token_counts
from plantpulse.llm.toxicity import learned, scored
from plantpulse.llm.vector_topk import quantised, top_k

Build = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        _QUERIES[key] = lambda spark, sf_dir: build(ready(spark), sf_dir)
        if sql:
            _SQL[key] = sql
        return build

    return register


def queries() -> dict[str, Build]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_vector_topk", """
    WITH sound AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS terms
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.terms, c.terms), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM sound q JOIN sound c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
    QUALIFY rank <= 10
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query("op10_simhash_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", fingerprint_text().alias("fingerprint"), "component_id")


@query("op3_source_mix", r"""
    WITH docs AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents
    ), sizes AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
    ), weighed AS (
        SELECT source, source_size, 2.0::DOUBLE * source_size AS most, place,
               CAST([5, 2, 1][CAST((place - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight
        FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sizes)
    ), filled AS (
        SELECT *, most / weight AS fill,
               coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
               sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
               CAST(sum(source_size) OVER () AS DOUBLE) AS everything
        FROM weighed
    ), level AS (
        SELECT arg_min((1.5::DOUBLE * everything - used) / open_weight, (fill, place)) AS level
        FROM filled WHERE (1.5::DOUBLE * everything - used) / open_weight <= fill
    ), targets AS (
        SELECT source, source_size, least(most, weight * level) AS target,
               CAST(CAST('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS first_at
        FROM filled, level
    ), placed AS (
        SELECT d.doc_id, d.size, t.source_size, t.target, t.first_at,
               CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS rate,
               CAST(row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS DOUBLE) AS nth
        FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           size * CAST(floor(first_at + rate * nth) - floor(first_at + rate * (nth - 1)) AS BIGINT) AS taken
    FROM placed
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copies(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (rows["size"] * rows["copies"]).alias("taken"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = learned(docs, read(spark, sf_dir, "labels"))
    score = F.col("toxicity")
    return scored(docs, machine).select(
        "doc_id", (fold() == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@query("op1_personal_data")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(read(spark, sf_dir, "documents").select("doc_id", "text"), trained(examples(spark)))
    return found.select(
        "doc_id", "found.n_email", "found.n_ip", "found.n_card", "found.n_phone",
        F.sha2(F.col("found.base_spans"), 256).alias("base_sha256"), "found.spans")


@query("op5_piece_sampling")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    drawn = segmentations(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return drawn.select(
        "doc_id", "sample", F.size("pieces").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"), "log_prob",
        "noisy_value", "log_inclusion", "round_trip")


@query("op2_sketches")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(read(spark, sf_dir, "documents"))


@query("op8_class_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = class_lm.trained(docs)
    return class_lm.scored(docs, model, counts)


@query("op6_main_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text.extracted(read(spark, sf_dir, "pages"), main_text.trained(main_text.examples(spark)))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: CRC-32 in SQL: the table of its 256 steps, and the checksum of a list of bytes.
_CRC_STEPS = """(SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS steps)"""


def _crc(bytes_: str) -> str:
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295), 4294967295)"


def _repair_step() -> str:
    """Cost, audit and repaired lines from each grammar state, given those of what follows and a row."""
    following = [2, 2, 3, 2]
    kept = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    inserted = ["user", "user", "assistant", "user"]

    def edit(state: int, letter: str, cost: str, line: str) -> str:
        after = f"v[{state + 1}]"
        lines = f"list_concat([{line}], {after}.t)" if line else f"{after}.t"
        return f"{{'c': {after}.c + {cost}, 'a': '{letter}' || {after}.a, 't': {lines}}}"

    def choices(state: int) -> str:
        made = [edit(state, "D", "2", "")]
        for initial, after in kept[state].items():
            made.append(f"CASE WHEN NOT r.gone AND r.initial = '{initial}' THEN {edit(after, 'K', 'r.stays', 'r.line')} END")
        role = f"'{inserted[state]}:' || r.text"
        made.append(f"CASE WHEN NOT r.gone THEN {edit(following[state], 'R', 'r.stays + 1', role)} END")
        return f"list_min([{', '.join(made)}])"

    def insert(state: int, after: str) -> str:
        return (f"{{'c': ({after}).c + 5, 'a': 'I' || ({after}).a, "
                f"'t': list_concat(['{inserted[state]}:'], ({after}).t)}}")

    def entry(state: int) -> str:
        one = insert(state, f"f[{following[state] + 1}]")
        two = insert(state, insert(following[state], f"f[{following[following[state]] + 1}]"))
        return f"list_min([f[{state + 1}], {one}, {two}])"

    consumed = f"[{', '.join(choices(s) for s in range(4))}]"
    # The inserts need the results of all states, so they are bound as the only element of a list.
    return f"list_transform([{consumed}], lambda f: [{', '.join(entry(s) for s in range(4))}])[1]"


_REPAIR_SQL = rf"""
WITH crc AS {_CRC_STEPS},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
coded AS (SELECT *, {_crc("list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))")} % 20 AS code
  FROM keyed, crc),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM coded),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS before
  FROM rows_),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'gone': fault IN ('blank', 'duplicate'), 'initial': initial, 'stays': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END,
           'line': role || ':' || text, 'text': text}} ORDER BY place DESC) AS backward
  FROM judged GROUP BY conv_id),
solved AS (
  SELECT * EXCLUDE (backward), list_reduce(backward, lambda v, r: {_repair_step()},
    [{{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}}, {{'c': CAST(10 AS BIGINT), 'a': 'II', 't': ['user:', 'assistant:']}},
     {{'c': CAST(5 AS BIGINT), 'a': 'I', 't': ['assistant:']}}, {{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}}])[1] AS best FROM counted)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN solved s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
"""


@query("op11_conversation_repair", _REPAIR_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(damaged(read(spark, sf_dir, "conversations")))


_WORDS_OF = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_HEX_BYTES = ("list_transform(range(1, CAST(length(hex(encode(word))) / 2 AS BIGINT) + 1), "
              "lambda i: CAST(CAST('0x' || substr(hex(encode(word)), CAST(2 * i - 1 AS BIGINT), 2) AS INTEGER) AS BIGINT))")


@query("op12_target_resampling", f"""
WITH crc AS {_CRC_STEPS},
docs AS (SELECT doc_id, {_WORDS_OF} AS words, row_number() OVER () AS nth FROM documents),
told AS (SELECT unnest({_WORDS_OF}) AS word FROM benchmark),
said AS (SELECT nth, unnest(words) AS word FROM docs),
hashed AS (SELECT word, {_crc(_HEX_BYTES)} % 10000 AS bucket FROM (SELECT word FROM said UNION SELECT word FROM told), crc),
corpus AS (SELECT bucket, count(*) AS s FROM said JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM told JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM said)::DOUBLE + 10000)
    / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM told)::DOUBLE + 10000)))) AS BIGINT) AS gain
  FROM corpus LEFT JOIN target USING (bucket)),
weights AS (SELECT nth, CAST(sum(gain) AS BIGINT) AS weight FROM said JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY nth),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) AS DOUBLE)
      + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (nth)),
placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM placed
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_fertility_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    rows = fertility.judged(
        read(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
