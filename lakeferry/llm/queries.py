"""Registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm import (
    decontaminate,
    importance,
    line_dedup,
    manifest,
    mixing,
    nn_descent,
    packing,
    prob_minhash,
    quality,
    suffix_dedup,
    token_counts,
    tool_calls,
    url_rules,
)
from lakeferry.llm.scratch import read_table
from lakeferry.llm.shipping import shipped

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, with its SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = shipped(function)
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


# Fixed by the contract: ASCII capitals in lower case, then runs of these.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION_SQL = f"""
    d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, 13 AS n, array_to_string(w[i:i + 12], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)
        UNION
        SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 12),
    sizes AS (SELECT DISTINCT n FROM windows),
    grams AS (
        SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes
              WHERE len(w) >= n)),
    hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
    covered AS (
        SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    found AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r),
    judged AS (
        SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256
        FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r))"""


@query(
    f"""
    WITH {CONTAMINATION_SQL}
    SELECT doc_id, n_words, n_hit, n_items, items_sha256,
           n_hit > 0 AND 20 * n_hit >= n_words AS contaminated
    FROM judged"""
)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in each document, by suffix arrays."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.report(documents, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


MIXING_SQL = r"""
    rows_ AS (
        SELECT doc_id, source, text,
               md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS mark,
               CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
        FROM documents),
    totals AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS cycle
        FROM rows_ GROUP BY source),
    weighted AS (
        SELECT *, CAST([3, 1, 2][cycle + 1] AS DOUBLE) AS w,
               sum(source_size) OVER () * 1.5::DOUBLE AS words FROM totals),
    left_ AS (
        SELECT *,
               words - coalesce(sum(2 * source_size) OVER before, 0) AS words_left,
               sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left
        FROM weighted
        WINDOW before AS (ORDER BY source_size / w, encode(source) NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    judged AS (SELECT *, 2 * source_size * w_left <= words_left * w AS full_ FROM left_),
    targets AS (
        SELECT source, cycle, source_size,
               CASE WHEN full_ THEN CAST(2 * source_size AS DOUBLE)
                    ELSE w * (words - sum(CASE WHEN full_ THEN 2 * source_size ELSE 0 END) OVER ())
                         / sum(CASE WHEN full_ THEN 0.0 ELSE w END) OVER () END AS target
        FROM judged),
    placed AS (
        SELECT r.*, cycle, source_size, target, CAST(round(target) AS BIGINT) AS whole,
               CAST(coalesce(sum(size) OVER (
                   PARTITION BY r.source ORDER BY mark
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
        FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
    taken AS (
        SELECT *, greatest(0, least(size, whole - start)) AS once,
               greatest(0, least(size, whole - start - source_size)) AS again
        FROM placed),
    shares AS (
        SELECT *, (start + once / 2) / whole AS x FROM taken),
    times AS (
        SELECT *, CASE
            WHEN once = 0 THEN NULL
            WHEN cycle = 0 THEN 3 * x * 2 / (sqrt(4 + 3 * x * 4) + 2)
            WHEN cycle = 1 THEN x * 2 / (sqrt(2.25 - x * 2) + 1.5)
            WHEN 2 * x < 1 THEN 2 * x * 2 / (sqrt(1 + 2 * x * 8) + 1)
            ELSE 0.5 + (2 * x - 1) * 2 / (sqrt(9 - (2 * x - 1) * 8) + 3) END AS at_
        FROM shares)"""


@query(
    f"""
    WITH {MIXING_SQL}
    SELECT doc_id, size, source_size, target, CAST(once + again AS BIGINT) AS taken,
           at_ AS position
    FROM times"""
)
def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in training order."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mixing.planned(documents, carry=["doc_id"]).drop("copies")
    order = ["position", "doc_id"]  # documents that the mix leaves out have no position
    return plan.repartitionByRange(*order).sortWithinPartitions(*order)


@query()
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each document, by ProbMinHash bands and exact verification."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = prob_minhash.near_duplicates(documents)
    return found.select("doc_id", "class_id", "class_size", "n_shingles", "kept")


@query()
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of each document."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.lines_removed(documents, removed="removed")
    return kept.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


CONTRACT_RULES = (
    url_rules.HostRule("allow", "com"),
    url_rules.HostRule("block", "example.com", "/en/"),
    url_rules.HostRule("allow", "www.example.com", "/en/"),
    url_rules.HostRule("block", "net", "/es/"),
    url_rules.HostRule("block", "net", "/fr/"),
)


@query(
    r"""
    WITH cut AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)([^?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)([^?#]*)', 2) AS path
        FROM pages),
    rules(h, p, v) AS (VALUES
        ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    judged AS (
        SELECT c.*, (SELECT max({'n': length(h || p), 'rule': h || p, 'v': v}) FROM rules
                     WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p)) AS best
        FROM cut c)
    SELECT page_id, host, path, best.rule AS rule,
           coalesce(best.v, CASE WHEN regexp_matches(host || path,
               '^([\s\S]*\.)?(spam-farm|cheap-pills|casino)\.|/(casino|adult|login|cart)/|\.(exe|apk)$')
               THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged"""
)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's URL, by rules fetched through rare tokens."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judged(pages, (*CONTRACT_RULES, *url_rules.PATTERNS)).drop("url")


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of each document, learnt from positives and unlabelled text."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.trained(documents, read_table(spark, sf_dir, "labels"))
    found = quality.scored(documents, model)
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of each document."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.counted(documents, token_counts.read_vocabulary())


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without repeated 100-byte strings."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.repeats_removed(documents).drop("text", "kept")


@query()
def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and components of all embeddings, by NN-descent."""
    return nn_descent.linked_vectors(read_table(spark, sf_dir, "embeddings"))


#: what a call made of a user's turn must be like
ASK = {
    "type": "object",
    "required": ["query", "turn"],
    "additionalProperties": False,
    "properties": {
        "query": {"type": "string", "minLength": 1, "maxLength": 400},
        "turn": {"type": "integer", "minimum": 0},
        "after": {"type": "object"},
    },
}


@query(
    r"""
    WITH RECURSIVE asked AS (SELECT DISTINCT conv_id, turn, text FROM conversations WHERE role = 'user'),
    said AS (SELECT DISTINCT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
    made AS (
        SELECT conv_id, turn, text,
               CASE WHEN conv_id % 11 = 5 AND turn = 4 THEN 2 ELSE turn END AS id,
               CASE WHEN conv_id % 11 = 3 AND turn = 0 THEN 'bad json'
                    WHEN conv_id % 11 = 4 AND turn = 0 THEN 'unknown tool'
                    WHEN NOT length(text) BETWEEN 1 AND 400 THEN 'invalid' END AS error,
               CASE WHEN turn = 0 AND conv_id % 5 IN (1, 2) THEN 2
                    WHEN turn >= 2 AND NOT (conv_id % 5 = 2 AND turn = 2) THEN turn - 2 END AS after_
        FROM asked),
    calls AS (
        SELECT conv_id, turn, id, text, error, after_ AS written,
               CASE WHEN error IN ('bad json', 'unknown tool') THEN NULL ELSE after_ END AS ref,
               row_number() OVER (PARTITION BY conv_id, id ORDER BY turn) = 1 AS is_first
        FROM made),
    firsts AS (SELECT * FROM calls WHERE is_first),
    edges AS (
        SELECT c.conv_id, c.id, c.turn, c.ref, r.turn AS ref_turn
        FROM firsts c JOIN firsts r ON r.conv_id = c.conv_id AND r.id = c.ref),
    reached AS (
        SELECT conv_id, id, ref FROM edges
        UNION
        SELECT x.conv_id, x.id, e.ref FROM reached x JOIN edges e ON e.conv_id = x.conv_id AND e.id = x.ref),
    circles AS (SELECT conv_id, id FROM reached WHERE id = ref),
    endless AS (
        SELECT DISTINCT x.conv_id, x.id FROM reached x JOIN circles c ON c.conv_id = x.conv_id AND c.id = x.ref),
    walks AS (
        SELECT e.conv_id, e.id, e.ref, e.ref_turn AS t, 1 AS step FROM edges e
        ANTI JOIN endless x ON x.conv_id = e.conv_id AND x.id = e.id
        UNION ALL
        SELECT w.conv_id, w.id, e.ref, e.ref_turn, step + 1
        FROM walks w JOIN edges e ON e.conv_id = w.conv_id AND e.id = w.ref),
    places AS (
        SELECT f.conv_id, f.id, greatest({'t': f.turn, 's': 0}, max({'t': w.t, 's': w.step})) AS place
        FROM firsts f JOIN walks w ON w.conv_id = f.conv_id AND w.id = f.id
        GROUP BY f.conv_id, f.id, f.turn),
    judged AS (
        SELECT c.conv_id, CAST(c.conv_id || '-' || c.id AS VARCHAR) AS call_id, c.turn,
               CASE WHEN c.is_first THEN s.turn END AS result_turn,
               CASE WHEN c.is_first AND x.id IS NOT NULL THEN NULL
                    WHEN c.is_first THEN coalesce(p.place.t, c.turn) ELSE c.turn END AS order_turn,
               CASE WHEN c.is_first AND x.id IS NOT NULL THEN NULL
                    WHEN c.is_first THEN coalesce(p.place.s, 0) ELSE 0 END AS order_step,
               CASE WHEN NOT c.is_first THEN 'repeated' WHEN c.error IS NOT NULL THEN c.error
                    WHEN c.ref IS NOT NULL AND r.id IS NULL THEN 'missing'
                    WHEN x.id IS NOT NULL THEN 'cycle'
                    WHEN s.turn IS NULL THEN 'unanswered' ELSE 'ok' END AS status,
               '{"arguments":' || CASE WHEN c.error = 'bad json' THEN 'null' ELSE '{'
               || CASE WHEN c.written IS NOT NULL THEN '"after":{"$ref":"' || c.conv_id || '-' || c.written || '"},' ELSE '' END
               || '"query":' || CAST(to_json(c.text) AS VARCHAR) || ',"turn":' || c.turn || '}' END
               || ',"id":"' || c.conv_id || '-' || c.id || '","name":'
               || CASE WHEN c.error = 'unknown tool' THEN '"guess"' ELSE '"ask"' END || ',"result":'
               || CASE WHEN s.turn IS NULL OR NOT c.is_first THEN 'null' ELSE CAST(to_json(s.text) AS VARCHAR) END || '}' AS record
        FROM calls c
        LEFT JOIN said s ON s.conv_id = c.conv_id AND s.turn = c.id + 1 AND s.turn > c.turn
        LEFT JOIN firsts r ON r.conv_id = c.conv_id AND r.id = c.ref
        LEFT JOIN endless x ON x.conv_id = c.conv_id AND x.id = c.id
        LEFT JOIN places p ON p.conv_id = c.conv_id AND p.id = c.id),
    orphans AS (
        SELECT s.conv_id, CAST(s.conv_id || '-' || (s.turn - 1) AS VARCHAR), CAST(NULL AS BIGINT), s.turn,
               CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), 'orphan',
               '{"arguments":null,"id":"' || s.conv_id || '-' || (s.turn - 1) || '","name":null,"result":'
               || CAST(to_json(s.text) AS VARCHAR) || '}'
        FROM said s ANTI JOIN firsts a ON s.conv_id = a.conv_id AND s.turn = a.id + 1)
    SELECT conv_id, call_id, turn, result_turn, order_turn, CAST(order_step AS INTEGER) AS order_step, status, record
    FROM judged UNION ALL SELECT * FROM orphans"""
)
def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tool calls: each user's turn a call, each answer the result before it.

    A call refers to the one two turns before. In some conversations the first call
    refers to the next one, which refers back to it in one half of them; in others
    the first call is cut off, or of an unknown tool, or the third one repeats an identifier.
    """
    turns = read_table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    name = lambda of: F.concat("conv_id", F.lit("-"), of)
    asked = turns.where("role = 'user'")
    after = F.when((turn == 0) & (conv % 5).isin(1, 2), F.lit(2)).when(
        (turn >= 2) & ~((conv % 5 == 2) & (turn == 2)), turn - 2
    )
    after = F.when(after.isNotNull(), F.struct(name(after).alias("$ref")))
    arguments = F.to_json(F.struct(F.col("text").alias("query"), "turn", after.alias("after")))
    first = turn == 0
    calls = asked.select(
        "conv_id",
        "turn",
        name(F.when((conv % 11 == 5) & (turn == 4), F.lit(2)).otherwise(turn)).alias("call_id"),
        F.when((conv % 11 == 4) & first, "guess").otherwise("ask").alias("name"),
        F.when((conv % 11 == 3) & first, F.lit("{")).otherwise(arguments).alias("arguments"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", name(turn - 1).alias("call_id"), F.col("text").alias("content")
    )
    return tool_calls.linked(calls, results, {"ask": ASK})


@query()
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, by sum-of-squares placement."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text("utf-8")
    return packing.packed(documents, tokenizer).drop("ids")


# CRC-32 of the bytes in hexadecimal digits `h`, by a table of its 256 steps.
CRC_SQL = """
    crc_table AS (
        SELECT list(list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY v) AS steps
        FROM (SELECT unnest(range(256))::BIGINT AS v)),
    crc_of AS (
        SELECT h, xor(list_reduce(
                   list_prepend(4294967295, list_transform(range(1, length(h), 2),
                       lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
                   lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295) AS crc
        FROM hex_strings, crc_table)"""


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    dw AS (SELECT r, unnest(w) AS word FROM d),
    bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
    hex_strings AS (
        SELECT DISTINCT hex(encode(word)) AS h FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
    {CRC_SQL},
    df AS (SELECT r, crc % 10000 AS bucket FROM dw JOIN crc_of ON h = hex(encode(word))),
    s AS (SELECT bucket, count(*) AS n FROM df GROUP BY bucket),
    t AS (SELECT crc % 10000 AS bucket, count(*) AS n
          FROM bw JOIN crc_of ON h = hex(encode(word)) GROUP BY 1),
    totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS all_s, coalesce((SELECT sum(n) FROM t), 0) AS all_t),
    gains AS (
        SELECT s.bucket, CAST(floor(1000 * ln(
                   (coalesce(t.n, 0) + 1.0::DOUBLE) * (all_s + 10000)::DOUBLE
                   / ((s.n + 1.0::DOUBLE) * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
        FROM s LEFT JOIN t ON s.bucket = t.bucket, totals),
    means AS (
        SELECT r, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
        FROM df JOIN gains USING (bucket) GROUP BY r),
    scored AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
                   '2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                   / 4294967296.0::DOUBLE))) AS BIGINT) AS score
        FROM d LEFT JOIN means USING (r)),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
               count(*) OVER (PARTITION BY n_features >= 20) AS able
        FROM scored)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN CAST(place AS BIGINT) END AS rank
    FROM ordered"""
)
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight, score and rank of each document in a draw towards the benchmark's words."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resampled(documents, read_table(spark, sf_dir, "benchmark"), carry=["doc_id"])


def _leaf_sql(text: str) -> str:
    fields = [("CAST(%s AS VARCHAR)", c) for c in ("doc_id", "source", "lang", "n_chars")]
    values = [form % c for form, c in fields] + [text]
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


@query(
    f"""
    WITH RECURSIVE hex_strings AS (
        SELECT DISTINCT hex(encode(CAST(doc_id AS VARCHAR))) AS h FROM documents WHERE doc_id IS NOT NULL),
    {CRC_SQL},
    leaves AS (
        SELECT doc_id, source, sha256({_leaf_sql("text")}) AS leaf,
               CASE WHEN crc % 2 = 0 THEN sha256({_leaf_sql("replace(text, chr(10), '')")})
                    ELSE sha256({_leaf_sql("text")}) END AS claimed
        FROM documents LEFT JOIN crc_of ON h = hex(encode(CAST(doc_id AS VARCHAR)))),
    placed AS (
        SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS grp,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY source) AS n
        FROM leaves),
    up AS (
        SELECT grp, 0 AS level, pos, leaf AS node, n FROM placed
        UNION ALL
        SELECT grp, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
        FROM up WHERE n > 1 GROUP BY grp, level, pos // 3, n),
    tops AS (SELECT grp, level AS height, node AS subroot FROM up WHERE n = 1),
    top_up AS (
        SELECT 0 AS level, grp AS pos, subroot AS node, (SELECT count(*) FROM tops) AS n FROM tops
        UNION ALL
        SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
        FROM top_up WHERE n > 1 GROUP BY level, pos // 3, n),
    steps AS (
        SELECT a.grp, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
        FROM up a JOIN up b ON a.grp = b.grp AND a.level = b.level AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY ALL),
    top_steps AS (
        SELECT a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
        FROM top_up a JOIN top_up b ON a.level = b.level AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY ALL),
    climb AS (
        SELECT grp, pos AS leaf_pos, 0 AS level, pos AS at_, claimed AS node, '' AS proof FROM placed
        UNION ALL
        SELECT c.grp, leaf_pos, c.level + 1, at_ // 3, sha256(s.l || node || s.r), proof || s.l || s.r
        FROM climb c JOIN steps s ON c.grp = s.grp AND c.level = s.level AND at_ = s.pos),
    top_climb AS (
        SELECT c.grp, leaf_pos, 0 AS level, c.grp AS at_, node, proof
        FROM climb c JOIN tops t ON c.grp = t.grp AND c.level = t.height
        UNION ALL
        SELECT c.grp, leaf_pos, c.level + 1, at_ // 3, sha256(s.l || node || s.r), proof || s.l || s.r
        FROM top_climb c JOIN top_steps s ON c.level = s.level AND at_ = s.pos),
    root AS (SELECT level AS height, node AS root FROM top_up WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
    FROM top_climb c JOIN placed p ON c.grp = p.grp AND leaf_pos = p.pos JOIN tops t ON c.grp = t.grp
    JOIN root r ON c.level = r.height"""
)
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle proof of each document, against documents that have lost line feeds."""
    documents = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    now = [text if c == "text" else F.col(c) for c in manifest.FIELDS]
    found = manifest.proven(documents, manifest.leaf_digest(now), proofs=False)
    return found.drop("source", "position", "proof")
