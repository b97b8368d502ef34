"""The registered queries of the training-data operators, and SQL for those that SQL can state.

Each applies one operator to its whole table and derives what is reported from the
operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import ann, bpe, chat, langid, lines, packing, ranked, simhash, topk, toxicity, urls, variants, warc
from clickloom.llm.store import folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The file of a public tokenizer, at the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where("vec_id % 50 = 0"), 5)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "held_out", langid.held_out("doc_id", 5, 0)
    )
    model = toxicity.fit(docs.where("not held_out"), _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id", "held_out"])


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), place)
    return warc.read(spark, place).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 100 = 0"), 10)


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


#: A conversation whose texts look like markers.
TRICKY = """
    SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
    FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)
"""


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["conv_id", "turn", "role", "text"]
    rows = _table(spark, sf_dir, "conversations").select(*names).unionByName(spark.sql(TRICKY))
    events = rows.select(
        "conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.lit(None).cast("long").alias("message"), "role", "text"
    )
    formatted = chat.render(chat.messages(events))
    back = chat.read_back(formatted)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", langid.held_out("doc_id", 4, 2)
    )
    model = langid.fit(docs.where("not held_out"))
    return langid.identify(docs, model, keep=["doc_id", "held_out"])


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.word_counts(_table(spark, sf_dir, "documents"), spoil=199))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = lines.LineIndex.create(spark, folder(spark, "line-index")).insert(docs, increments=2)
    return index.kept(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OPERATORS = (
    op1_packing,
    op2_topk,
    op3_toxicity,
    op4_warc,
    op5_bpe,
    op6_simhash,
    op7_ann,
    op8_url_filter,
    op9_chat,
    op10_langid,
    op11_variants,
    op12_ranked,
    op13_lines,
)

SQL = {
    "op2_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * v.c[i]))::BIGINT AS score
            FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
        ), told AS (
            SELECT *, max(page_id) OVER (PARTITION BY hex) AS response FROM p
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - i % 4 * 5)::INTEGER) % 32 + 1, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = response OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> response THEN response END AS refers_to
        FROM told
    """,
    "op9_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), sized AS (
            SELECT *,
                length(regexp_replace(regexp_replace(text,
                    '<(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)', '<\\\1\2', 'g'),
                    '\[(\\*)(INST\]|/INST\])', '[\\\1\2', 'g')) AS escaped
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + escaped + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op7_ann": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS c FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   sqrt(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: (q.c[i] - v.c[i]) * (q.c[i] - v.c[i])))) AS score
            FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_ranked": r"""
        WITH t AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
        ), d AS (
            SELECT row_number() OVER () AS row, doc_id, terms, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0
        ), total AS (
            SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL
        ), held AS (
            SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM asked) GROUP BY row, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM held, total GROUP BY term, docs
        ), scored AS (
            SELECT item_id, row, any_value(doc_id) AS doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total.terms))))::BIGINT AS score
            FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN d USING (row), total
            GROUP BY item_id, row
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_lines": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), shared AS (
            SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)
        ), told AS (
            SELECT k.*, coalesce(doc_id <> first, false) AS dropped FROM k LEFT JOIN shared USING (key)
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
        FROM told GROUP BY row
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {operator.__name__: operator for operator in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
