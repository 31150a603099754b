"""Registered queries of the subpackage, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tarnwork.llm import chat, decontaminate, langid, lines, mixing, periods, quality, simhash, substring, tokens, topk, vector_codes, warc
from tarnwork.llm.common import WORD, fold

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Documents whose id hashes to a multiple of ten get a tail of equal stretches: with n
    words, word i from word a = g % n on becomes word a + (i - a) % p, where g is a tenth of the
    hash and p = 1 + floor((n - a) / (3 + g % 8))."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    words, a, p = F.col("__words"), F.col("__a"), F.col("__p")
    rows = docs.withColumn("__words", chosen).withColumn("__n", F.size(words))
    rows = rows.withColumn("__a", F.when(F.col("__n") > 0, F.floor(hashed / 10) % F.col("__n")))
    rows = rows.withColumn("__p", 1 + F.floor((F.col("__n") - a) / (3 + F.floor(hashed / 10) % 8)))
    tail = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
    repeated = F.when(F.col("__n") > 0, F.array_join(tail, " ")).otherwise(F.col("text"))
    return rows.withColumn("text", repeated).select(*docs.columns)


@_query()
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of all messages, learned from four fifths of the conversations, and their
    canonical turns."""
    found = chat.transcripts(_table(spark, sf_dir, "conversations"), spark, fold("conv", 5) != 0)
    return found.withColumn("held_out", fold("conv_id", 5) == 0)


@_query()
def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources flattened to nine tenths of the greatest entropy, at most four repeats."""
    docs = _table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.plan(docs, spark, entropy=0.9, repeats=4.0))
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "mix_block", "mix_order")


@_query(
    r"""
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
    ), d AS (
      SELECT page_id, strlen(body) AS payload_bytes, max(page_id) OVER (PARTITION BY hex) AS chief,
        array_to_string(list_transform(list_transform(range(8),
            lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER)),
          lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1)
            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1)
            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1)), '') AS payload_digest
      FROM p)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN page_id = chief THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> chief THEN chief END AS refers_to
    FROM d
    """
)
def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    folder = warc.write_archives(_table(spark, sf_dir, "pages"), spark, least=0)
    return warc.read_archives(spark, folder, bodies=False).select(
        "page_id", F.col("seen").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", "refers_to"
    )


@_query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from two thirds of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(fold("doc_id", 3) != 1), spark)
    found = langid.predict(docs, spark, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@_query()
def op5_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or re-parameterised."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), spark, exact=True)
    return found.select(F.col("id").alias("doc_id"), "item_id", "kind", "runs", "item_runs", "start")


@_query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents: three words, three bits."""
    found = simhash.groups(_table(spark, sf_dir, "documents"), spark, words=3, radius=3)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of().alias("fingerprint"), "component_id")


@_query()
def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    model = quality.learn(docs.where(fold("doc_id", 5) != 0), labels.where(fold("id", 5) != 0), spark)
    found = quality.score(docs, spark, model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
      vec_id, score
    FROM s QUALIFY rank <= 10
    """
)
def op8_topk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of every hundredth vector."""
    return topk.search(_table(spark, sf_dir, "embeddings"), spark, F.col("id") % 100 == 0, k=10, scale=1024.0)


@_query(
    r"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), win AS (
      SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS win
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w)
    ), rep AS (
      SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY win) > 1
    ), gone AS (
      SELECT DISTINCT doc_id, i + j AS k FROM rep, range(35) t(j)
    ), word AS (
      SELECT doc_id, k, words[k] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS k FROM w)
    ), kept AS (
      SELECT word.doc_id, count(gone.k) AS n_removed,
        string_agg(word.word, ' ' ORDER BY word.k) FILTER (gone.k IS NULL) AS kept
      FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.k = word.k GROUP BY word.doc_id
    )
    SELECT w.doc_id, len(w.words) AS n_words, coalesce(n_removed, 0) AS n_removed,
      sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
    """
)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 35 words that occur elsewhere."""
    repeats = substring.Repeats(spark, width=35)
    found = repeats.removed(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
    found = repeats.scratch.save(found, "result")
    repeats.close()
    return found


@_query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to token files and read back."""
    folder = tokens.write_tokens(_table(spark, sf_dir, "documents"), spark, corpus_pipeline.tokenizer_file(), end_id=0, added=True)
    return tokens.read_tokens(spark, folder).select(
        F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@_query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which get a repeated tail."""
    docs = with_repeated_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.periodic(docs, least=24, times=3).withColumnRenamed("id", "doc_id")
    higher = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(higher(best, r), r).otherwise(best))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _codes_sql() -> str:
    """Six rounds, each a pair of tables: the nearest entry of every part, the moved entries."""
    c = [f"x{i}" for i in range(8)]
    far = " + ".join(f"(v.{x} - b.{x}) * (v.{x} - b.{x})" for x in c)
    nearest = "{name} AS MATERIALIZED (SELECT vec_id, part, {own}, min(({far}) * 16 + entry) AS found FROM v JOIN {book} b USING (part) GROUP BY ALL)"
    own = ", ".join(f"v.{x}" for x in c)
    floored = ", ".join(f"coalesce((sum(a.{x}) - ((sum(a.{x}) % count(a.part)) + count(a.part)) % count(a.part)) // count(a.part), b.{x})::BIGINT AS {x}" for x in c)
    steps = []
    for k in range(6):
        steps.append(nearest.format(name=f"a{k}", book=f"b{k}", far=far, own=own))
        group = ", ".join(f"b.{x}" for x in c)
        steps.append(
            f"b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, {floored} FROM b{k} b LEFT JOIN a{k} a"
            f" ON a.part = b.part AND a.found % 16 = b.entry GROUP BY b.part, b.entry, {group})"
        )
    steps.append(nearest.format(name="last", book="b6", far=far, own=own))
    cut = ", ".join(f"floor(4096 * embedding[8 * part + {i + 1}]::DOUBLE)::BIGINT AS x{i}" for i in range(8))
    return f"""
    WITH e AS MATERIALIZED (
      SELECT vec_id, label, embedding FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), v AS MATERIALIZED (
      SELECT vec_id, part, {cut} FROM (SELECT vec_id, embedding, unnest(range(8)) AS part FROM e)
    ), b0 AS MATERIALIZED (
      SELECT part, entry, {", ".join(c)}
      FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e) USING (vec_id) WHERE entry < 16
    ), {", ".join(steps)}, coded AS (
      SELECT vec_id, string_agg(printf('%02x', found % 16), '' ORDER BY part) AS code, sum(found // 16)::BIGINT AS error
      FROM last GROUP BY vec_id
    ), book AS (
      SELECT sha256(string_agg(concat_ws(',', {", ".join(c)}), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b6
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN e USING (vec_id), book
    """


@_query(_codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of eight parts of all vectors and the errors they make, by vector and label."""
    table = _table(spark, sf_dir, "embeddings")
    made = vector_codes.compress(table, spark, parts=8, entries=16, rounds=6, scale=4096.0, carry=["label"])
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1)).cast("long")
    by_label = made.rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    rows = made.rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256"))


@_query(
    r"""
    WITH d AS (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), l AS (
      SELECT doc_id, i, lines[i] AS line,
        translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
    ), k AS (
      SELECT key, max(doc_id) AS chief FROM l WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (chief <> doc_id) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (chief IS NULL OR chief = doc_id), '')) AS kept_sha256
    FROM l LEFT JOIN k ON k.key = l.key GROUP BY doc_id
    """
)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines of 40 characters that five documents hold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.without_repeats(docs, lines.bitmaps(docs, spark, least=40, documents=5))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@_query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py`` over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
