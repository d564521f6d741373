"""The registered query of each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import ann, bpe, chat, decontaminate, descent, jaccard, langid, lmscore, merkle, quality, toxicity, warc, whiten
from plumbline.llm.store import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ 1 quality


@query("op1_quality")
def op1_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ------------------------------------------------------------------ 2 benchmark decontamination

WORDS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op2_decontaminate",
    f"""WITH d AS (SELECT doc_id, coalesce({WORDS_SQL}, []) AS w FROM documents),
i AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
n AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM n)),
spot AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, n, item_id FROM spot JOIN win USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def op2_decontaminate(spark, sf_dir):
    found = decontaminate.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# ------------------------------------------------------------------ 3 toxicity


def fold(doc_id: str, of: int, held: int):
    """Whether a row is held out, by the CRC-32 of its id as text; a row without id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == held, F.lit(False))


def toxicity_model(spark, documents, labels):
    return toxicity.train(spark, documents, labels.filter(~fold("doc_id", 5, 0)))


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scored = toxicity.score(spark, documents, toxicity_model(spark, documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", fold("doc_id", 5, 0).alias("held_out"), "score", "predicted")


# ------------------------------------------------------------------ 4 WARC


@query(
    "op4_warc",
    """WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN coalesce(first_id, page_id) = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
)
def op4_warc(spark, sf_dir):
    path = new_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# ------------------------------------------------------------------ 5 BPE


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded_digests(spark, documents):
    return bpe.round_trip(spark, documents, tokenizer_file())


@query("op5_bpe")
def op5_bpe(spark, sf_dir):
    return encoded_digests(spark, table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 6 language ID


def language_model(documents):
    return langid.train(documents.filter(~fold("doc_id", 4, 2)))


@query("op6_langid")
def op6_langid(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = langid.identify(spark, documents, language_model(documents))
    return found.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 7 language-model scores


@query("op7_lmscore")
def op7_lmscore(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return lmscore.score(spark, documents, lmscore.train(spark, documents))


# ------------------------------------------------------------------ 8 chat formatting

#: A conversation in another layout, whose texts hold the template's own control strings.
TRICKY = (
    r'{"conv_id": -7, "messages": [{"role": "user", "content": "\\### Assistant: </turn> ok"}, '
    r'{"role": "assistant", "content": "\\### Assistant: </turn> ok"}]}'
)


@query(
    "op8_chat",
    r"""WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(4 + 2 + 9 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<#:]', '', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""",
)
def op8_chat(spark, sf_dir):
    rows = chat.turns_of_table(table(spark, sf_dir, "conversations"))
    tricky = chat.turns_of_json(spark.createDataFrame([(TRICKY,)], "json string"))
    out = chat.format_turns(rows.unionByName(tricky))
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    read = out.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


# ------------------------------------------------------------------ 9 n-gram Jaccard join


@query(
    "op9_jaccard",
    f"""WITH RECURSIVE d AS (SELECT doc_id, md5(text) AS t, coalesce({WORDS_SQL}, []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
         JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
         GROUP BY a.doc_id, b.doc_id HAVING 5 * count(*) >= 4 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT r.a AS doc_id, min(r.b) AS class_id, (SELECT count(*) FROM link WHERE link.a = r.a) AS n_links FROM reach r GROUP BY r.a""",
)
def op9_jaccard(spark, sf_dir):
    return jaccard.similar(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 10 approximate nearest neighbours


@query("op10_ann")
def op10_ann(spark, sf_dir):
    found = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


# ------------------------------------------------------------------ 11 Merkle dataset manifest

LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + ")"


#: CRC-32 of the decimal doc_id, bit by bit: only its last bit is asked for.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


@query(
    "op11_merkle",
    f"""WITH RECURSIVE base AS MATERIALIZED (SELECT doc_id, source, {leaf_sql("text")} AS leaf,
    CASE WHEN {CRC_SQL} % 2 = 0 THEN {leaf_sql("replace(text, chr(10), '')")} ELSE {leaf_sql("text")} END AS given FROM documents),
placed AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM base),
node(tree, level, pos, n, d) AS (
    SELECT tree, 0, pos, count(*) OVER (PARTITION BY tree), leaf FROM placed
    UNION ALL SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY tree, level, pos // 3, n),
kept AS MATERIALIZED (SELECT * FROM node),
tops AS MATERIALIZED (SELECT tree, d FROM kept WHERE n = 1),
upper(level, pos, n, d) AS (
    SELECT 0, tree, (SELECT count(*) FROM tops), d FROM tops
    UNION ALL SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 3, n),
high AS MATERIALIZED (SELECT * FROM upper),
walk(tree, start, level, pos, given, proof) AS (
    SELECT tree, pos, 0, pos, given, '' FROM placed
    UNION ALL SELECT w.tree, w.start, w.level + 1, w.pos // 3, sha256(string_agg(CASE WHEN k.pos = w.pos THEN w.given ELSE k.d END, '' ORDER BY k.pos)),
        w.proof || coalesce(string_agg(CASE WHEN k.pos <> w.pos THEN k.d END, '' ORDER BY k.pos), '')
    FROM walk w JOIN kept k ON k.tree = w.tree AND k.level = w.level AND k.n > 1 AND k.pos // 3 = w.pos // 3
    GROUP BY w.tree, w.start, w.level, w.pos, w.given, w.proof),
below AS MATERIALIZED (SELECT tree, start, arg_max(given, level) AS given, arg_max(proof, level) AS proof FROM walk GROUP BY tree, start),
climb(tree, start, level, pos, given, proof) AS (
    SELECT tree, start, 0, tree, given, proof FROM below
    UNION ALL SELECT w.tree, w.start, w.level + 1, w.pos // 3, sha256(string_agg(CASE WHEN k.pos = w.pos THEN w.given ELSE k.d END, '' ORDER BY k.pos)),
        w.proof || coalesce(string_agg(CASE WHEN k.pos <> w.pos THEN k.d END, '' ORDER BY k.pos), '')
    FROM climb w JOIN high k ON k.level = w.level AND k.n > 1 AND k.pos // 3 = w.pos // 3
    GROUP BY w.tree, w.start, w.level, w.pos, w.given, w.proof),
ended AS (SELECT tree, start, arg_max(given, level) AS given, arg_max(proof, level) AS proof FROM climb GROUP BY tree, start)
SELECT p.doc_id, p.leaf, t.d AS subroot, r.d AS root, sha256(e.proof) AS proof_sha256, e.given AS folded_root, e.given = r.d AS verified
FROM placed p JOIN tops t USING (tree) JOIN ended e ON e.tree = p.tree AND e.start = p.pos JOIN (SELECT d FROM high WHERE n = 1) r ON true""",
)
def op11_merkle(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(*LEAF)
    kept = [F.col(c) for c in LEAF[:-1]]
    whole = merkle.leaf_digest([*kept, F.col("text")])
    altered = F.when(fold("doc_id", 2, 0), merkle.leaf_digest([*kept, F.replace(F.col("text"), F.lit("\n"), F.lit(""))])).otherwise(whole)
    rows = documents.select("doc_id", "source", whole.alias("whole"), altered.alias("given"))
    proved = merkle.verify(merkle.manifest(rows, F.col("whole"), "source", ["doc_id"]), "given")
    digest = lambda name: F.lower(F.hex(name)).alias(name)
    return proved.select(
        "doc_id", F.lower(F.hex("digest")).alias("leaf"), digest("subroot"), digest("root"),
        F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"), digest("folded_root"), "verified",
    )


# ------------------------------------------------------------------ 12 embedding whitening


@query("op12_whiten")
def op12_whiten(spark, sf_dir):
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


# ------------------------------------------------------------------ 13 embedding near-dedup


@query(
    "op13_descent",
    """WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
fine AS MATERIALIZED (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT r.a AS vec_id, (SELECT count(*) FROM link WHERE link.a = r.a) AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept FROM reach r GROUP BY r.a""",
)
def op13_descent(spark, sf_dir):
    return descent.near_duplicates(table(spark, sf_dir, "embeddings"))
