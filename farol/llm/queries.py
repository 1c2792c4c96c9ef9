"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.llm import ann, bpe, chat, codes, countjoin, decontam, kit, langid, licenses, merkle, simhash, suffixes, toxicity, urlfilter
from farol.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = kit.crc_mod("doc_id", 4) == 2
    return langid.predict(docs, langid.fit(docs.where(~held)), [held.alias("held_out")])


@query("op4_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), bpe.vocabulary_text(public_tokenizers.path("byte_bpe_50k.json")))


@query("op5_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)


@query("op6_chat_format", """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, replace(replace(replace(text, '~', '~0'), '<', '~1'), '[', '~2') AS x,
             replace(replace(replace(role, '~', '~0'), '<', '~1'), '[', '~2') AS r FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, x)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, x) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(23 + length(r) + length(x))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                    "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    made = chat.format_chats(rows.select("conv_id", "turn", "role", F.array(chat.text_part(F.col("text"))).alias("parts")))
    turns = F.transform(chat.parse(F.col("formatted")), lambda t: F.concat(chat.unescape(t["role"]), F.lit("\n"), chat.unescape(t["body"]), F.lit("\n")))
    read = made.withColumn("turns", turns).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_mask")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.concat_ws("", "turns"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


@query("op8_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = kit.crc_mod("doc_id", 3) == 1
    return toxicity.score(docs, toxicity.fit(docs.where(~held), labels.where(~held)), [held.alias("held_out")])


@query("op9_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.verdicts(table(spark, sf_dir, "pages"))


@query("op3_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(20)) == 0), k=20)


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: a folder per source, in it folders of a thousand ids; every 50th document is its folder's LICENSE."""
    name = F.when(F.pmod("doc_id", F.lit(50)) == 0, "LICENSE").otherwise(F.concat(F.lit("f"), F.col("doc_id").cast("string")))
    folder = F.concat(F.lit("d"), F.floor(F.col("doc_id") / 1000).cast("string"))
    return docs.select("doc_id", "text", F.concat_ws("/", "source", folder, name).alias("path"))


@query("op10_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(as_files(table(spark, sf_dir, "documents")))


@query("op1_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents"), window=200)


@query("op7_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


_LEVEL = "SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {0} WHERE n > 1 GROUP BY tree, level, pos // 2, n"
_FOLD = """SELECT f.id, f.tree, f.level + 1, f.pos // 2, (f.n + 1) // 2, f.proof || coalesce(s.h, ''),
       sha256(CASE WHEN s.h IS NULL THEN f.folded WHEN f.pos % 2 = 0 THEN f.folded || s.h ELSE s.h || f.folded END)
FROM {0} f LEFT JOIN {1} s ON s.tree = f.tree AND s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1"""


@query("op13_merkle", f"""
WITH RECURSIVE own AS (
  SELECT row_number() OVER () AS id, doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('(n_chars + 1)')} AS changed,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) AS crc
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n, CASE WHEN crc % 7 = 0 THEN changed ELSE leaf END AS held FROM own),
nodes(tree, level, pos, n, h) AS (SELECT tree, 0, pos, n, leaf FROM leaves UNION ALL {_LEVEL.format('nodes')}),
subroots AS MATERIALIZED (SELECT tree AS under, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(tree, level, pos, n, h) AS (SELECT '', 0, pos, n, h FROM subroots UNION ALL {_LEVEL.format('tops')}),
low(id, tree, level, pos, n, proof, folded) AS (SELECT id, tree, 0, pos, n, '', held FROM leaves UNION ALL {_FOLD.format('low', 'nodes')}),
high(id, tree, level, pos, n, proof, folded) AS (
  SELECT l.id, '', 0, s.pos, s.n, l.proof, l.folded FROM low l JOIN subroots s ON s.under = l.tree WHERE l.n = 1 UNION ALL {_FOLD.format('high', 'tops')})
SELECT d.doc_id, d.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = t.h AS verified
FROM leaves d JOIN high f ON f.id = d.id AND f.n = 1 JOIN subroots s ON s.under = d.tree, tops t WHERE t.n = 1""")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    seventh = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    made = merkle.manifest(merkle.document_leaves(table(spark, sf_dir, "documents"), seventh))
    return made.withColumnRenamed("order", "doc_id")


def _lloyd(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds as one common table expression each: assignment, then books."""
    def assigned(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (SELECT id, k, c, min((off, e)) AS m FROM (
  SELECT p.id, p.k, p.c, b.e, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.c, b.c)])::HUGEINT AS off FROM parts p JOIN b{r} b USING (k)) GROUP BY id, k, c)"""

    def books(r: int) -> str:
        return f"""b{r + 1} AS MATERIALIZED (SELECT b.k, b.e, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN (
  SELECT k, e, list(v ORDER BY j) AS c FROM (SELECT k, m[2] AS e, j, floor(sum(c[j])::DOUBLE / count(*))::HUGEINT AS v FROM a{r}, range(1, len(a{r}.c) + 1) t(j) GROUP BY ALL)
  GROUP BY k, e) n USING (k, e))"""

    steps = [f for r in range(rounds) for f in (assigned(r), books(r))] + [assigned(rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label, [floor(4096 * x::DOUBLE)::HUGEINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT id, k, v[k * (len(v) // {parts}) + 1 : (k + 1) * (len(v) // {parts})] AS c FROM kept, range(0, {parts}) t(k)),
b0 AS MATERIALIZED (SELECT k, id - 1 AS e, c FROM parts WHERE id <= {entries}),
{", ".join(steps)},
coded AS (SELECT id, string_agg(printf('%02x', m[2]::INT), '' ORDER BY k) AS code, sum(m[1])::BIGINT AS error FROM a{rounds} GROUP BY id),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY k, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (id), sha"""


@query("op12_vector_codes", _lloyd())
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.product_codes(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


@query("op11_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS id, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (SELECT id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                                   ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END)) AS g FROM w),
sizes AS MATERIALIZED (SELECT id, count(*) AS n FROM s GROUP BY id),
links AS MATERIALIZED (
  SELECT x, y FROM (SELECT a.id AS x, b.id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.id <> b.id GROUP BY ALL)
  JOIN sizes m ON m.id = x JOIN sizes n ON n.id = y WHERE 100 * c >= 85 * (m.n + n.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
low AS (SELECT r.x AS id, min(w.doc_id) AS other FROM reach r JOIN w ON w.id = r.y GROUP BY r.x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, other) AS component_id FROM w LEFT JOIN sizes USING (id) LEFT JOIN low USING (id)""")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countjoin.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)
