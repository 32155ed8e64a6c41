"""The operators as queries over whole tables, and as SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm import (
    audit, chat, decontaminate, language, licenses, mixing, quality, sharding, simhash, spelling, topk, toxicity,
    url_filter,
)
from careflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_chat_format", r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h')) AS chars,
    length(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c')) AS role_chars,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS starts
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN starts THEN 4 + role_chars + 2 + 8 ELSE 6 END) AS BIGINT) AS formatted_chars,
  CAST(sum(CASE WHEN starts THEN 1 ELSE 0 END) AS BIGINT) AS n_blocks
FROM marked GROUP BY conv_id
""")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = F.lit("\\### Assistant: </turn> ok")
    added = [
        spark.range(1).select(*[
            value.cast(turns.schema[name].dataType).alias(name) for name, value in
            (("conv_id", F.lit(-7)), ("turn", F.lit(turn)), ("role", F.lit(role)), ("text", probe))])
        for turn, role in enumerate(("user", "assistant"))
    ]
    chats = chat.format_chats(turns.unionByName(added[0]).unionByName(added[1]))
    read = chats.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_blocks")


@query("op2_topk_products", r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def topk_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op3_decontaminate")
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("coverage", F.col("n_covered") / F.col("n_words"))


@query("op4_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_language")
def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op8_fair_mix", r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS draw,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sources),
weighed AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM placed),
levels AS (
  SELECT a.*, a.cap / a.weight AS ratio,
    ((SELECT sum(source_size) FROM weighed)
      - coalesce((SELECT sum(b.cap) FROM weighed b WHERE (b.cap / b.weight, b.place) < (a.cap / a.weight, a.place)), 0))
    / ((SELECT sum(weight) FROM weighed)
      - coalesce((SELECT sum(b.weight) FROM weighed b WHERE (b.cap / b.weight, b.place) < (a.cap / a.weight, a.place)), 0))
      AS level_here
  FROM weighed a),
level AS (SELECT level_here AS level FROM levels WHERE cap >= level_here * weight ORDER BY ratio, place LIMIT 1),
targets AS (
  SELECT source, source_size, place,
    CASE WHEN cap < level * weight THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target
  FROM weighed, level),
queue AS (
  SELECT d.doc_id, d.draw, d.size, t.place, t.source_size, t.target,
    CAST(sum(d.size) OVER (PARTITION BY t.place ORDER BY d.draw ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT doc_id, size, sum(size) OVER (
    ORDER BY (again * source_size + upto) / target, place, again, draw ROWS UNBOUNDED PRECEDING) AS total
  FROM queue, (VALUES (0), (1), (2)) a(again) WHERE size > 0 AND again * source_size <= target),
taken AS (
  SELECT doc_id, sum(size) AS taken FROM turns WHERE total <= (SELECT sum(size) FROM docs) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queue q LEFT JOIN taken t USING (doc_id)
""")
def fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op9_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    based = F.filter("detections", lambda d: d["priority"] == licenses.BASE)
    starts = F.transform("base", lambda d: d["start"])
    base_labels = F.array_distinct(F.transform("base", lambda d: d["label"]))
    confidence = F.create_map(*[F.lit(x) for pair in licenses.CONFIDENCE.items() for x in pair])
    return scanned.withColumn("base", based).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, "kept")), ",").alias("labels"),
        F.coalesce(F.try_element_at(confidence, "best"), F.lit(0.0)).alias("score"))


#: (host, path, verdict)
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query("op10_url_filter", r"""
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed)
SELECT page_id, host, path,
  CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
  CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'allow'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'block'
    WHEN (host = 'net' OR host LIKE '%.net') AND (path LIKE '/es/%' OR path LIKE '/fr/%') THEN 'block'
    ELSE 'allow' END AS verdict
FROM split
""")
def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in URL_RULES])).alias("rule")).select("rule.*")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


#: crc32 of a text, as DuckDB has none: ``codes`` holds the remainders of all bytes.
_CODES = """codes AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    data = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


SHARDS = 8
_ROUNDS = ", ".join(f"({r}, {a}, {b}, {c})" for r, (a, b, c) in enumerate(sharding.round_keys(sharding.SEED)))


@query("op11_feistel_shards", f"""
WITH RECURSIVE {_CODES},
rounds AS (SELECT * FROM (VALUES {_ROUNDS}) v(r, factor, addend, second)),
rows AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32,
    row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS number
  FROM documents, codes),
total AS (SELECT count(*) AS n FROM documents),
sides AS (
  SELECT n, a, (n + a - 1) // a AS b
  FROM (SELECT n, (SELECT min(i) FROM range(1, 100000) s(i) WHERE i * i >= n) AS a FROM total)),
walk AS (
  SELECT number, number // b AS x, number % b AS y, 0 AS r FROM rows, sides
  UNION ALL
  SELECT number, CASE WHEN r % 2 = 0 THEN (x + mixed) % a ELSE x END, CASE WHEN r % 2 = 0 THEN y ELSE (y + mixed) % b END, r + 1
  FROM (
    SELECT *, (u * second + z) % 2147483647 AS mixed FROM (
      SELECT *, (v * v + addend) % 2147483647 AS u FROM (
        SELECT *, (z * factor + addend) % 2147483647 AS v FROM (
          SELECT w.number, w.x, w.y, k.r, k.factor, k.addend, k.second, s.a, s.b, CASE WHEN k.r % 2 = 0 THEN w.y ELSE w.x END AS z
          FROM walk w, sides s, rounds k
          WHERE k.r = w.r % {sharding.ROUNDS} AND (w.r < {sharding.ROUNDS} OR w.x * s.b + w.y >= s.n)))))),
placed AS (SELECT number, x * b + y AS place FROM walk, sides WHERE r = {sharding.ROUNDS} AND x * b + y < n)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
  CAST(place % {SHARDS} AS INTEGER) AS shard, CAST(place // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM rows JOIN placed USING (number)
""")
def feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op12_source_audit", r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
tokens AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS in_lang FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counts AS (
  SELECT t.lang, t.source, t.term, count(*) AS c FROM tokens t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(in_lang) AS n_lang FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS n, coalesce(l.v, 0) AS v, coalesce(l.n_lang, 0) AS n_lang
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN langs l ON g.lang = l.lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1) // (g.n + g.v) AS BIGINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (k.in_lang + 1) // (g.n_lang + g.v) AS BIGINT) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
""")
def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_sources(table(spark, sf_dir, "documents"), least=3, top=200)


#: One occurrence in so many has a letter deleted.
SLIP = 97


@query("op13_spelling_variants", rf"""
WITH RECURSIVE {_CODES},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, c, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted, codes),
slipped AS (
  SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
  FROM hashed),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
shapes AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM shapes a JOIN shapes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shapes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shapes a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
paths AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT p.word, f.form FROM paths p JOIN formed f ON p.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.at AS root FROM paths p JOIN formed f ON p.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM formed f JOIN ends e ON f.word = e.word
""")
def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), length=5, times=3, slip=SLIP)
    return spelling.spelling_variants(words)
