"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, exactdedup, langid, lexsearch, licenses, linededup, maxscore, merkle, mixing, nearjoin, packing, sharding

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk, sum(source_size) OVER () * 1.5::DOUBLE AS whole FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2.0::DOUBLE * source_size AS top FROM r),
q AS (SELECT a.source, a.source_size, a.weight, a.top, a.rk,
        (a.whole - (SELECT coalesce(sum(b.top), 0) FROM w b WHERE (b.top / b.weight, b.rk) < (a.top / a.weight, a.rk)))
        / (SELECT sum(b.weight) FROM w b WHERE (b.top / b.weight, b.rk) >= (a.top / a.weight, a.rk)) AS share
      FROM w a),
l AS (SELECT first(share ORDER BY top / weight, rk) AS level FROM q WHERE share <= top / weight),
t AS (SELECT source, source_size, least(top, level * weight) AS target FROM q, l),
c AS (SELECT d.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS copies,
        sum(size) OVER (PARTITION BY d.source ORDER BY key) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN (target - copies * source_size) > 0
     AND before + size / 2.0 <= target - copies * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""


@query("op10_mix", OP10_SQL)
def op10_mix(spark, sf):
    return mixing.mix_plan(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM t),
h AS (SELECT *, list((role, text)) OVER (PARTITION BY conv_id ORDER BY place) AS pre,
             count(*) OVER (PARTITION BY conv_id) AS n FROM p),
w AS (SELECT pre, n, min(conv_id) AS conv_id, count(*) AS copies FROM h WHERE place = n GROUP BY pre, n),
k AS (SELECT * FROM w WHERE pre NOT IN (SELECT pre FROM h WHERE place < n))
SELECT k.conv_id, (p.place - 1) // 64 AS part, k.n::BIGINT AS n_turns, k.copies,
  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
FROM k JOIN p ON k.conv_id IS NOT DISTINCT FROM p.conv_id GROUP BY ALL
"""


@query("op3_chat", OP3_SQL)
def op3_chat(spark, sf):
    return chat.format_chats(table(spark, sf, "conversations"))


OP4_SQL = r"""
WITH x AS (
  SELECT page_id, coalesce(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', ''), '') AS host,
    list_filter(list_transform(string_split_regex(coalesce(
      regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'),
        '(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|header|footer|article|section|title|body|head|html|blockquote|pre)\b[^>]*>', chr(10), 'g'),
        '<[^>]*>', ' ', 'g'), ''), '[\r\n]+'),
      lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '') AS lines
  FROM pages),
d AS (SELECT DISTINCT page_id, host, lines FROM x),
c AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM d) GROUP BY host, line),
b AS (SELECT c.host, list(c.line) AS gone FROM c JOIN (SELECT host, count(*) AS total FROM d GROUP BY host) h ON c.host = h.host
      WHERE n >= 3 AND n > 0.2 * total GROUP BY c.host),
k AS (SELECT page_id, d.host, lines, list_filter(lines, lambda s: NOT coalesce(list_contains(gone, s), false)) AS kept
      FROM d LEFT JOIN b ON d.host = b.host)
SELECT page_id, host, len(lines)::INT AS n_lines, (len(lines) - len(kept))::INT AS n_dropped, array_to_string(kept, chr(10)) AS text
FROM k
"""


@query("op4_line_dedup", OP4_SQL)
def op4_line_dedup(spark, sf):
    return linededup.drop_boilerplate(table(spark, sf, "pages"))


SHARD_BYTES = 8 << 20

OP7_SQL = f"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key,
                  coalesce(strlen(text), 0)::BIGINT + 64 AS bytes FROM documents),
p AS (SELECT d.*, depth::INT AS depth, key >> (60 - depth) AS prefix FROM d, range(0, 21) r(depth)),
b AS (SELECT *, sum(bytes) OVER (PARTITION BY depth, prefix)::BIGINT AS shard_bytes,
             count(*) OVER (PARTITION BY depth, prefix) AS n FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS k FROM b WHERE shard_bytes <= {SHARD_BYTES} OR n = 1)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(ltrim(bin(prefix), '0'), depth, '0') END AS shard,
       depth, 0::INT AS part, shard_bytes FROM f WHERE k = 1
"""


@query("op7_shard", OP7_SQL)
def op7_shard(spark, sf):
    return sharding.shard(table(spark, sf, "documents"), SHARD_BYTES)


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]) END) AS g FROM d),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(g) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 85 * (na.n + nb.n - o)),
r AS (SELECT a AS doc_id, a AS seen FROM (SELECT DISTINCT a FROM l)
      UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT n.doc_id, n.n AS n_shingles, coalesce(min(r.seen), n.doc_id) AS component_id
FROM n LEFT JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""


@query("op8_ngram_join", OP8_SQL)
def op8_ngram_join(spark, sf):
    return nearjoin.near_components(table(spark, sf, "documents"), k=4, percent=85).select(
        "doc_id", "n_shingles", "component_id")


@query("op1_pack")
def op1_pack(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


def held_out(doc_id):
    """Documents that nothing is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


@query("op2_langid")
def op2_langid(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "__language.lang_pred", "__language.score")


OP6_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op6_maxscore", OP6_SQL)
def op6_maxscore(spark, sf):
    return maxscore.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op9_licenses")
def op9_licenses(spark, sf):
    found = licenses.scan(table(spark, sf, "documents"))
    joined = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*c))), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first").alias("first_word"), F.array_max("places.first").alias("last_word"),
        joined("places.label").alias("base_labels"), joined("places.label", "detections.label").alias("labels"),
        F.col("confidence").alias("score"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT * FROM (SELECT item_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) >= 8),
m AS (SELECT unnest([[0,1,3,4,6,7], [0,2,3,4,5,7], [0,1,2,5,6,7], [0,1,3,5,7,8], [0,1,2,3,4,5]]) AS o),
ds AS (SELECT doc_id, p, o, array_to_string(list_transform(o, lambda k: w[p + k + 1]), ' ') AS seed
       FROM (SELECT doc_id, w, unnest(range(0, len(w) - 5)) AS p FROM d), m WHERE p + o[6] < len(w)),
bs AS (SELECT item_id, p, o, array_to_string(list_transform(o, lambda k: w[p + k + 1]), ' ') AS seed
       FROM (SELECT item_id, w, unnest(range(0, len(w) - 5)) AS p FROM b), m WHERE p + o[6] < len(w)),
h AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS start FROM ds JOIN bs ON ds.seed = bs.seed AND ds.o = bs.o),
a AS (SELECT h.*, len(b.w) AS n_item,
        list_transform(range(greatest(0, -start), least(len(b.w), len(d.w) - start)), lambda i: (b.w[i + 1] = d.w[i + 1 + start])::INT) AS same
      FROM h JOIN d USING (doc_id) JOIN b USING (item_id)),
v AS (SELECT *, list_sum(same) AS n_equal FROM a WHERE len(same) >= least(13, n_item)
      AND len(list_filter(range(0, len(same) - least(13, n_item) + 1), lambda i: 100 * list_sum(same[i + 1 : i + least(13, n_item)]) >= 80 * least(13, n_item))) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, start) AS k FROM v)
SELECT doc_id, item_id, start::INT AS start, len(same)::INT AS n_aligned, n_equal::INT AS n_equal FROM r WHERE k = 1
"""


@query("op5_decontam", OP5_SQL)
def op5_decontam(spark, sf):
    return decontam.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("text_key")


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
        row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM r
"""


@query("op11_exact_dedup", OP11_SQL)
def op11_exact_dedup(spark, sf):
    return exactdedup.decide(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
n AS (SELECT r, doc_id, w, len(w)::BIGINT AS len FROM d WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(len)::BIGINT AS terms FROM n),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM n) GROUP BY r, t),
df AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
       FROM (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t), s),
m AS (SELECT r, doc_id, 25 + (75 * len * docs) // terms AS m FROM n, s),
q AS (SELECT item_id, t, count(*)::BIGINT AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN df USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


@query("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark, sf):
    return lexsearch.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


def _field(c):
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR END"


def _leaf(text):
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


OP13_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT *, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS changed,
    doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: z::UBIGINT)),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT) % 2 = 0 AS tampered
  FROM documents),
p AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
t AS (SELECT source, 0 AS level, 1 AS step, list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS a FROM d GROUP BY source
      UNION ALL SELECT source, level + 1, step * 3, list_transform(range((len(a) + 2) // 3), lambda i: sha256(array_to_string(a[3 * i + 1 : 3 * i + 3], ''))) FROM t WHERE len(a) > 1),
s AS (SELECT source, a[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM t WHERE len(a) = 1),
u AS (SELECT 0 AS level, 1 AS step, list(subroot ORDER BY place) AS a FROM s
      UNION ALL SELECT level + 1, step * 3, list_transform(range((len(a) + 2) // 3), lambda i: sha256(array_to_string(a[3 * i + 1 : 3 * i + 3], ''))) FROM u WHERE len(a) > 1),
w AS (SELECT r, level, p.place // step AS i, a FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source WHERE len(a) > 1
      UNION ALL SELECT r, 1000 + level, s.place // step, a FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source, u WHERE len(a) > 1),
x AS (SELECT r, level, array_to_string(a[i - i % 3 + 1 : i], '') AS l, array_to_string(a[i + 2 : i - i % 3 + 3], '') AS r2 FROM w),
y AS (SELECT r, string_agg(l || r2, '' ORDER BY level) AS proof, list({{'l': l, 'r': r2}} ORDER BY level) AS steps FROM x GROUP BY r),
z AS (SELECT p.*, subroot, (SELECT a[1] FROM u WHERE len(a) = 1) AS root, coalesce(proof, '') AS proof, coalesce(steps, []) AS steps
      FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN y USING (r)),
f AS (SELECT *, list_reduce(list_prepend({{'l': CASE WHEN tampered THEN changed ELSE leaf END, 'r': ''}}, steps),
        lambda x, y: {{'l': sha256(y.l || x.l || y.r), 'r': ''}}).l AS folded_root FROM z)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""


@query("op13_merkle", OP13_SQL)
def op13_merkle(spark, sf):
    docs = table(spark, sf, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    less = merkle.leaf(*[F.col(c) for c in fields[:-1]], F.translate("text", "\n", ""))
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.unhex(less))
    rows = merkle.manifest(docs, fields, carry={"changed": changed})
    given = F.coalesce(F.lower(F.hex("changed")), F.col("leaf"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
                       merkle.fold(given, F.col("path"), F.col("shape")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
