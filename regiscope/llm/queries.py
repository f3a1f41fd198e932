"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.llm import ballcodes, bytebpe, decontaminate, jaccard, kdtree, langid, linededup, mincut, pieces, pii, toxicity, turns, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(divisor: int, column: str = "doc_id"):
    """crc32 of the id as text, by the divisor; null for a null id, which is neither learned from nor held out."""
    return F.crc32(F.col(column).cast("string")) % divisor


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines that aren't blank, lines deleted, SHA-256 of the text that stays."""
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return mincut.extract(pages, mincut.train(pages))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(fold(3) != 1).select("doc_id", "text", "lang"))
    return langid.identify(docs, model).select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).drop("found")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf_dir, "documents"), model_path())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.train(docs, labels.where(fold(5) != 0))
    return toxicity.score(docs, chain).select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ballcodes.encode(table(spark, sf_dir, "embeddings"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(table(spark, sf_dir, "conversations"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bytebpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (op1_warc_round_trip, op2_line_dedup, op3_jaccard_join, op4_top_k, op5_main_text, op6_language, op7_decontaminate, op8_personal_data, op9_pieces, op10_toxicity, op11_ball_codes, op12_turn_repair, op13_byte_pairs)}

_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS owner,
             CAST(unhex(hex) AS BIT)::VARCHAR AS bits FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
              + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
              + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INT) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM d"""


_OP2 = """
WITH a AS (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, k, string_split(text, chr(10))[k] AS line FROM a),
w AS (SELECT *, len(list_filter(regexp_split_to_array(line, '[ \\t\\n\\f\\r\\x0B]+'), lambda x: x <> '')) AS n FROM l),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS o,
             sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM w WHERE n > 0),
win AS (
    SELECT x.doc_id, x.o AS s, min(y.o) AS e FROM b x JOIN b y ON x.doc_id = y.doc_id AND y.o >= x.o AND y.upto - x.upto + x.n >= 50 GROUP BY ALL
    UNION
    SELECT y.doc_id, max(x.o) AS s, y.o AS e FROM b y JOIN b x ON x.doc_id = y.doc_id AND y.o >= x.o AND y.upto - x.upto + x.n >= 50 GROUP BY y.doc_id, y.o),
txt AS (SELECT win.doc_id, s, e, string_agg(line, chr(10) ORDER BY o) AS body FROM win JOIN b ON b.doc_id = win.doc_id AND b.o BETWEEN s AND e GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS copy FROM txt),
gone AS (SELECT DISTINCT b.doc_id, b.k FROM ranked r JOIN b ON b.doc_id = r.doc_id AND b.o BETWEEN r.s AND r.e WHERE r.copy > 1),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.k) AS text FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.k = gone.k GROUP BY l.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM b GROUP BY doc_id),
losses AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN losses g USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

_OP3 = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
least AS (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.c, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)"""

_OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos, w FROM d, sizes WHERE len(w) >= size),
hits AS (SELECT dw.doc_id, pos, dw.size, item_id FROM (SELECT doc_id, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS win FROM dw) dw JOIN iw ON iw.win = dw.win AND iw.size = dw.size),
places AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS p FROM hits),
n AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""


def _op11(rounds: int = 6) -> str:
    """The rounds as steps of plain comparison with all entries."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT vec_id, label, part, any_value(x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best
    FROM p JOIN c{k} USING (part) GROUP BY vec_id, label, part)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (SELECT part, e, list(m ORDER BY pos) AS c FROM (SELECT part, best.e AS e, pos, CAST(floor(CAST(sum(x[pos]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM (SELECT part, best, x, unnest(range(1, len(x) + 1)) AS pos FROM a{k}) GROUP BY ALL) GROUP BY part, e),
c{k + 1} AS MATERIALIZED (SELECT c{k}.part, c{k}.e, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (part, e))""")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] AS x FROM v, range(8) AS t(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c FROM p QUALIFY e < 16),
{",".join(steps)},
b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS books FROM c{rounds}),
r AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, books AS codebooks_sha256 FROM r, b"""


def _op12() -> str:
    """Dynamic programming by rows in place of the search: the cheapest edits to each state, by cost, then audit."""

    def way(state: str, cost: str, edit: str, line: str, when: str = "TRUE") -> str:
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN struct_pack(c := {state}.c + {cost}, a := {state}.a || '{edit}', r := {state}.r || {line}) END"

    def least(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda z: z IS NOT NULL))[1]"

    user, assistant, own = "'user:' || chr(10)", "'assistant:' || chr(10)", "role || ':' || text || chr(10)"
    changed = lambda role: f"'{role}:' || text || chr(10)"
    stays, more = "fault <> 1", "CASE WHEN fault = 2 THEN 3 ELSE 0 END"
    keep = lambda state, initial: way(state, more, "K", own, f"{stays} AND role[1] = '{initial}'")
    rerole = lambda state, role: way(state, f"3 + {more}", "R", changed(role), stays)
    go = lambda state: way(state, "4", "D", "''")
    one, two = [way(f"x{k}", "3", "I", user) for k in (0, 1, 3)], [way(f"x{k}", "6", "II", f"{user} || {assistant}") for k in (0, 1)]
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
v AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS v FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN v = 4 THEN 'user' ELSE role END AS role, CASE v WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE v WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM v WHERE v <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS said, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
g AS MATERIALIZED (SELECT conv_id, turn, role, text, i, CASE WHEN bare = '' THEN 'blank' WHEN said > 1 THEN 'duplicate' WHEN NOT contains('.!?', bare[-1]) THEN 'truncated' ELSE '' END AS name,
    coalesce(before[1] || role[1] NOT IN ('su', 'ua', 'au'), FALSE) AS bad FROM f),
h AS MATERIALIZED (SELECT *, CASE WHEN name IN ('blank', 'duplicate') THEN 1 WHEN name = 'truncated' THEN 2 ELSE 0 END AS fault FROM g),
k AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (name = 'blank') AS blank, count(*) FILTER (name = 'duplicate') AS duplicate,
    count(*) FILTER (name = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal, count(*) AS n FROM h GROUP BY conv_id),
w AS (SELECT conv_id, 0 AS pos, struct_pack(c := CAST(0 AS BIGINT), a := '', r := '') AS x0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS x1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS x2,
        CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS x3 FROM k
    UNION ALL
    SELECT conv_id, pos, {go("x0")}, {least(go("x1"), keep("x0", "s"))},
        {least(go("y2"), keep("x0", "u"), keep("x1", "u"), keep("y3", "u"), rerole("x0", "user"), rerole("x1", "user"), rerole("y3", "user"))},
        {least(go("y3"), keep("y2", "a"), rerole("y2", "assistant"))}
    FROM (SELECT w.conv_id, i AS pos, role, text, fault, x0, x1, {least("x2", *one)} AS y2, {least("x3", way("x2", "3", "I", assistant), *two)} AS y3 FROM w JOIN h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.i = w.pos + 1)),
z AS (SELECT w.conv_id, {least("x0", "x3", way("x2", "3", "I", assistant), way("x1", "6", "II", f"{user} || {assistant}"))} AS z, k.* EXCLUDE (conv_id, n)
    FROM w JOIN k ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND k.n = w.pos)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(z.c, 0) AS cost, coalesce(z.a, '') AS audit, sha256(coalesce(z.r[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE_SQL = {"op1_warc_round_trip": _OP1, "op2_line_dedup": _OP2, "op3_jaccard_join": _OP3, "op4_top_k": _OP4, "op7_decontaminate": _OP7, "op11_ball_codes": _op11(), "op12_turn_repair": _op12()}
