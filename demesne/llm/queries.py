"""Queries of this subpackage: one opN_<name> for each operator, with SQL where SQL can state the result."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    """Register fn(spark, sf_dir) under a name."""

    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


# Each module of operators is imported where its queries are stated.
from pyspark.sql import functions as F  # noqa: E402

from demesne.llm import bpe, decontaminate, fingerprints, jaccard, language, licenses, mixing, quality, spelling, substrings, token_output, toxicity, trie  # noqa: E402
from demesne.llm.common import table  # noqa: E402

#: The vocabulary of the token-id output and the id that ends a document.
END_ID = 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op2_document_fingerprints")
def op2(spark, sf_dir):
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


_OP3 = f"""WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(source, '') AS s, greatest(length(coalesce(text, '')), 1) AS n, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
p AS (SELECT doc_id, source, s, coalesce(sum(n) OVER (PARTITION BY s ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM d),
w AS (SELECT s, b, sqrt(b) AS w, row_number() OVER (ORDER BY s) AS i FROM (SELECT s, CAST((sum(n) + {mixing.BLOCK_CHARS - 1}) // {mixing.BLOCK_CHARS} AS BIGINT) AS b FROM d GROUP BY 1)),
e AS (SELECT i, k, (SELECT sum(least(z.b, z.w * (k / q.w))) FROM w z) AS x, (SELECT sum(least(z.b, z.w * ((k + 1) / q.w))) FROM w z) AS y FROM (SELECT i, w, unnest(range(0, b)) AS k FROM w) q),
l AS (SELECT list(f ORDER BY i) AS f, list(u ORDER BY i) AS u, sum(len(f)) AS m FROM (SELECT i, list(CAST(floor(x + {mixing.SLACK}) AS BIGINT) ORDER BY k) AS f, list(CAST(ceil(y - {mixing.SLACK}) AS BIGINT) ORDER BY k) AS u FROM e GROUP BY i)),
g AS (SELECT f, u, m, CAST(-1 AS BIGINT) AS t, list_transform(f, lambda v: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS pick FROM l
  UNION ALL SELECT f, u, m, t, done, list_min(list_transform(range(1, len(f) + 1), lambda i: CASE WHEN done[i] < len(f[i]) AND f[i][done[i] + 1] <= t THEN u[i][done[i] + 1] * 1048576 + i ELSE 4611686018427387904 END)) % 1048576
    FROM (SELECT f, u, m, t + 1 AS t, list_transform(range(1, len(f) + 1), lambda i: done[i] + CASE WHEN i = pick THEN 1 ELSE 0 END) AS done FROM g WHERE t + 1 < m)),
o AS (SELECT pick AS i, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k FROM g WHERE t >= 0)
SELECT p.doc_id, p.source, o.t AS slot, CAST(x % {mixing.BLOCK_CHARS} AS BIGINT) AS place FROM p JOIN w ON w.s = p.s JOIN o ON o.i = w.i AND o.k = x // {mixing.BLOCK_CHARS}"""


@register("op3_source_mixing", _OP3)
def op3(spark, sf_dir):
    return mixing.schedule(table(spark, sf_dir, "documents"), columns=["doc_id", "source"])


@register("op4_token_ids")
def op4(spark, sf_dir):
    return token_output.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def remainder(n: int):
    """crc32 of the key as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@register("op1_quality_classifier")
def op1(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(5) == 0, 0.3)


@register("op5_benchmark_decontamination")
def op5(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_license_scan")
def op6(spark, sf_dir):
    return licenses.license_notices(table(spark, sf_dir, "documents"))


@register("op9_language_id")
def op9(spark, sf_dir):
    """Languages of all web pages (page_id) and all documents (doc_id)."""
    pages = language.identify(language.evidence_from_pages(table(spark, sf_dir, "pages")))
    docs = language.identify(language.evidence_from_documents(table(spark, sf_dir, "documents")))
    rest = ["host", "declared", "language", "posterior", "accepted"]
    none = F.lit(None).cast("long")
    return docs.select(F.col("key").alias("doc_id"), none.alias("page_id"), *rest).union(pages.select(none, "key", *rest))


@register("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) == 1, 0.7)


_OP7 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT DISTINCT doc_id AS d, doc_id AS m FROM documents UNION SELECT e.y, r.m FROM r JOIN e ON e.x = r.d)
SELECT o.doc_id, coalesce(n.n, 0) AS n_shingles, k.m AS component_id FROM documents o LEFT JOIN n ON n.doc_id = o.doc_id JOIN (SELECT d, min(m) AS m FROM r GROUP BY 1) k ON k.d = o.doc_id"""

_OP8 = """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM b)),
t AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, p, sum(CASE WHEN p <= q + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM t)),
u AS (SELECT doc_id, min(p) AS x, max(p) + 100 AS y FROM g GROUP BY doc_id, r),
v AS (SELECT doc_id, count(*) AS c, sum(y - x) AS d FROM u GROUP BY 1),
k AS (SELECT doc_id, 0 AS x, 0 AS y FROM b UNION ALL SELECT doc_id, x, y FROM u),
f AS (SELECT doc_id, y, lead(x) OVER (PARTITION BY doc_id ORDER BY x, y) AS z FROM k),
j AS (SELECT f.doc_id, string_agg(substr(h, 2 * y + 1, 2 * (coalesce(z, length(h) // 2) - y)), '' ORDER BY y, z) AS o FROM f JOIN b ON b.doc_id = f.doc_id GROUP BY 1)
SELECT b.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(d, 0) AS BIGINT) AS n_removed, coalesce(c, 0) AS n_spans, sha256(unhex(coalesce(o, ''))) AS kept_sha256
FROM b LEFT JOIN v ON v.doc_id = b.doc_id LEFT JOIN j ON j.doc_id = b.doc_id"""


@register("op7_ngram_jaccard_join", _OP7)
def op7(spark, sf_dir):
    return jaccard.link_documents(table(spark, sf_dir, "documents"), 3, 90)


@register("op8_suffix_array_dedup", _OP8)
def op8(spark, sf_dir):
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


@register("op11_bpe_codec")
def op11(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce(flatten([[4294967295]] || list_transform(range(1, length(CAST({0} AS VARCHAR)) + 1), lambda i: [ord(CAST({0} AS VARCHAR)[i]), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, 3988292384 * (a % 2)) END), 4294967295)"""

_OP12 = f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, {_CRC.format("c")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, 0 AS s, p, role, text FROM h JOIN t ON t.c = h.c - h.c % 100 AND p <= h UNION ALL SELECT h.c, 1, p, role, text FROM h JOIN t ON t.c = h.c AND p > h),
n AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY s, p) AS d, md5(length(role) || ':' || role || text) AS k, length(text) AS size FROM r),
q AS (SELECT c, d, size, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS name FROM n UNION ALL SELECT c, 0, 0, '' FROM h),
g AS (SELECT name, d, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size FROM q GROUP BY 1, 2),
k AS (SELECT left(name, length(name) - 32) AS name, count(*) AS n FROM g WHERE d > 0 GROUP BY 1),
e AS (SELECT name, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha FROM q JOIN (SELECT c, max(d) AS d FROM q GROUP BY 1) USING (c, d) GROUP BY 1),
s AS (SELECT q.name, sum((g.n_convs - 1) * g.size) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves FROM g LEFT JOIN k ON k.name = g.name JOIN q ON q.c = g.conv_id AND q.d <= g.d GROUP BY 1)
SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM g JOIN s ON s.name = g.name LEFT JOIN k ON k.name = g.name LEFT JOIN e ON e.name = g.name LEFT JOIN g o ON g.d > 0 AND o.name = left(g.name, length(g.name) - 32)"""


@register("op12_conversation_trie", _OP12)
def op12(spark, sf_dir):
    c = F.col("c")
    return trie.conversation_trie(table(spark, sf_dir, "conversations"), c - c % 100, F.crc32(c.cast("string")) % 6, 5)


_OP13 = """WITH RECURSIVE d AS (SELECT CAST(doc_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zA-Z\\x{00C0}-\\x{00FF}]+') AS ws FROM documents),
o AS (SELECT id, w, count(*) AS k FROM (SELECT coalesce(id, '') AS id, unnest(ws) AS w FROM d) WHERE length(w) >= 6 GROUP BY 1, 2),
h AS (SELECT w, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(id || ':' || w, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] ELSE [CAST(192 + ord(ch) // 64 AS BIGINT), 128 + ord(ch) % 64] END))),
  lambda a, b: xor(a // 256, t.t[xor(a, b) % 256 + 1])), 4294967295) AS h FROM o, (SELECT list(x ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS x FROM range(256) r(i))) t),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) + 2 AS BIGINT)) ELSE w END AS word, k FROM h) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5),
v AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS c FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
x AS (SELECT DISTINCT v.word AS a, v.n AS an, w.word AS b, w.n AS bn FROM v JOIN w ON w.word = v.c),
p AS (SELECT a.word AS a, b.word AS b, b.n AS bn FROM v a JOIN v b ON a.c = b.c AND a.i = b.i AND a.word <> b.word UNION ALL SELECT a, b, bn FROM x UNION ALL SELECT b, a, an FROM x),
q AS (SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, b) AS b, max(bn) AS bn FROM p GROUP BY 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 5 * w.n THEN b END AS form, CASE WHEN bn >= 5 * w.n THEN bn END AS form_n FROM w LEFT JOIN q ON q.a = w.word),
r AS (SELECT word, word AS at FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word JOIN f z ON z.word = r.at WHERE z.form IS NULL"""


@register("op13_spelling_variants", _OP13)
def op13(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), 6, 5, 5, 199)
