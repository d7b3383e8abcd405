"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL.

Each applies one operator, with production parameters, to the whole of its table.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(prepare(spark), sf_dir.rstrip("/"))
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return deco


@query("op1_simhash")
def op1(spark, sf_dir):
    from corpusflow.llm.simhash import simhash_components
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, radius=3)


@query("op2_decontaminate")
def op2(spark, sf_dir):
    from corpusflow.llm.decontaminate import leaks
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least_words=1).drop("tiles")


@query("op3_byte_bpe")
def op3(spark, sf_dir):
    from corpusflow.llm.bpe import encode_documents
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_lm_score")
def op4(spark, sf_dir):
    from corpusflow.llm.common import held_out
    from corpusflow.llm.lm_score import score, train
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs.where(~held_out("doc_id", 7, 2)))).withColumn("held_out", held_out("doc_id", 7, 2))


@query("op5_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op5(spark, sf_dir):
    from corpusflow.llm.exact_dedup import exact_dedup
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query("op6_licenses")
def op6(spark, sf_dir):
    from corpusflow.llm.licenses import scan
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


@query("op7_language_id")
def op7(spark, sf_dir):
    from corpusflow.llm.common import held_out
    from corpusflow.llm.language_id import identify, train
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = train(docs.where(~held_out("doc_id", 3, 1)))
    return identify(docs, net).withColumn("held_out", held_out("doc_id", 3, 1))


@query("op8_warc", """
SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(bits, 1 + 5 * i::INT, 5))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last,
             array_to_string(list_transform(string_split(sha1(coalesce(html, '')), ''), lambda h: lpad(bin(strpos('0123456789abcdef', h) - 1), 4, '0')), '') AS bits
      FROM pages)""")
def op8(spark, sf_dir):
    from corpusflow.llm.warc import archive_folder, read_records, write_archives
    folder = archive_folder(spark)
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder, least_bytes=0)
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_token_counts")
def op9(spark, sf_dir):
    from corpusflow.llm.token_counts import length_histogram, token_lengths
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return length_histogram(token_lengths(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


@query("op10_url_filter")
def op10(spark, sf_dir):
    from corpusflow.llm.url_filter import judge
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op11_suffix_dedup", """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
blocks AS (SELECT r, b, substr(x, 2 * b + 1, 1422) AS y
           FROM (SELECT r, x, unnest(range(0, length(x) // 2 - 199, 512)) AS b FROM texts WHERE length(x) >= 400)),
windows AS (SELECT r, b + i AS s, md5(substr(y, 2 * i + 1, 400)) AS w
            FROM (SELECT r, b, y, unnest(range(0, length(y) // 2 - 199)) AS i FROM blocks)),
hits AS (SELECT r, s FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)),
runs AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS run
         FROM (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 200 THEN 0 ELSE 1 END AS fresh FROM hits)),
spans AS (SELECT r, run, min(s) AS a, max(s) + 200 AS b FROM runs GROUP BY r, run),
gaps AS (SELECT r, run, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
               string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
        FROM gaps JOIN texts USING (r) GROUP BY r)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)""")
def op11(spark, sf_dir):
    from corpusflow.llm.suffix_dedup import remove_repeats
    cut = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_spelling_variants", r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY doc_id, run),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                                 lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs), crc),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT c, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
shorter AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest),
ranked AS (
  SELECT a, b, m, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY m DESC, b) AS k
  FROM (SELECT a, b, w.n AS m FROM near JOIN words w ON w.word = b)),
forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 2 * n THEN b END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN ranked ON a = word AND k = 1),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT chain.word, f.form FROM chain JOIN forms f ON f.word = chain.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain ON chain.word = f.word JOIN forms l ON l.word = chain.at WHERE l.form IS NULL""")
def op13(spark, sf_dir):
    from corpusflow.llm.spelling import spelling_variants
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query("op12_collocations", r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, piece
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
words AS (SELECT lang, p, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM (SELECT lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)),
grams AS (
  SELECT lang, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
f1 AS (SELECT lang, w1 AS phrase, count(*) AS f FROM grams GROUP BY lang, w1),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS phrase, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
cuts AS (
  SELECT f2.lang, f2.phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = w1 JOIN f1 y ON y.lang = f2.lang AND y.phrase = w2
  UNION ALL
  SELECT f3.lang, f3.phrase, f3.f, 1, x.f, y.f FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.phrase, f3.f, 2, x.f, y.f FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.phrase = f3.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.f IS NULL OR 100 * h.f < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000""")
def op12(spark, sf_dir):
    from corpusflow.llm.collocations import collocations
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"), max_words=3, least_count=10, contained_percent=50, top=2000)
