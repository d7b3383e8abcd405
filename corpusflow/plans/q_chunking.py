"""Registered chunking queries (C1-C9) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import chunking as ch
from corpusflow.plans.registry import register
from corpusflow.sources.tables import read_table


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _sectioned(spark, sf_dir):
    return _docs(spark, sf_dir).withColumn("text", ch.sectioned_text(F.col("text")))


def _chunk_cols(df):
    return df.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"),
                     F.col("total_chunks").cast("long").alias("total_chunks"),
                     F.col("chunk_size").cast("long").alias("chunk_size"), "chunking_method", "content")


def _sql_windows(size: int, step: int, method: str) -> str:
    return f"""SELECT doc_id, (s // {step})::BIGINT AS chunk_index,
       count(*) OVER (PARTITION BY doc_id)::BIGINT AS total_chunks,
       length(substr(text, s + 1, {size}))::BIGINT AS chunk_size, '{method}' AS chunking_method,
       substr(text, s + 1, {size}) AS content
FROM (SELECT doc_id, text, unnest(range(0, length(text), {step})) AS s FROM documents)"""


@register("chunk_fixed", _sql_windows(1000, 800, "fixed"))
def q_chunk_fixed(spark, sf_dir):
    """1000-char windows every 800 chars."""
    return _chunk_cols(ch.chunk_fixed(_docs(spark, sf_dir), 1000, 200))


@register("chunk_simple", _sql_windows(400, 400, "simple"))
def q_chunk_simple(spark, sf_dir):
    """Non-overlapping 400-char slices."""
    return _chunk_cols(ch.chunk_simple(_docs(spark, sf_dir), 400))


STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
SQL_SENTS = ("list_filter(list_transform(string_split_regex(regexp_replace(text, '([.!?])\\s+', "
             "'\\1' || chr(1), 'g'), chr(1)), lambda x: " + STRIP.format(x="x") +
             "), lambda x: length(x) > 0)")

SQL_SENTENCES = f"""WITH s AS (SELECT doc_id, {SQL_SENTS} AS ss FROM documents)
SELECT doc_id, (i - 1)::BIGINT AS sentence_index, ss[i] AS sentence
FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM s)"""


@register("sentences", SQL_SENTENCES)
def q_sentences(spark, sf_dir):
    """Sentences of every document, in order."""
    s = ch.chunk_sentences(_docs(spark, sf_dir))
    return s.select("doc_id", F.col("sentence_index").cast("long").alias("sentence_index"), "sentence")


def _sql_semantic(mn: int, mx: int) -> str:
    ov = f"(acc.size + length(s) > {mx} AND len(acc.cur) > 0)"
    chunks1 = f"(CASE WHEN {ov} THEN list_append(acc.chunks, array_to_string(acc.cur, ' ')) ELSE acc.chunks END)"
    cur1 = f"(CASE WHEN {ov} THEN [s] ELSE list_append(acc.cur, s) END)"
    size1 = f"(CASE WHEN {ov} THEN length(s) ELSE acc.size + length(s) END)"
    fl = f"({size1} >= {mn} AND len({cur1}) >= 3)"
    step = (f"{{'chunks': CASE WHEN {fl} THEN list_append({chunks1}, array_to_string({cur1}, ' ')) ELSE {chunks1} END, "
            f"'cur': CASE WHEN {fl} THEN []::VARCHAR[] ELSE {cur1} END, "
            f"'size': CASE WHEN {fl} THEN 0 ELSE {size1} END}}")
    init = "{'chunks': []::VARCHAR[], 'cur': []::VARCHAR[], 'size': 0}"
    return f"""WITH s AS (SELECT doc_id, {SQL_SENTS} AS ss FROM documents),
f AS (SELECT doc_id, list_reduce(ss, lambda acc, s: {step}, {init}) AS acc FROM s),
c AS (SELECT doc_id, CASE WHEN len(acc.cur) > 0 THEN list_append(acc.chunks, array_to_string(acc.cur, ' '))
                          ELSE acc.chunks END AS cs FROM f)
SELECT doc_id, (i - 1)::BIGINT AS chunk_index, len(cs)::BIGINT AS total_chunks,
       length(cs[i])::BIGINT AS chunk_size, 'semantic' AS chunking_method, cs[i] AS content
FROM (SELECT doc_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM c)"""


@register("chunk_semantic", _sql_semantic(100, 1500))
def q_chunk_semantic(spark, sf_dir):
    """C4: sentence grouping (min 100 chars and 3 sentences, max 1500)."""
    return _chunk_cols(ch.chunk_semantic(_docs(spark, sf_dir), 100, 1500))


# ------------------------------------------------------------ sections
SQL_SECTIONED = """sect AS (
  SELECT doc_id, array_to_string(list_transform(range(1, len(ls) + 1), lambda i:
           CASE WHEN i = 1 THEN '' WHEN (i - 1) % 3 = 0 THEN chr(10) || '# H' || chr(10)
                WHEN (i - 1) % 2 = 0 THEN chr(10) || chr(10) ELSE chr(10) END || ls[i]), '') AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""


def _sql_sections() -> str:
    st = STRIP.format(x="l")
    is_hash = f"starts_with({st}, '#')"
    is_head = f"({is_hash} OR (upper({st}) = {st} AND lower({st}) <> {st} AND length({st}) < 100))"
    flushed = ("(CASE WHEN len(acc.cur) > 0 THEN list_append(acc.secs, {'title': acc.title, "
               "'body': array_to_string(acc.cur, chr(10))}) ELSE acc.secs END)")
    unhashed = "regexp_replace(l, '^#+|#+$', '', 'g')"
    title = f"(CASE WHEN {is_hash} THEN {STRIP.format(x=unhashed)} ELSE {st} END)"
    step = (f"CASE WHEN {is_head} THEN {{'secs': {flushed}, 'title': {title}, 'cur': []::VARCHAR[]}} "
            f"ELSE {{'secs': acc.secs, 'title': acc.title, 'cur': list_append(acc.cur, l)}} END")
    init = ("{'secs': []::STRUCT(title VARCHAR, body VARCHAR)[], 'title': 'Introduction', "
            "'cur': []::VARCHAR[]}")
    return f"""{SQL_SECTIONED},
f AS (SELECT doc_id, text, list_reduce(string_split(text, chr(10)), lambda acc, l: {step}, {init}) AS acc FROM sect),
g AS (SELECT doc_id, CASE WHEN len(acc.cur) > 0 THEN list_append(acc.secs, {{'title': acc.title,
             'body': array_to_string(acc.cur, chr(10))}}) ELSE acc.secs END AS secs0, text FROM f),
secs AS (SELECT doc_id, CASE WHEN len(secs0) > 0 THEN secs0
                 ELSE [{{'title': 'Document', 'body': text}}] END AS secs FROM g),
sec_rows AS (SELECT doc_id, (i - 1) AS section_index, len(secs) AS total_sections,
                    secs[i].title AS section_title, secs[i].body AS section_text
             FROM (SELECT doc_id, secs, unnest(range(1, len(secs) + 1)) AS i FROM secs))"""


SQL_CHUNK_SECTIONS = f"""WITH {_sql_sections()}
SELECT doc_id, section_index::BIGINT AS section_index, total_sections::BIGINT AS total_sections,
       section_title, section_text FROM sec_rows"""


def _sec_cols(df):
    return df.select("doc_id", F.col("section_index").cast("long").alias("section_index"),
                     F.col("total_sections").cast("long").alias("total_sections"), "section_title",
                     *(["section_text"] if "section_text" in df.columns else
                       [F.col("section_chunk_index").cast("long").alias("section_chunk_index"),
                        "content", F.col("chunk_size").cast("long").alias("chunk_size")]))


@register("chunk_sections", SQL_CHUNK_SECTIONS)
def q_chunk_sections(spark, sf_dir):
    """Section detection over documents with injected headers/blank lines."""
    return _sec_cols(ch.sections_table(_sectioned(spark, sf_dir)))


TARGET = 300


def _sql_context(paragraphs: bool) -> str:
    if paragraphs:
        ov = f"(acc.size + length(p) > {TARGET} AND len(acc.cur) > 0)"
        step = (f"{{'chunks': CASE WHEN {ov} THEN list_append(acc.chunks, array_to_string(acc.cur, chr(10) || chr(10))) "
                f"ELSE acc.chunks END, 'cur': CASE WHEN {ov} THEN [p] ELSE list_append(acc.cur, p) END, "
                f"'size': CASE WHEN {ov} THEN length(p) ELSE acc.size + length(p) END}}")
        init = "{'chunks': []::VARCHAR[], 'cur': []::VARCHAR[], 'size': 0}"
        split = f"""(SELECT CASE WHEN len(a.cur) > 0 THEN list_append(a.chunks, array_to_string(a.cur, chr(10) || chr(10)))
                     ELSE a.chunks END
             FROM (SELECT list_reduce(string_split(section_text, chr(10) || chr(10)),
                                      lambda acc, p: {step}, {init}) AS a))"""
    else:
        split = f"list_transform(range(0, length(section_text), {TARGET}), lambda s: substr(section_text, s + 1, {TARGET}))"
    return f"""WITH {_sql_sections()},
parts AS (
  SELECT doc_id, section_index, total_sections, section_title,
         CASE WHEN length(section_text) <= {TARGET} THEN [{{'i': NULL::BIGINT, 'c': section_text}}]
              ELSE list_transform(range(1, len(sp) + 1), lambda j: {{'i': (j - 1)::BIGINT, 'c': sp[j]}}) END AS ps
  FROM (SELECT *, {split} AS sp FROM sec_rows))
SELECT doc_id, section_index::BIGINT AS section_index, total_sections::BIGINT AS total_sections, section_title,
       p.i AS section_chunk_index, p.c AS content, length(p.c)::BIGINT AS chunk_size
FROM (SELECT *, unnest(ps) AS p FROM parts)"""


@register("chunk_paragraphs", _sql_context(True))
def q_chunk_paragraphs(spark, sf_dir):
    """C7 + C8: context-aware chunks, paragraphs packed to 300 chars."""
    return _sec_cols(ch.chunk_context_aware(_sectioned(spark, sf_dir), TARGET, True))


@register("chunk_section_slices", _sql_context(False))
def q_chunk_section_slices(spark, sf_dir):
    """C7 + C9: context-aware chunks, long sections cut in 300-char slices."""
    return _sec_cols(ch.chunk_context_aware(_sectioned(spark, sf_dir), TARGET, False))


def _sql_recursive(p: str, src: str, keys: str, size: int, overlap: int, separators: list[str]) -> str:
    """CTEs ending in ``{p}chunks(keys, i, total, content)``: spans by position,
    one group of CTEs a separator; neighbouring small pieces are a list of
    ends, folded into spans. ``separators`` ends with the empty one."""
    ctes = [f"{p}o0 AS (SELECT {keys}, 0::BIGINT AS s, text AS t FROM {src} WHERE length(text) > {size})",
            f"{p}whole AS (SELECT {keys}, 0::BIGINT AS s, length(text)::BIGINT AS e FROM {src} WHERE length(text) <= {size})"]
    spans = [f"SELECT {keys}, s, e FROM {p}whole"]
    for i, sep in enumerate(separators[:-1]):
        lit = " || ".join("chr(10)" if c == "\n" else f"'{c}'" for c in sep)
        fold = f"""list_reduce(b, lambda acc, x: CASE WHEN x - acc.s > {size}
             THEN {{'out': list_append(acc.out, {{'s': acc.s, 'e': acc.e}}),
                   's': list_min(list_filter(list_prepend(a, b), lambda y: y >= greatest(acc.e - {overlap}, x - {size}))), 'e': x}}
             ELSE {{'out': acc.out, 's': acc.s, 'e': x}} END,
           {{'out': []::STRUCT(s BIGINT, e BIGINT)[], 's': a, 'e': a}})"""
        ctes += [
            f"""{p}c{i} AS (SELECT {keys}, s AS s0, list_filter(list_transform(string_split(t, {lit}), lambda x, j:
             CASE WHEN j = 1 THEN x ELSE {lit} || x END), lambda x: length(x) > 0) AS ps FROM {p}o{i})""",
            f"{p}q{i} AS (SELECT {keys}, s0, unnest(ps) AS t, unnest(range(1, len(ps) + 1)) AS j FROM {p}c{i})",
            f"""{p}r{i} AS (SELECT {keys}, s0, j, t, length(t)::BIGINT AS l, (s0 + sum(length(t)) OVER w - length(t))::BIGINT AS s,
             count(*) FILTER (length(t) >= {size}) OVER w AS run FROM {p}q{i} WINDOW w AS (PARTITION BY {keys}, s0 ORDER BY j))""",
            f"{p}o{i + 1} AS (SELECT {keys}, s, t FROM {p}r{i} WHERE l > {size})",
            f"""{p}g{i} AS (SELECT {keys}, min(s) AS a, list(s + l ORDER BY j) AS b FROM {p}r{i} WHERE l < {size}
             GROUP BY {keys}, s0, run)""",
            f"{p}f{i} AS (SELECT {keys}, {fold} AS f FROM {p}g{i})",
            f"{p}u{i} AS (SELECT {keys}, unnest(list_append(f.out, {{'s': f.s, 'e': f.e}})) AS x FROM {p}f{i})"]
        spans += [f"SELECT {keys}, s, s + l FROM {p}r{i} WHERE l = {size}", f"SELECT {keys}, x.s, x.e FROM {p}u{i}"]
    step, last = size - overlap, f"{p}o{len(separators) - 1}"
    ctes.append(f"""{p}letters AS (SELECT {keys}, s + w AS s, least(s + w + {size}, s + length(t)) AS e FROM (SELECT {keys}, s, t,
             unnest(range(0, ((length(t) - {size} + {step - 1}) // {step} + 1) * {step}, {step})) AS w FROM {last}))""")
    spans.append(f"SELECT {keys}, s, e FROM {p}letters")
    ctes.append(f"{p}spans AS ({' UNION ALL '.join(spans)})")
    cut = STRIP.format(x="substr(text, s + 1, e - s)")
    ctes.append(f"{p}text AS (SELECT {keys}, s, {cut} AS content FROM {p}spans JOIN {src} USING ({keys}))")
    ctes.append(f"""{p}chunks AS (SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY s) - 1 AS i,
             count(*) OVER (PARTITION BY {keys}) AS total, content FROM {p}text WHERE length(content) > 0)""")
    return ",\n".join(ctes)


SQL_RECURSIVE = f"""WITH {_sql_recursive("", "documents", "doc_id", 1000, 200, ch.DEFAULT_SEPARATORS)}
SELECT doc_id, i::BIGINT AS chunk_index, total::BIGINT AS total_chunks, length(content)::BIGINT AS chunk_size,
       'recursive' AS chunking_method, content FROM chunks"""


@register("chunk_recursive", SQL_RECURSIVE)
def q_chunk_recursive(spark, sf_dir):
    """Recursive chunks (1000/200)."""
    return _chunk_cols(ch.chunk_recursive(_docs(spark, sf_dir), 1000, 200))


SQL_PARENT_CHILD = f"""WITH {_sql_recursive("p", "documents", "doc_id", 2000, 100, ch.PARENT_CHILD_SEPARATORS)},
parents AS (SELECT doc_id, i AS parent_index, total AS total_parents, content AS text FROM pchunks),
{_sql_recursive("c", "parents", "doc_id, parent_index", 400, 50, ch.PARENT_CHILD_SEPARATORS)}
SELECT doc_id, parent_index::BIGINT AS parent_index, i::BIGINT AS child_index, total_parents::BIGINT AS total_parents,
       total::BIGINT AS total_children, length(content)::BIGINT AS chunk_size, length(text)::BIGINT AS parent_size,
       'parent_child' AS chunking_method, content
FROM cchunks JOIN parents USING (doc_id, parent_index)"""


@register("chunk_parent_child", SQL_PARENT_CHILD)
def q_chunk_parent_child(spark, sf_dir):
    """Child chunks (400/50) of parent chunks (2000/100)."""
    r = ch.chunk_parent_child(_docs(spark, sf_dir))
    return r.select("doc_id", F.col("parent_index").cast("long").alias("parent_index"),
                    F.col("child_index").cast("long").alias("child_index"),
                    F.col("total_parents").cast("long").alias("total_parents"),
                    F.col("total_children").cast("long").alias("total_children"),
                    F.col("chunk_size").cast("long").alias("chunk_size"),
                    F.col("parent_size").cast("long").alias("parent_size"), "chunking_method", "content")
