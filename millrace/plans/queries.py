"""Registered queries of the document engine, each with the SQL that yields the same rows."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.text import WS
from millrace.operators import catalog as cat
from millrace.operators import chunk as ch
from millrace.operators import clean as cl
from millrace.operators import layout as ly
from millrace.operators import retrieve as rt
from millrace.operators import summarize as sm
from millrace.operators import tags as tg
from millrace.operators import verdict as vd
from millrace.schema import as_sections
from millrace.sources import blocks, formats, structured, web

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# SQL forms of the text functions


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WS}+|{WS}+\z', '', 'g')"


def s_normalize(x: str) -> str:
    unix = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    few = rf"regexp_replace({unix}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    return s_strip(rf"array_to_string(list_transform(string_split({few}, chr(10)), lambda l: regexp_replace(l, '{WS}+\z', '')), chr(10))")


def s_words(x: str) -> str:
    return rf"len(list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> ''))"


def s_tokens(x: str) -> str:
    return f"greatest(1, CAST(floor(length({x}) / 4.0) AS INTEGER))"


def s_numbered_lines(t: str = "documents") -> str:
    return f"SELECT CAST(doc_id AS VARCHAR) AS source_id, source, lang, p - 1 AS block_id, ls[p] AS content FROM (SELECT *, string_split(text, chr(10)) AS ls FROM {t}), unnest(range(1, len(ls) + 1)) AS u(p)"


# inputs shared by several queries


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a document as a paragraph."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), F.posexplode(F.split("text", "\n")).alias("block_id", "content"))
    return as_sections(d.withColumn("type", F.lit("paragraph")))


def document_blocks(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """Each document as one paragraph of its source or language."""
    d = table(spark, sf_dir, "documents")
    return as_sections(d.select(F.col(by).alias("source_id"), F.col("doc_id").cast("int").alias("block_id"), F.lit("paragraph").alias("type"), F.col("text").alias("content")))


def turn_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return as_sections(c.select(F.col("conv_id").cast("string").alias("source_id"), F.col("turn").cast("int").alias("block_id"), F.lit("paragraph").alias("type"), F.array("role").alias("heading_path"), F.col("text").alias("content")))


DIRTY = [
    ("d1", 0, "paragraph", "Page 3 of 40\nReal text here.\n- 12 -\n3/40"),
    ("d1", 1, "paragraph", "CONFIDENTIAL\nKept line\nwww.example.com\nDownloaded from somewhere"),
    ("d1", 2, "paragraph", "----\n***\nsolid words\n\n.\n"),
    ("d1", 3, "heading", "***"),
    ("d1", 4, "table", "| 12 |\n|---|\n| 3/40 |"),
    ("d1", 5, "paragraph", "12345\n  7  \nwww.a-b.org/path"),
    ("d1", 6, "code_block", "***\n12"),
    ("d1", 7, "paragraph", "第 3 页 / 共 40 页\n机密\n保留"),
    ("d1", 8, "paragraph", "draft\nPAGE 9"),
    ("d1", 9, "heading", "Page 4"),
    ("d2", 0, "paragraph", "the retrie-\nval of infor-\n  mation"),
    ("d2", 1, "paragraph", "state-of-the-\nArt stays, co-\noperate joins"),
    ("d2", 2, "code_block", "a-\nb stays"),
    ("d2", 3, "table", "| long-\nword |"),
]


def dirty(spark: SparkSession) -> DataFrame:
    return as_sections(spark.createDataFrame(DIRTY, "source_id string, block_id int, type string, content string"))


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else "'" + str(v).replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def s_values(rows: list[tuple], names: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)}) AS v({names})"


S_DIRTY = f"SELECT * FROM {s_values(DIRTY, 'source_id, block_id, type, content')}"
S_DIRTY_LINES = f"{S_DIRTY} UNION ALL SELECT source_id, block_id, 'paragraph', content FROM ({s_numbered_lines()})"


def report(df: DataFrame, *more: str) -> DataFrame:
    """What a query shows of sections: keys, sizes and digests instead of texts."""
    return df.select("source_id", F.col("block_id").cast("int").alias("block_id"), *more, F.length("content").alias("n_chars"), F.md5(F.encode("content", "UTF-8")).alias("digest"))


S_REPORT = "source_id, CAST(block_id AS INTEGER) AS block_id, length(content) AS n_chars, md5(content) AS digest"

# plain text and scalar functions


@query(rf"""
WITH part AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, p, ps[p] AS x FROM (SELECT doc_id, string_split_regex(text, '\n{WS}*\n') AS ps FROM documents), unnest(range(1, len(ps) + 1)) AS u(p)),
ok AS (SELECT source_id, p, {s_normalize('x')} AS content FROM part)
SELECT source_id, CAST(row_number() OVER (PARTITION BY source_id ORDER BY p) - 1 AS INTEGER) AS block_id, length(content) AS n_chars, md5(content) AS digest FROM ok WHERE content <> ''""")
def plain_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), F.col("text").alias("raw"))
    return report(blocks.plain_blocks(d, unicode=False))


@query(f"SELECT source, CAST(sum({s_words('text')}) AS BIGINT) AS words FROM documents GROUP BY source")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(tx.word_count(F.col("text"))).cast("long").alias("words"))


@query("SELECT count(*) AS rows, count(*) FILTER (length(text) <> n_chars) AS wrong, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents")
def char_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.agg(F.count("*").alias("rows"), F.count_if(F.length("text") != F.col("n_chars")).alias("wrong"), F.sum(F.length("text")).cast("long").alias("chars"))


@query(r"""
WITH name AS (SELECT page_id, url, coalesce(nullif(regexp_extract(regexp_replace(url, '/+\z', ''), '([^/]*)\z', 1), ''), 'webpage') AS n FROM pages)
SELECT page_id, regexp_replace(n, '[^\p{L}\p{N}_\-.]', '_', 'g') || '_' || substr(sha1(url), 1, 8) AS source_id FROM name""")
def stable_source_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", tx.source_id(F.col("url")).alias("source_id"))


NAMES = ["a/b/guide.md", "report.DOCX", "x/.env", "archive.xyz", "Dockerfile", "data.tar.csv", "https://example.com/a/b.pdf", "https://example.com/", "scan.jpeg", "notes v2.txt"]


@query(f"""
SELECT source, kind AS format_type, family FROM (VALUES ('a/b/guide.md', 'md', 'markdown'), ('report.DOCX', 'docx', 'word'), ('x/.env', '', NULL), ('archive.xyz', 'xyz', NULL), ('Dockerfile', '', NULL),
('data.tar.csv', 'csv', 'delimited'), ('https://example.com/a/b.pdf', 'html', 'web'), ('https://example.com/', 'html', 'web'), ('scan.jpeg', 'jpeg', 'image'), ('notes v2.txt', 'txt', 'plain')) AS v(source, kind, family)""")
def format_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.identify(spark.createDataFrame([(n,) for n in NAMES], "source string")).select("source", "format_type", "family")


@query(f"SELECT ext FROM (VALUES {', '.join(f"('{e}')" for e in formats.supported_extensions())}) AS v(ext)")
def supported_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.formats(spark).select(F.col("format_type").alias("ext")).distinct()


# cleaning


@query(rf"""
WITH b AS ({S_DIRTY_LINES}),
c AS (SELECT source_id, block_id, CASE WHEN type IN ('table', 'code_block') THEN content ELSE {s_strip(f"array_to_string(list_filter(string_split(content, chr(10)), lambda x: {s_strip('x')} <> '' AND NOT regexp_matches({s_strip('x')}, '{cl.NOISE}')), chr(10))")} END AS content, type FROM b)
SELECT {S_REPORT} FROM c WHERE type IN ('table', 'code_block') OR content <> ''""")
def line_noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.line_noise(dirty(spark).unionByName(line_blocks(spark, sf_dir)), cl.Options()))


def _s_drop(patterns: list[str]) -> str:
    tests = " AND ".join(f"NOT regexp_matches(x, '{p}')" for p in patterns)
    kept = s_strip(f"array_to_string(list_filter(string_split(content, chr(10)), lambda x: {tests}), chr(10))")
    fixed = "type IN ('table', 'code_block', 'heading')"
    return f"WITH b AS ({S_DIRTY_LINES}), c AS (SELECT source_id, block_id, CASE WHEN {fixed} THEN content ELSE {kept} END AS content, type FROM b) SELECT {S_REPORT} FROM c WHERE {fixed} OR content <> ''"


@query(_s_drop(cl.PAGE_NUMBERS))
def page_artifact_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.page_artifacts(dirty(spark).unionByName(line_blocks(spark, sf_dir)), cl.Options()))


@query(_s_drop(cl.WATERMARKS))
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.watermarks(dirty(spark).unionByName(line_blocks(spark, sf_dir)), cl.Options()))


@query(rf"""
WITH b AS (SELECT source_id, block_id, type, content FROM ({S_DIRTY}) UNION ALL SELECT source, doc_id, 'paragraph', text FROM documents),
u AS (SELECT source_id, block_id, type, replace(replace(content, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS c FROM b),
f AS (SELECT source_id, block_id, type, regexp_replace(c, '[ \t\x{{a0}}\x{{3000}}]{{2,}}', ' ', 'g') AS c FROM u),
n AS (SELECT source_id, block_id, type, {s_normalize('c')} AS content FROM f)
SELECT {S_REPORT} FROM n WHERE content <> '' OR type = 'heading'""")
def normalize_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.normalize(dirty(spark).unionByName(document_blocks(spark, sf_dir, "source")), cl.Options(unicode=False)))


S_BOILER = rf"""
l AS (SELECT DISTINCT source, doc_id, {s_strip('x')} AS key FROM documents, unnest(string_split(text, chr(10))) AS u(x)),
n AS (SELECT source, count(*) AS n FROM documents GROUP BY source HAVING count(*) >= 3),
k AS (SELECT source, key FROM (SELECT source, key, count(DISTINCT doc_id) AS c FROM l WHERE key <> '' AND length(key) <= 200 GROUP BY ALL) JOIN n USING (source) WHERE c >= greatest(3, floor(n * CAST(0.05 AS DOUBLE))))"""


@query(f"WITH {S_BOILER} SELECT source AS source_id, key FROM k")
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.boilerplate_lines(document_blocks(spark, sf_dir, "source"), cl.Options(boilerplate_ratio=0.05))


@query(rf"""
WITH {S_BOILER},
c AS (SELECT d.source AS source_id, d.doc_id AS block_id, CASE WHEN d.source IN (SELECT source FROM k) THEN {s_strip('a.kept')} ELSE d.text END AS content
  FROM documents d LEFT JOIN (SELECT doc_id, string_agg(x, chr(10) ORDER BY p) AS kept FROM (
    SELECT doc_id, source, ls[p] AS x, p FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(p)) q
    WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.source = q.source AND k.key = {s_strip('q.x')}) GROUP BY doc_id) a USING (doc_id))
SELECT {S_REPORT} FROM c WHERE coalesce(content, '') <> ''""")
def boilerplate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.boilerplate(document_blocks(spark, sf_dir, "source"), cl.Options(boilerplate_ratio=0.05)))


@query(rf"""SELECT source_id, CAST(block_id AS INTEGER) AS block_id, CASE WHEN type = 'code_block' THEN content ELSE regexp_replace(content, '{cl.HYPHENATED}', '\1\3', 'g') END AS content FROM ({S_DIRTY_LINES})""")
def dehyphenate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.dehyphenate(dirty(spark).unionByName(line_blocks(spark, sf_dir)), cl.Options()).select("source_id", "block_id", "content")


@query(rf"""
WITH RECURSIVE c AS (SELECT CAST(conv_id AS VARCHAR) AS source_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
f AS (
  SELECT source_id, i, turn AS block_id, role, text AS buf, CAST(NULL AS BIGINT) AS out_id, CAST(NULL AS VARCHAR) AS out_text FROM c WHERE i = 1
  UNION ALL
  SELECT c.source_id, c.i, CASE WHEN m THEN f.block_id ELSE c.turn END, c.role,
         CASE WHEN m THEN {s_strip(r"regexp_replace(f.buf, '-+\z', '') || CASE WHEN ends_with(f.buf, '-') THEN '' ELSE ' ' END || c.text")} ELSE c.text END,
         CASE WHEN m THEN NULL ELSE f.block_id END, CASE WHEN m THEN NULL ELSE f.buf END
  FROM f JOIN c ON c.source_id = f.source_id AND c.i = f.i + 1,
       LATERAL (SELECT f.role = c.role AND (length(f.buf) < 80 OR NOT regexp_matches(regexp_replace(f.buf, '{WS}+\z', ''), '{cl.SENTENCE_END}')) AS m)),
o AS (SELECT source_id, out_id AS block_id, out_text AS content FROM f WHERE out_id IS NOT NULL
  UNION ALL SELECT source_id, block_id, buf FROM f WHERE i = (SELECT max(i) FROM c WHERE c.source_id = f.source_id))
SELECT {S_REPORT} FROM o WHERE content <> ''""")
def merge_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.merge_fragments(turn_blocks(spark, sf_dir), cl.Options()))


@query(f"SELECT lang AS source_id, CAST(doc_id AS INTEGER) AS block_id, length(text) AS n_chars, md5(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedupe_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.dedupe(document_blocks(spark, sf_dir, "lang"), cl.Options()))


@query(f"SELECT CAST(conv_id AS VARCHAR) AS source_id, CAST(turn AS INTEGER) AS block_id, length(text) AS n_chars, md5(text) AS digest FROM conversations WHERE length({s_strip('text')}) >= 60")
def min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.min_length(turn_blocks(spark, sf_dir), cl.Options(min_chars=60)))


@query(f"""
WITH a AS (SELECT lang, text, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS r FROM documents),
n AS (SELECT lang, count(*) AS n0, count(*) FILTER (r = 1) AS n1, count(*) FILTER (r = 1 AND length({s_strip('text')}) >= 100) AS n2 FROM a GROUP BY lang)
SELECT lang AS source_id, array_to_string(list_filter([CASE WHEN n0 <> n1 THEN 'dedupe' END, CASE WHEN n1 <> n2 THEN 'min_length' END], lambda x: x IS NOT NULL), ',') AS applied, n0 AS blocks_before, n2 AS blocks_after, n0 - n2 AS blocks_removed FROM n""")
def cleaning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cl.cleaning_stats(document_blocks(spark, sf_dir, "lang"), cl.Options(min_chars=100), "min_length, dedupe")
    return got.select("source_id", F.array_join("cleaners_applied", ",").alias("applied"), "blocks_before", "blocks_after", "blocks_removed")


@query(f"""
WITH a AS (SELECT lang, doc_id, text, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS r FROM documents)
SELECT lang AS source_id, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS INTEGER) AS block_id, length(text) AS n_chars, md5(text) AS digest FROM a WHERE r = 1 AND length({s_strip('text')}) >= 100""")
def clean_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(cl.clean(document_blocks(spark, sf_dir, "lang"), cl.Options(min_chars=100), "dedupe,min_length"))


# verdicts


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with page counts, warnings and cleaning counts derived from their numbers."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    docs = d.select(
        i.cast("string").alias("source_id"),
        "source",
        F.lit("txt").alias("format_type"),
        F.when(i % 3 == 0, i % 90).cast("int").alias("page_count"),
        (i % 11 == 0).alias("is_scanned"),
        F.when(i % 13 == 0, F.array(F.lit("odd encoding"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
        F.lit(8).cast("long").alias("blocks_before"),
        (i % 9).alias("blocks_removed"),
    )
    sections = as_sections(d.where(i % 17 != 0).select(i.cast("string").alias("source_id"), F.lit(0).alias("block_id"), F.lit("paragraph").alias("type"), F.col("text").alias("content")))
    return vd.verdicts(docs, sections)


S_JUDGED = """
x AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, doc_id, source, text, doc_id % 17 <> 0 AS has, length(text) AS chars, CASE WHEN doc_id % 3 = 0 THEN doc_id % 90 END AS pages, doc_id % 9 AS removed FROM documents),
y AS (SELECT *, CASE WHEN pages > 1 THEN chars / CAST(pages AS DOUBLE) END AS per_page,
  list_filter([CASE WHEN doc_id % 13 = 0 THEN 'odd encoding' END, CASE WHEN doc_id % 11 = 0 THEN 'text was recovered by OCR — verify accuracy on a sample' END,
    CASE WHEN removed / 8.0 > 0.5 THEN 'cleaning removed ' || CAST(round_even(removed / 8.0 * 100, 0) AS BIGINT) || '% of blocks — check the source is not mostly boilerplate the pipeline misread as content' END], lambda r: r IS NOT NULL) AS soft FROM x),
j AS (SELECT *, CASE WHEN NOT has OR per_page < 25 THEN 'unusable' WHEN len(soft) > 0 THEN 'degraded' ELSE 'ok' END AS verdict,
  CASE WHEN NOT has THEN ['no sections extracted'] WHEN per_page < 25 THEN ['only ' || CAST(round_even(per_page, 0) AS BIGINT) || ' chars/page across ' || pages || ' pages — likely a scanned document; install an OCR engine (pip install paddleocr) and re-run with --strategy ocr'] ELSE soft END AS reasons FROM y)"""


@query(f"WITH {S_JUDGED} SELECT source, verdict, count(*) AS n FROM j GROUP BY ALL")
def verdict_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).groupBy("source", "verdict").agg(F.count("*").alias("n"))


@query(f"WITH {S_JUDGED} SELECT source_id, verdict, array_to_string(reasons, '; ') AS reasons FROM j")
def verdict_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("source_id", "verdict", F.array_join("verdict_reasons", "; ").alias("reasons"))


@query(f"WITH {S_JUDGED} SELECT verdict = 'unusable' AS blocked, count(*) AS n FROM j GROUP BY ALL")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = vd.gate(judged(spark, sf_dir))
    return good.agg(F.count("*").alias("n")).select(F.lit(False).alias("blocked"), "n").unionByName(bad.agg(F.count("*").alias("n")).select(F.lit(True).alias("blocked"), "n"))


BROKEN = [("v1", 0, "paragraph", "fine"), ("v1", 2, "paragraph", "gap"), ("v1", 3, "verse", "odd type"), ("v2", 0, "paragraph", "  "), ("v2", 1, "heading", ""), ("v3", 0, "paragraph", "ok")]


@query(r"""SELECT * FROM (VALUES ('v1', 'section[1].block_id is 2, expected 1'), ('v1', 'section[2].block_id is 3, expected 2'), ('v1', 'section[2] has unknown type ''verse'''), ('v2', 'section[0] (paragraph) has empty content'),
('v2', 'format_type was not set by the parser'), ('v3', 'unknown verdict ''fine''')) AS v(source_id, problem)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'section[0] (paragraph) has empty content' FROM documents WHERE text = ''""")
def validate_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.createDataFrame([("v1", "md", "ok"), ("v2", "unknown", "ok"), ("v3", "md", "fine")], "source_id string, format_type string, verdict string")
    own = as_sections(spark.createDataFrame(BROKEN, "source_id string, block_id int, type string, content string"))
    d = table(spark, sf_dir, "documents")
    rest = as_sections(d.select(F.col("doc_id").cast("string").alias("source_id"), F.lit(0).alias("block_id"), F.lit("paragraph").alias("type"), F.col("text").alias("content")))
    return vd.violations(docs, own.unionByName(rest))


# web pages


@query(rf"""
SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title[^>]*>.*?</title>') THEN substr({s_strip(rf"regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '{WS}+', ' ', 'g')")}, 1, 300)
  WHEN regexp_matches(html, '(?is)<h1[^>]*>.*?</h1>') THEN substr({s_strip("regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')")}, 1, 300) END AS title
FROM (SELECT page_id, html FROM pages UNION ALL SELECT * FROM (VALUES (-1, '<h1>Only <b>head</b></h1>'), (-2, 'none'), (-3, '<TITLE> a
b  c </TITLE>')) AS v(page_id, html))""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, "<h1>Only <b>head</b></h1>"), (-2, "none"), (-3, "<TITLE> a\nb  c </TITLE>")], "page_id long, html string")
    return table(spark, sf_dir, "pages").select("page_id", "html").unionByName(extra).select("page_id", web.page_title(F.col("html")).alias("title"))


def _s_strip_tags(x: str) -> str:
    # one pattern cannot refer back here, so elements go in the order of their starts by alternation
    any_ = "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in web.DROPPED)
    x = f"regexp_replace({x}, '(?is){any_}', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)<br{WS}*/?>', chr(10), 'g')"
    x = f"regexp_replace({x}, '(?i)</({web.CLOSERS})>', chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for e, c in web.ENTITIES:
        x = f"replace({x}, '{e}', '{c.replace(chr(39), chr(39) * 2)}')"
    return x


S_STRIPPED = f"t AS (SELECT CAST(page_id AS VARCHAR) AS source_id, {_s_strip_tags('html')} AS x FROM pages), s AS (SELECT source_id, {s_normalize('x')} AS raw FROM t)"


@query(f"WITH {S_STRIPPED} SELECT source_id, length(raw) AS n_chars, md5(raw) AS digest FROM s")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("source_id"), "html")
    return web.extract_pages(p, unicode=False).select("source_id", F.length("raw").alias("n_chars"), F.md5(F.encode("raw", "UTF-8")).alias("digest"))


S_PAGE_BLOCKS = rf"""{S_STRIPPED},
p AS (SELECT source_id, i, {s_strip('ps[i]')} AS content FROM (SELECT source_id, string_split_regex(raw, '\n{WS}*\n') AS ps FROM s), unnest(range(1, len(ps) + 1)) AS u(i)),
b AS (SELECT source_id, CAST(row_number() OVER (PARTITION BY source_id ORDER BY i) - 1 AS INTEGER) AS block_id, 'paragraph' AS type, content FROM p WHERE content <> '')"""


@query(f"WITH {S_PAGE_BLOCKS} SELECT source_id, block_id, type, length(content) AS n_chars, md5(content) AS digest FROM b")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(page_sections(spark, sf_dir), "type")


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("source_id"), "html")
    return web.page_blocks(p, unicode=False)


@query(f"WITH {S_PAGE_BLOCKS} SELECT type, count(*) AS n, CAST(sum(length(content)) AS BIGINT) AS chars FROM b GROUP BY type")
def block_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_sections(spark, sf_dir).groupBy("type").agg(F.count("*").alias("n"), F.sum(F.length("content")).cast("long").alias("chars"))


# Markdown made from the nations of each region


def region_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    key, name = F.col("n_nationkey").cast("string"), F.col("n_name")
    part = F.concat(F.lit("## "), name, F.lit("\n| key | name |\n|---|---|\n\n| "), key, F.lit(" | "), name, F.lit(" |\n```py\n# not a heading\nprint("), key, F.lit(")\n```\n#### Deep "), name, F.lit("\nend of "), name, F.lit("  \nsecond line\n\nlast\n"))
    parts = n.select("n_regionkey", "n_nationkey", part.alias("part")).groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "part"))), lambda x: x["part"]), "").alias("body"))
    r = table(spark, sf_dir, "region").join(parts, F.col("r_regionkey") == F.col("n_regionkey"))
    return r.select(F.col("r_regionkey").cast("string").alias("source_id"), F.concat(F.lit("intro\n# "), "r_name", F.lit("\ntext of it\n"), "body").alias("raw"))


S_MARKDOWN = """
n AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k, CAST(n_regionkey AS VARCHAR) AS source_id FROM nation JOIN region ON n_regionkey = r_regionkey),
m AS (
  SELECT DISTINCT source_id, 0 AS k, 0 AS i, 'paragraph' AS type, '' AS path, 'intro' AS content, CAST(NULL AS INTEGER) AS level FROM n
  UNION ALL SELECT DISTINCT source_id, 0, 1, 'heading', '', r_name, 1 FROM n
  UNION ALL SELECT DISTINCT source_id, 0, 2, 'paragraph', r_name, 'text of it', NULL FROM n
  UNION ALL SELECT source_id, k, 0, 'heading', r_name, n_name, 2 FROM n
  UNION ALL SELECT source_id, k, 1, 'table', r_name || '/' || n_name, '| key | name |' || chr(10) || '|---|---|' || chr(10) || '| ' || n_nationkey || ' | ' || n_name || ' |', NULL FROM n
  UNION ALL SELECT source_id, k, 2, 'code_block', r_name || '/' || n_name, '# not a heading' || chr(10) || 'print(' || n_nationkey || ')', NULL FROM n
  UNION ALL SELECT source_id, k, 3, 'heading', r_name || '/' || n_name, 'Deep ' || n_name, 4 FROM n
  UNION ALL SELECT source_id, k, 4, 'paragraph', r_name || '/' || n_name || '/Deep ' || n_name, 'end of ' || n_name || chr(10) || 'second line', NULL FROM n
  UNION ALL SELECT source_id, k, 5, 'paragraph', r_name || '/' || n_name || '/Deep ' || n_name, 'last', NULL FROM n),
s AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_id ORDER BY k, i) - 1 AS INTEGER) AS block_id FROM m)"""


@query(f"WITH {S_MARKDOWN} SELECT source_id, block_id, type, path, level FROM s")
def heading_breadcrumb(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = blocks.markdown_blocks(region_markdown(spark, sf_dir), unicode=False)
    return s.select("source_id", "block_id", "type", F.array_join("heading_path", "/").alias("path"), "level")


@query(f"WITH {S_MARKDOWN} SELECT source_id, block_id, content, '3' AS rows FROM s WHERE type = 'table'")
def md_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = blocks.markdown_blocks(region_markdown(spark, sf_dir), unicode=False)
    return s.where("type = 'table'").select("source_id", "block_id", "content", F.col("metadata")["rows"].alias("rows"))


@query(f"WITH {S_MARKDOWN} SELECT source_id, block_id, content, 'py' AS language FROM s WHERE type = 'code_block'")
def md_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = blocks.markdown_blocks(region_markdown(spark, sf_dir), unicode=False)
    return s.where("type = 'code_block'").select("source_id", "block_id", "content", F.col("metadata")["language"].alias("language"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS source_id, b AS block_id, CASE b WHEN 0 THEN 'heading' ELSE 'code_block' END AS type, CASE b WHEN 0 THEN n_name || '.py' ELSE 'print(1)' END AS content FROM nation, unnest([0, 1]) AS u(b)")
def code_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("source_id"), F.lit("print(1)  \n\n").alias("raw"), F.concat("n_name", F.lit(".py")).alias("filename"), F.lit("py").alias("format_type"))
    return blocks.code_blocks(n, unicode=False).select("source_id", "block_id", "type", "content")


# delimited and nested data


@query(r"""
SELECT 'region' AS source_id, '| key | name|x |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || '\|' || ' |', chr(10) ORDER BY r_regionkey) AS content, '2' AS columns, CAST(count(*) AS VARCHAR) AS rows FROM region""")
def csv_markdown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    line = F.concat(F.col("r_regionkey").cast("string"), F.lit(',"'), "r_name", F.lit('|",extra'))
    raw = r.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", line.alias("l")))), lambda x: x["l"]), "\n").alias("body")).select(F.lit("region").alias("source_id"), F.concat(F.lit("key, name|x\n , \n"), "body").alias("raw"))
    return structured.delimited_blocks(raw).select("source_id", "content", F.col("metadata")["columns"].alias("columns"), F.col("metadata")["rows"].alias("rows"))


WIDE = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "c_name", "c_nationkey", "c_mktsegment", "n_name", "n_regionkey", "o_custkey", "c_name", "n_name", ""]


@query(f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS i FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT o_orderstatus AS source_id, CAST(i AS INTEGER) AS block_id, '**Record ' || i || '**' || chr(10) || {" || chr(10) || ".join(f"'- {c}: ' || CAST({c} AS VARCHAR)" for c in WIDE[:-1])} || chr(10) || '- col12: z' AS content FROM o""")
def wide_table_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    row = F.array(*(F.col(c).cast("string") for c in WIDE[:-1]), F.lit(" z "))
    t = structured.numbered(o.select(F.col("o_orderstatus").alias("source_id"), "o_orderkey", row.alias("row")), "o_orderkey", "i")
    t = t.select("source_id", F.array(*map(F.lit, WIDE)).alias("head"), "i", "row")
    return structured.record_blocks(t).select("source_id", "block_id", "content")


@query("SELECT event_id, 'k: ' || (props::JSON->>'k') AS content, 'dict' AS root FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", structured.flatten_json(F.col("props")).alias("x"))
    return e.select("event_id", F.col("x.flat").alias("content"), F.col("x.root").alias("root"))


@query("""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)
SELECT CAST(user_id AS VARCHAR) AS source_id, CAST(i AS INTEGER) AS block_id, 'record[' || i || '].k: ' || (props::JSON->>'k') AS content FROM e""")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("source_id")).agg(F.concat(F.lit("not json\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "props"))), lambda x: x["props"]), "\n")).alias("raw"))
    return structured.json_line_blocks(e)[0].select("source_id", "block_id", "content")


@query("SELECT CAST(user_id AS VARCHAR) AS source_id, 1 AS warnings FROM events GROUP BY user_id")
def json_line_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("source_id")).agg(F.concat(F.lit("not json\n\n"), F.array_join(F.collect_list("props"), "\n")).alias("raw"))
    return structured.json_line_blocks(e)[1].groupBy("source_id").agg(F.count("*").cast("int").alias("warnings"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS source_id, 'name: ' || n_name || chr(10) || 'at.region: ' || n_regionkey || chr(10) || 'at.list[0]: 1' || chr(10) || 'at.list[1].x: True' || chr(10) || 'none: []' AS content FROM nation")
def yaml_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("name: '"), "n_name", F.lit("'\nat:\n  region: "), F.col("n_regionkey").cast("string"), F.lit("\n  list: [1, {x: true}]\nnone: []\n"))
    return structured.yaml_blocks(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("source_id"), raw.alias("raw")))[0].select("source_id", "content")


# chunks


S_CHUNKS = rf"""
{S_MARKDOWN},
h AS (SELECT *, sum(CASE WHEN type = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY block_id) AS part FROM s),
g AS (SELECT source_id, part, max(content) FILTER (type = 'heading') AS heading, {s_strip("string_agg(content, chr(10) ORDER BY block_id) FILTER (type <> 'heading')")} AS raw FROM h GROUP BY source_id, part),
k AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY part) - 1 AS i FROM g WHERE coalesce(raw, '') <> ''),
c AS (SELECT source_id || '::' || i || '::' || substr(sha1(substr(raw, 1, 80)), 1, 8) AS chunk_id, source_id, CAST(i AS INTEGER) AS chunk_index, coalesce(heading || chr(10) || chr(10), '') || raw AS text, raw AS raw_text, coalesce(heading, '') AS path, {s_tokens('raw')} AS token_count FROM k)"""


def region_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.chunks(blocks.markdown_blocks(region_markdown(spark, sf_dir), unicode=False))


@query(f"WITH {S_CHUNKS} SELECT * EXCLUDE (raw_text) FROM c")
def chunk_by_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_chunks(spark, sf_dir).select("chunk_id", "source_id", "chunk_index", "text", F.array_join("heading_path", "/").alias("path"), "token_count")


S_DOC_CHUNKS = rf"""
l AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, {s_strip('text')} AS raw, text FROM documents),
c AS (SELECT source_id || '::0::' || substr(sha1(substr(raw, 1, 80)), 1, 8) AS chunk_id, source_id, 0 AS chunk_index, raw AS text, raw AS raw_text, {s_tokens('raw')} AS token_count FROM l WHERE raw <> '')"""


def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.chunks(line_blocks(spark, sf_dir))


@query(f"WITH {S_DOC_CHUNKS} SELECT chunk_id, token_count FROM c")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_chunks(spark, sf_dir).select("chunk_id", "token_count")


@query(f"WITH {S_CHUNKS} SELECT source_id, count(*) AS chunk_count, CAST(sum(token_count) AS BIGINT) AS tokens, max(token_count) AS longest FROM c GROUP BY source_id")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_chunks(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("chunk_count"), F.sum("token_count").cast("long").alias("tokens"), F.max("token_count").alias("longest"))


@query(f"WITH {S_CHUNKS} SELECT chunk_id, array_to_string(list_filter([lag(raw_text) OVER w, raw_text, lead(raw_text) OVER w], lambda x: x IS NOT NULL), chr(10)) AS around FROM c WINDOW w AS (PARTITION BY source_id ORDER BY chunk_index)")
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.window_text(region_chunks(spark, sf_dir)).select("chunk_id", F.col("window").alias("around"))


@query(f"""
WITH {S_CHUNKS},
p AS (SELECT *, CAST(floor((sum(token_count) OVER (PARTITION BY source_id ORDER BY chunk_index) - token_count) / 40.0) AS INTEGER) AS p FROM c),
q AS (SELECT chunk_id, source_id || '::parent::' || p AS parent_id, CASE WHEN lag(chunk_index) OVER w IS NOT NULL THEN '-1' END AS a, CASE WHEN lead(chunk_index) OVER w IS NOT NULL THEN '1' END AS b FROM p WINDOW w AS (PARTITION BY source_id, p ORDER BY chunk_index))
SELECT chunk_id, parent_id, concat_ws(',', a, b) AS siblings FROM q""")
def chunk_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ch.parents(region_chunks(spark, sf_dir), ch.Policy(parent=40))
    return got.select("chunk_id", "parent_id", F.array_join(F.transform("sibling_offsets", lambda x: x.cast("string")), ",").alias("siblings"))


@query(f"WITH t AS (SELECT source_id, CAST(sum({s_tokens('content')}) AS BIGINT) AS tokens FROM ({s_numbered_lines()}) GROUP BY source_id) SELECT source_id, tokens <= 500 AS is_full_document FROM t JOIN (SELECT CAST(doc_id AS VARCHAR) AS source_id, {s_strip('text')} AS raw FROM documents) USING (source_id) WHERE raw <> ''")
def short_documents_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.keep_short_whole(line_blocks(spark, sf_dir)).select("source_id", "is_full_document")


@query(f"SELECT source_id, CAST(sum({s_tokens('content')}) AS BIGINT) AS total_tokens, min({s_tokens('content')}) AS shortest, max({s_tokens('content')}) AS longest, CAST(NULL AS INTEGER) AS max_heading_depth, false AS has_tables, false AS has_code, false AS has_lists FROM ({s_numbered_lines()}) GROUP BY source_id")
def document_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.document_sizes(line_blocks(spark, sf_dir))


@query(f"WITH {S_DOC_CHUNKS} SELECT source_id, chunk_id, token_count FROM c WHERE token_count > 1024")
def oversized_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.oversized(doc_chunks(spark, sf_dir))


@query(f"WITH {S_DOC_CHUNKS} SELECT chunk_id, source_id, 'within_model_token_limit' AS rule FROM c WHERE token_count > 1024 UNION ALL SELECT chunk_id, source_id, 'source_id_matches_parsed' FROM c WHERE CAST(source_id AS BIGINT) % 5 = 0")
def chunk_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "documents").where("doc_id % 5 != 0").select(F.col("doc_id").cast("string").alias("source_id"))
    return ch.chunk_problems(doc_chunks(spark, sf_dir), known)


@query(f"WITH {S_DOC_CHUNKS} SELECT chunk_id, first_value(chunk_id) OVER (PARTITION BY raw_text ORDER BY source_id, chunk_index) AS kept FROM c")
def duplicate_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.duplicate_chunks(doc_chunks(spark, sf_dir))


def s_split(x: str, after: str, most: int | None = None) -> str:
    """A list of texts, those over `most` characters split after each match; U+E000 marks the places."""
    parts = f"string_split(regexp_replace(s, '({after})', '\\1' || chr(57344), 'g'), chr(57344))"
    return f"flatten(list_transform({x}, lambda s: {parts if most is None else f'CASE WHEN length(s) > {most} THEN {parts} ELSE [s] END'}))"


S_PIECES = reduce(lambda x, sep: s_split(x, sep, 512), ch.FINER, s_split("[content || chr(10)]", r"\n\n|[.!?] "))


@query(rf"""WITH l AS ({s_numbered_lines()}),
x AS (SELECT source_id, block_id, list_filter(flatten(list_transform({S_PIECES}, lambda s: CASE WHEN length(s) > 512 THEN regexp_extract_all(s, '(?s).{{1,512}}') ELSE [s] END)), lambda s: s <> '') AS ps FROM l),
p AS (SELECT source_id, block_id, k, ps[k] AS s, {s_tokens('ps[k]')} AS tokens FROM x, unnest(range(1, len(ps) + 1)) AS u(k)),
n AS (SELECT *, CAST(floor((sum(tokens) OVER (PARTITION BY source_id ORDER BY block_id, k) - 1) / 512.0) AS INTEGER) AS nth FROM p),
t AS (SELECT *, sum(tokens) OVER (PARTITION BY source_id, nth ORDER BY block_id DESC, k DESC) AS back, max(nth) OVER (PARTITION BY source_id) AS most FROM n),
e AS (SELECT source_id, nth, block_id, k, s FROM t UNION ALL SELECT source_id, nth + 1, block_id, k, s FROM t WHERE back <= 76 AND nth < most),
g AS (SELECT source_id, CAST(min(block_id) AS INTEGER) AS part, nth, string_agg(s, '' ORDER BY block_id, k) AS raw FROM e GROUP BY source_id, nth),
c AS (SELECT source_id, part, nth, {s_strip('raw')} AS text FROM g)
SELECT source_id, part, CAST(nth AS INTEGER) AS nth, {s_tokens('text')} AS token_count, {s_tokens('text')} > 1024 AS oversized, md5(text) AS digest FROM c WHERE text <> ''""")
def packed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.packed(line_blocks(spark, sf_dir)).select("source_id", "part", "nth", "token_count", "oversized", F.md5(F.encode("text", "UTF-8")).alias("digest"))


# summaries


S_SUMMARY = rf"""
b AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, array_to_string(string_split(text, chr(10)), ' ') AS t FROM documents),
u AS (SELECT source_id, source_id AS title, substr(t, 1, 200) AS summary FROM b),
m AS (SELECT *, list_filter(string_split_regex(regexp_replace(summary, '[,.|]', ' ', 'g'), '{WS}+'), lambda w: length(w) > 3) AS ws, {s_tokens('summary')} AS token_count FROM u),
su AS (SELECT source_id, title, summary, token_count, list_filter(ws, lambda w, i: list_position(ws, w) = i)[1:4] AS topics FROM m)"""


@query(f"WITH {S_SUMMARY} SELECT source_id, title, summary, token_count FROM su")
def doc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summaries(line_blocks(spark, sf_dir)).select("source_id", "title", "summary", "token_count")


@query(f"WITH {S_SUMMARY} SELECT source_id, array_to_string(topics, ' ') AS topics FROM su")
def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summaries(line_blocks(spark, sf_dir)).select("source_id", F.array_join("topics", " ").alias("topics"))


@query(f"WITH {S_MARKDOWN} SELECT source_id, string_agg(CASE WHEN type = 'heading' THEN repeat('#', level) || ' ' || content ELSE substr(content, 1, 400) END, chr(10) ORDER BY block_id) AS outline FROM s WHERE type IN ('heading', 'paragraph') GROUP BY source_id")
def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.outlines(blocks.markdown_blocks(region_markdown(spark, sf_dir), unicode=False))


@query(f"WITH {S_SUMMARY} SELECT source_id, 'has_topics' AS rule FROM su WHERE len(topics) < 2 UNION ALL SELECT source_id, 'within_budget' FROM su WHERE token_count > 45 UNION ALL SELECT source_id, 'summary_not_empty' FROM su WHERE {s_strip('summary')} = ''")
def summary_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = line_blocks(spark, sf_dir)
    return sm.summary_problems(sm.summaries(s), s, budget=45)


@query(f"WITH {S_SUMMARY} SELECT count(*) AS documents, CAST(sum(token_count) AS BIGINT) AS scan_tokens, round(avg(token_count), 6) AS mean_tokens FROM su")
def budget_scan_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.scan_cost(sm.summaries(line_blocks(spark, sf_dir))).withColumn("mean_tokens", F.round("mean_tokens", 6))


# catalogue, review queue, linkage


def tiers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents, their chunks (every seventh document's are missing), summaries, and what verification finds."""
    docs = judged(spark, sf_dir)
    lines = line_blocks(spark, sf_dir)
    chunks = ch.chunks(lines).where(F.col("source_id").cast("long") % 7 != 0)
    summaries = sm.summaries(lines)
    return docs, chunks, summaries, cat.verify(docs, chunks, summaries)


S_TIERS = f"""{S_JUDGED}, {S_SUMMARY}, {S_DOC_CHUNKS},
ck AS (SELECT source_id, count(*) AS n FROM c WHERE CAST(source_id AS BIGINT) % 7 <> 0 GROUP BY source_id),
ca AS (SELECT source_id, title, summary, topics, verdict AS status, coalesce(n, 0) AS chunk_count, token_count FROM su JOIN j USING (source_id, source_id) LEFT JOIN ck USING (source_id) WHERE verdict <> 'unusable'),
ve AS (SELECT j.source_id, ck.n IS NOT NULL AS chunks_ok, coalesce(su.summary, '') <> '' AS summary_ok FROM j LEFT JOIN ck USING (source_id) LEFT JOIN su USING (source_id) WHERE verdict <> 'unusable')""".replace("USING (source_id, source_id)", "USING (source_id)")


@query(f"WITH {S_TIERS} SELECT source_id, title, md5(summary) AS summary, array_to_string(topics, ' ') AS topics, status, chunk_count, token_count FROM ca")
def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, chunks, summaries, _ = tiers(spark, sf_dir)
    got = cat.catalog(docs, summaries, chunks)
    return got.select("source_id", "title", F.md5(F.encode("summary", "UTF-8")).alias("summary"), F.array_join("topics", " ").alias("topics"), "status", "chunk_count", "token_count")


@query(f"WITH {S_TIERS} SELECT source_id, chunks_ok, summary_ok, concat_ws('; ', CASE WHEN NOT chunks_ok THEN 'no chunks' END, CASE WHEN NOT summary_ok THEN 'empty summary' END) AS problems, chunks_ok AND summary_ok AS complete FROM ve")
def verify_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers(spark, sf_dir)[3].select("source_id", "chunks_ok", "summary_ok", F.array_join("problems", "; ").alias("problems"), "complete")


@query(f"""WITH {S_TIERS} SELECT source_id, 'unusable' AS reason, array_to_string(reasons, '; ') AS reasons FROM j WHERE verdict = 'unusable'
UNION ALL SELECT source_id, 'incomplete', concat_ws('; ', CASE WHEN NOT chunks_ok THEN 'no chunks' END, CASE WHEN NOT summary_ok THEN 'empty summary' END) FROM ve WHERE NOT (chunks_ok AND summary_ok)
UNION ALL SELECT 'archive.xyz', 'failed', 'no parser'""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _, _, verified = tiers(spark, sf_dir)
    failed = spark.createDataFrame([("archive.xyz", "no parser", "parse_error")], "source string, error string, kind string")
    return cat.review_queue(docs, verified, failed).select("source_id", "reason", F.array_join("reasons", "; ").alias("reasons"))


@query(f"WITH {S_TIERS} SELECT source_id, 'unreachable' AS kind FROM ca WHERE source_id NOT IN (SELECT source_id FROM ck) UNION ALL SELECT source_id, 'invisible' FROM ck WHERE source_id NOT IN (SELECT source_id FROM ca)")
def linkage_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, chunks, summaries, _ = tiers(spark, sf_dir)
    c = cat.catalog(docs, summaries, chunks)
    return cat.unreachable(c, chunks).withColumn("kind", F.lit("unreachable")).unionByName(cat.invisible(c, chunks).withColumn("kind", F.lit("invisible")))


@query(f"WITH {S_TIERS} SELECT source_id FROM ca WHERE source_id IN (SELECT source_id FROM ve WHERE NOT (chunks_ok AND summary_ok))")
def disjoint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogued documents that are also queued; the catalogue still holds incomplete ones here, so it isn't empty."""
    docs, chunks, summaries, verified = tiers(spark, sf_dir)
    return cat.in_both(cat.catalog(docs, summaries, chunks), cat.review_queue(docs, verified))


@query(f"""WITH {S_TIERS} SELECT (SELECT count(*) FROM j) AS selected, (SELECT count(*) FROM j WHERE verdict <> 'unusable') AS deliverable, (SELECT count(*) FROM j WHERE verdict = 'unusable') AS blocked,
(SELECT count(*) FROM ve WHERE chunks_ok AND summary_ok) AS verified_complete, (SELECT count(*) FROM ve WHERE NOT (chunks_ok AND summary_ok)) AS incomplete, 1::BIGINT AS failed, (SELECT count(*) FROM j) + 1 AS found""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _, _, verified = tiers(spark, sf_dir)
    failed = spark.createDataFrame([("archive.xyz", "no parser", "parse_error")], "source string, error string, kind string")
    return cat.run_report(docs, verified, failed)


@query("""SELECT CAST(doc_id AS VARCHAR) AS source_id, CASE WHEN doc_id % 4 = 0 THEN doc_id % 3 <> 0 ELSE doc_id % 2 = 0 END AS complete, CASE WHEN doc_id % 4 = 0 THEN 'verified' ELSE 'unverified' END AS state FROM documents""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), "doc_id")
    return cat.reconcile(d, d.where("doc_id % 4 = 0").withColumn("complete", F.col("doc_id") % 3 != 0), d.where("doc_id % 2 = 0").withColumn("ok", F.lit(True)))


@query("SELECT array_to_string(list_sort(list(DISTINCT lang)), ',') AS languages, count(DISTINCT lang) > 1 AS mixed FROM documents")
def summary_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cat.languages(table(spark, sf_dir, "documents").select(F.col("lang").alias("language")))
    return got.select(F.array_join("languages", ",").alias("languages"), "mixed")


@query("SELECT url AS source, CASE WHEN page_id % 3 = 0 THEN 'new' WHEN page_id % 3 = 1 THEN 'present' ELSE 'changed' END AS state FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)")
def reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").groupBy(F.col("url").alias("source")).agg(F.min("page_id").alias("id"))
    now = p.select("source", F.encode("source", "UTF-8").alias("content"))
    known = p.where("id % 3 != 0").select("source", F.when(F.col("id") % 3 == 1, F.sha2("source", 256)).otherwise(F.lit("old")).alias("hash"))
    return cat.already_present(now, known).select("source", "state")


@query("SELECT CAST(doc_id AS VARCHAR) AS source_id, CASE doc_id % 4 WHEN 0 THEN 'parse' WHEN 1 THEN 'chunk' ELSE 'summarize' END AS stage FROM documents WHERE doc_id % 4 <> 3")
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), F.lit("h").alias("hash"), (F.col("doc_id") % 4).alias("done"))
    stages = ["parse", "chunk", "summarize"]
    rows = d.select("source_id", "hash", F.explode(F.slice(F.array(*map(F.lit, stages)), F.lit(1), F.col("done").cast("int"))).alias("stage"), F.lit("done").alias("status"))
    return cat.pending(d, rows, stages)


# retrieval


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


S_TERMS = rf"""q AS (SELECT item_id AS question_id, list_distinct(list_transform(list_filter(string_split_regex(text, '{WS}+'), lambda w: length(w) > 4), lambda w: regexp_replace(lower(w), '\A[?.,]+|[?.,]+\z', '', 'g'))) AS terms FROM benchmark)"""
S_HAY = "lower(concat_ws(' ', title, summary, array_to_string(topics, ' ')))"


@query(f"WITH {S_SUMMARY}, {S_TERMS}, h AS (SELECT source_id, {S_HAY} AS t FROM su), r AS (SELECT question_id, source_id, len(list_filter(terms, lambda w: contains(t, w))) AS score FROM q, h) SELECT question_id, source_id, CAST(score AS INTEGER) AS score FROM r WHERE score > 0")
def broad_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.broad(questions(spark, sf_dir), sm.summaries(line_blocks(spark, sf_dir)))


@query(f"""WITH {S_DOC_CHUNKS}, {S_TERMS}, r AS (SELECT question_id, chunk_id, len(list_filter(terms, lambda w: contains(lower(text), w))) AS score FROM q, c)
SELECT question_id, chunk_id, CAST(score AS INTEGER) AS score, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM r WHERE score > 0 QUALIFY rank <= 5""")
def specific_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.ranked(rt.specific(questions(spark, sf_dir), doc_chunks(spark, sf_dir), k=5), "chunk_id", 5)


@query(f"""WITH {S_SUMMARY}, {S_DOC_CHUNKS}, {S_TERMS}, h AS (SELECT source_id, {S_HAY} AS t FROM su),
r AS (SELECT question_id, source_id, len(list_filter(terms, lambda w: contains(t, w))) AS score, terms FROM q, h),
best AS (SELECT * FROM r WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, source_id) <= 5)
SELECT question_id, source_id, chunk_id, CAST(len(list_filter(terms, lambda w: contains(lower(text), w))) AS INTEGER) AS score FROM best JOIN c USING (source_id) WHERE len(list_filter(terms, lambda w: contains(lower(text), w))) > 0""")
def two_stage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.two_stage(questions(spark, sf_dir), sm.summaries(line_blocks(spark, sf_dir)), doc_chunks(spark, sf_dir))


@query(f"WITH {S_DOC_CHUNKS} SELECT chunk_id FROM c JOIN documents ON source_id = CAST(doc_id AS VARCHAR) WHERE lang = 'de' AND source = 'src1'")
def tag_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = doc_chunks(spark, sf_dir)
    t = tg.propagate(doc_tags(spark, sf_dir), c)
    return rt.with_tag(c, t, {"lang": "de", "source": "src1"}).select("chunk_id")


# tags


def doc_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), "lang", "source")


TAG_SCHEMA = {"lang": ["en", "de"], "source": [f"src{i}" for i in range(10)]}
S_TAGS = f"""{S_DOC_CHUNKS}, ta AS (SELECT chunk_id, c.source_id, CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'unknown' END AS lang, CASE WHEN source IN ({', '.join(f"'src{i}'" for i in range(10))}) THEN source ELSE 'unknown' END AS source FROM c JOIN documents ON c.source_id = CAST(doc_id AS VARCHAR)),
di AS (SELECT 'lang' AS dimension, lang AS value FROM ta UNION ALL SELECT 'source', source FROM ta), dn AS (SELECT dimension, value, count(*) AS n FROM di GROUP BY ALL)"""


def chunk_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.apply_schema(tg.propagate(doc_tags(spark, sf_dir), doc_chunks(spark, sf_dir)), TAG_SCHEMA)


@query(f"WITH {S_TAGS} SELECT dimension, value, n FROM dn")
def tag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.distribution(chunk_tags(spark, sf_dir), list(TAG_SCHEMA))


@query(f"WITH {S_TAGS} SELECT dimension, round(sum(n) FILTER (value = 'unknown') / sum(n), 9) AS unknown_rate FROM dn GROUP BY dimension")
def unknown_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.dimension_stats(chunk_tags(spark, sf_dir), list(TAG_SCHEMA)).select("dimension", F.round("unknown_rate", 9).alias("unknown_rate"))


@query(f"""WITH {S_TAGS}, t AS (SELECT dimension, max(row(n, value)) AS m, sum(n) AS s, sum(n) FILTER (value = 'unknown') AS u FROM dn GROUP BY dimension)
SELECT dimension, m[2] AS dominant_value, round(m[1] / s, 9) AS dominant_share, concat_ws(',', CASE WHEN u / s > 0.2 THEN 'unknown_overuse' END, CASE WHEN m[1] / s > 0.9 THEN 'poor_discrimination' WHEN m[1] / s > 0.8 THEN 'dominant_value' END) AS flags FROM t""")
def dominant_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.dimension_stats(chunk_tags(spark, sf_dir), list(TAG_SCHEMA)).select("dimension", "dominant_value", F.round("dominant_share", 9).alias("dominant_share"), F.array_join("flags", ",").alias("flags"))


@query("SELECT source AS source_id, count(DISTINCT lang) AS values, count(DISTINCT lang) = 1 AS consistent FROM documents GROUP BY source")
def consistent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.consistent_documents(table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), "lang"), "lang")


ENTITY = ["the", "und", "que", "les", "zzzz", "of", "was"]


@query(f"""WITH e AS (SELECT doc_id, text, [{', '.join(f"'{x}'" for x in ENTITY)}] AS es FROM documents) SELECT doc_id, array_to_string(list_filter(es, lambda x: contains(text, x))[1:5], ',') AS entities FROM e""")
def entity_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(tg.verbatim_entities(F.array(*map(F.lit, ENTITY)), F.col("text")), ",").alias("entities"))


@query(f"""WITH e AS (SELECT [{', '.join(f"'{x}'" for x in ENTITY)}] AS es, text FROM documents) SELECT round(avg(len(list_filter(es, lambda x: contains(text, x))[1:5])), 9) AS avg_entities FROM e""")
def avg_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "documents").select(tg.verbatim_entities(F.array(*map(F.lit, ENTITY)), F.col("text")).alias("entities"))
    return tg.mean_entities(e).select(F.round("avg_entities", 9).alias("avg_entities"))


@query("SELECT dimension, value, count(*) AS affected_chunks FROM (SELECT 'lang' AS dimension, lang AS value FROM documents WHERE lang NOT IN ('en', 'de') UNION ALL SELECT 'source', source FROM documents WHERE CAST(substr(source, 4) AS INTEGER) > 9) GROUP BY ALL")
def schema_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "lang", "source")
    return tg.proposals(tg.apply_schema(raw, TAG_SCHEMA), raw, TAG_SCHEMA)


@query("SELECT CAST(doc_id AS VARCHAR) AS chunk_id, 'invalid_lang' AS rule FROM documents WHERE lang NOT IN ('en', 'de') UNION ALL SELECT CAST(doc_id AS VARCHAR), 'entities_not_in_text' FROM documents WHERE doc_id % 6 <> 0 AND NOT contains(text, 'the') UNION ALL SELECT CAST(doc_id AS VARCHAR), 'unknown_chunk' FROM documents WHERE doc_id % 6 = 0")
def tag_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    t = d.select(F.col("doc_id").cast("string").alias("chunk_id"), "lang", F.array(F.lit("the")).alias("entities"))
    c = d.where("doc_id % 6 != 0").select(F.col("doc_id").cast("string").alias("chunk_id"), "text")
    return tg.tag_problems(t, c, {"lang": ["en", "de"]}, ["lang"])


@query("SELECT CAST(doc_id AS VARCHAR) AS chunk_id FROM documents WHERE doc_id % 6 = 0")
def orphan_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "doc_id")
    return tg.orphan_tags(d, d.where("doc_id % 6 != 0")).select("chunk_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' WHEN o_orderdate >= TIMESTAMP '1996-06-01' THEN 'current' ELSE 'legacy' END AS period FROM orders")
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tg.time_period(day, F.lit("1998-06-01").cast("timestamp")).alias("period"))


@query("SELECT n_nationkey AS item, 'nation' AS node FROM nation WHERE n_regionkey = 0 UNION ALL SELECT n_nationkey, 'region' FROM nation WHERE n_regionkey IN (1, 2) UNION ALL SELECT n_nationkey, 'world' FROM nation WHERE n_regionkey > 2")
def hierarchy_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = spark.createDataFrame([("nation", "region"), ("region", "continent"), ("continent", "world"), ("world", None)], "node string, parent string")
    nodes = F.when(F.col("n_regionkey") == 0, F.array(F.lit("nation"))).when(F.col("n_regionkey") < 3, F.array(F.lit("nation"), F.lit("region"))).otherwise(F.array(F.lit("nation"), F.lit("world")))
    m = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("item"), F.explode(nodes).alias("node"))
    return tg.prune_descendants(m, tree).select("item", "node")


# page layout on boxes made from part numbers


def part_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.lit("s").alias("source_id"),
        (p % 7).cast("int").alias("page"),
        F.when(p % 7 < 3, (p * 37) % 250 + F.when(p % 2 == 0, 340).otherwise(0)).otherwise((p * 37) % 560).cast("double").alias("x0"),
        ((p * 37) % 560 + 20).cast("double").alias("x1"),
        ((p * 13) % 700).cast("double").alias("top"),
        ((p * 13) % 700 + 10).cast("double").alias("bottom"),
        F.lit(600.0).alias("width"),
        F.concat(F.lit("w"), p.cast("string")).alias("text"),
        p.alias("k"),
    )


S_WORDS = """w AS (SELECT p_partkey AS k, CAST(p_partkey % 7 AS INTEGER) AS page, CAST(CASE WHEN p_partkey % 7 < 3 THEN (p_partkey * 37) % 250 + CASE WHEN p_partkey % 2 = 0 THEN 340 ELSE 0 END ELSE (p_partkey * 37) % 560 END AS DOUBLE) AS x0,
CAST((p_partkey * 37) % 560 + 20 AS DOUBLE) AS x1, CAST((p_partkey * 13) % 700 AS DOUBLE) AS top, CAST((p_partkey * 13) % 700 + 10 AS DOUBLE) AS bottom, 600.0::DOUBLE AS width, 'w' || p_partkey AS text FROM part),
tw AS (SELECT page, count(*) >= 60 AND count(*) FILTER (abs(x0 - width / 2) <= width * 0.06) / count(*) < 0.03 AS two_columns FROM w GROUP BY page)"""


@query(f"WITH {S_WORDS} SELECT 's' AS source_id, page, two_columns FROM tw")
def two_column_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ly.two_column_pages(part_words(spark, sf_dir))


@query(f"""WITH {S_WORDS},
l AS (SELECT page, CASE WHEN two_columns AND x0 >= width / 2 THEN 1 ELSE 0 END AS col, CAST(round_even(top / 4, 0) AS BIGINT) AS row, string_agg(text, ' ' ORDER BY x0, top, text) AS line FROM w JOIN tw USING (page) GROUP BY ALL),
c AS (SELECT page, col, string_agg(line, chr(10) ORDER BY row) AS t FROM l GROUP BY ALL)
SELECT 's' AS source_id, page, string_agg(t, chr(10) || chr(10) ORDER BY col) AS text FROM c GROUP BY page""")
def words_to_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ly.page_text(part_words(spark, sf_dir))


@query(f"WITH {S_WORDS} SELECT k FROM w WHERE NOT ((page = 1 AND 100 <= x0 AND x1 <= 400 AND 50 <= top AND bottom <= 500) OR (page = 4 AND 0 <= x0 AND x1 <= 300 AND 0 <= top AND bottom <= 350))")
def table_word_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = spark.createDataFrame([("s", 1, 100.0, 50.0, 400.0, 500.0), ("s", 4, 0.0, 0.0, 300.0, 350.0)], "source_id string, page int, x0 double, top double, x1 double, bottom double")
    return ly.outside_tables(part_words(spark, sf_dir), b).select("k")


@query("""WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) AS source_id, l_linenumber AS row, c AS col, CASE WHEN (l_linenumber + c) % 3 <> 1 THEN l_partkey || ':' || c END AS value FROM lineitem, unnest([1, 2, 3]) AS u(c))
SELECT a.source_id, a.row, a.col, coalesce(t.value, a.value) AS value FROM c a LEFT JOIN c t ON t.source_id = a.source_id AND t.row = 1 AND t.col = 1 AND t.value IS NOT NULL AND a.row BETWEEN 1 AND 3 AND a.col BETWEEN 1 AND 2""")
def merged_cell_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    l_ = table(spark, sf_dir, "lineitem")
    cells = l_.select(F.col("l_orderkey").cast("string").alias("source_id"), F.col("l_linenumber").alias("row"), "l_partkey", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("col"))
    cells = cells.select("source_id", "row", "col", F.when((F.col("row") + F.col("col")) % 3 != 1, F.concat(F.col("l_partkey").cast("string"), F.lit(":"), F.col("col").cast("string"))).alias("value"))
    ranges = cells.select("source_id").distinct().select("source_id", F.lit(1).alias("min_row"), F.lit(3).alias("max_row"), F.lit(1).alias("min_col"), F.lit(2).alias("max_col"))
    return ly.expand_merged(cells, ranges)


@query("SELECT p_partkey AS k, CAST(row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY round_even(p_partkey * 977 % 90000 / 10000.0, 0), p_partkey) AS INTEGER) AS nth FROM part")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "part").select(F.lit("s").alias("source_id"), (F.col("p_partkey") % 5).cast("int").alias("slide"), (F.col("p_partkey") * 977 % 90000).alias("top"), F.col("p_partkey").alias("left"))
    return ly.reading_order(s).select(F.col("left").alias("k"), "nth")


@query("SELECT p_partkey AS source_id, round(p_size / CAST(greatest(p_partkey % 50 * 100, 1) AS DOUBLE), 6) AS text_density, p_size / CAST(greatest(p_partkey % 50 * 100, 1) AS DOUBLE) < 0.0005 AS diagram FROM part")
def text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"), (F.col("p_partkey") % 50).alias("width"), F.lit(100).alias("height"), F.col("p_size").alias("chars"))
    return ly.text_density(i).select("source_id", "text_density", "diagram")


@query(rf"""WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, p, {s_normalize('ls[p]')} AS c FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(p))
SELECT source_id, CAST(row_number() OVER (PARTITION BY source_id ORDER BY p) - 1 AS INTEGER) AS block_id, CASE WHEN length(c) < 80 AND NOT regexp_matches(c, '[.。!！?？;；]\z') THEN 'heading' ELSE 'paragraph' END AS type, length(c) AS n_chars, md5(c) AS digest FROM p WHERE c <> ''""")
def ocr_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return report(ly.ocr_text_blocks(d, "paddle", unicode=False), "type")


@query()
def ocr_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = part_words(spark, sf_dir).select(F.concat("source_id", F.col("page").cast("string")).alias("source_id"), "top", F.col("x0").alias("left"), F.lit(9.0).alias("height"), "text")
    return ly.box_blocks(b, unicode=False).select("source_id", "block_id", "content")


# sets, order, and the flagship


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def labelled_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").intersect(table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


@query(f"WITH {S_DOC_CHUNKS} SELECT count(*) AS differing FROM c WHERE false")
def rerun_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that two runs of the chunker don't share: none."""
    a, b = (doc_chunks(spark, sf_dir).select("chunk_id", "token_count") for _ in range(2))
    return a.exceptAll(b).unionByName(b.exceptAll(a)).agg(F.count("*").alias("differing"))


S_ALIVE = " AND ".join(f"NOT regexp_matches(c, '{p}')" for p in [*cl.PAGE_NUMBERS, *cl.WATERMARKS])


@query(rf"""
WITH RECURSIVE l AS (SELECT d.source_id, d.source, block_id, {s_normalize(r"regexp_replace(replace(replace(content, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t\x{a0}\x{3000}]{2,}', ' ', 'g')")} AS c FROM ({s_numbered_lines()}) d),
a AS (SELECT * FROM l WHERE c <> '' AND NOT regexp_matches({s_strip('c')}, '{cl.NOISE}') AND {S_ALIVE}),
n AS (SELECT source_id, count(*) AS n FROM a GROUP BY source_id),
k AS (SELECT source_id, c, count(*) AS m FROM a WHERE length(c) <= 200 GROUP BY ALL),
b AS (SELECT a.*, row_number() OVER (PARTITION BY a.source_id ORDER BY block_id) AS i FROM a JOIN n USING (source_id) LEFT JOIN k USING (source_id, c) WHERE n < 3 OR m IS NULL OR m < greatest(3, floor(n * CAST(0.35 AS DOUBLE)))),
f AS (
  SELECT source_id, i, block_id, c AS buf, CAST(NULL AS BIGINT) AS out_id, CAST(NULL AS VARCHAR) AS out_text FROM b WHERE i = 1
  UNION ALL
  SELECT b.source_id, b.i, CASE WHEN m THEN f.block_id ELSE b.block_id END,
         CASE WHEN m THEN {s_strip(r"regexp_replace(f.buf, '-+\z', '') || CASE WHEN ends_with(f.buf, '-') THEN '' ELSE ' ' END || b.c")} ELSE b.c END,
         CASE WHEN m THEN NULL ELSE f.block_id END, CASE WHEN m THEN NULL ELSE f.buf END
  FROM f JOIN b ON b.source_id = f.source_id AND b.i = f.i + 1,
       LATERAL (SELECT length(f.buf) < 80 OR NOT regexp_matches(regexp_replace(f.buf, '{WS}+\z', ''), '{cl.SENTENCE_END}') AS m)),
last AS (SELECT source_id, max(i) AS i FROM b GROUP BY source_id),
o AS (SELECT source_id, out_text AS c FROM f WHERE out_id IS NOT NULL UNION ALL SELECT source_id, buf FROM f JOIN last USING (source_id, i)),
u AS (SELECT DISTINCT source_id, c FROM o WHERE length({s_strip('c')}) >= 2),
t AS (SELECT source_id, count(*) AS kept, sum(length(c)) AS chars FROM u GROUP BY source_id),
r AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, source, len(string_split(text, chr(10))) AS before FROM documents),
v AS (SELECT source, coalesce(chars, 0) AS chars, CASE WHEN kept IS NULL THEN 'unusable' WHEN (before - kept) / CAST(before AS DOUBLE) > 0.5 THEN 'degraded' ELSE 'ok' END AS verdict FROM r LEFT JOIN t USING (source_id))
SELECT source, verdict, count(*) AS documents, CAST(sum(chars) AS BIGINT) AS chars FROM v GROUP BY ALL""")
def clean_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: clean every document, judge it, count verdicts by source. Which are safe to send on?"""
    d = table(spark, sf_dir, "documents")
    raw = line_blocks(spark, sf_dir)
    cleaned = cl.clean(raw, cl.Options(unicode=False))  # the tables hold NFKC text; tests cover normalisation itself
    docs = d.select(F.col("doc_id").cast("string").alias("source_id"), "source").join(raw.groupBy("source_id").agg(F.count("*").alias("blocks_before")), "source_id", "left")
    return vd.verdicts(docs, cleaned).groupBy("source", "verdict").agg(F.count("*").alias("documents"), F.sum("total_chars").cast("long").alias("chars"))
