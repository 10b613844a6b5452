"""Registered text, retrieval and routing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.text import ORDINAL_WORDS, html_to_text
from nimbus.operators import retrieval, routing
from nimbus.plans.registry import register
from nimbus.plans.sqltext import WITH_OBS, season_case
from nimbus.plans.weather_queries import observations
from nimbus.session import materialised
from nimbus.sources import reports
from nimbus.sources.tables import load

CHUNK, OVERLAP = 256, 20
TITLE_WORDS = ["Nicht", "with"]
TOP_K = 5


# What the pages of the tables hold, in the oracle's regular expressions (which know no possessive
# ones); & last, so that &amp;lt; stays &lt;.
_DROPPED = [r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>", r"(?is)<template\b[^>]*>.*?</template\s*>",
            r"(?s)<!--.*?-->", r"(?s)<![^>]*>", r"(?s)</?[a-zA-Z][^>]*>"]
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _sql_html_to_text(x: str) -> str:
    for pat in _DROPPED:
        x = f"regexp_replace({x}, '{pat}', '', 'g')"
    for ent, ch in HTML_ENTITIES:
        x = f"replace({x}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return x


@register("html_to_text", "F12", f"SELECT page_id, {_sql_html_to_text('html')} AS text FROM pages")
def q_html_to_text(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


#: How the known texts are written as HTML: characters as references, tags with > in quotes.
_WRITTEN = [("&", "&amp;"), ("<", "&lt;"), ("é", "&eacute;"), ("ü", "&#252;"), ("ö", "&#xF6;"), ("ß", "&szlig;"), ("ç", "&#231;"), (".", "&#46;")]
_BEFORE = "<p title=\"a > b\" class='x>y' id=z><!-- no > text --><script>if (a < b) { c = '&amp;' }</script>"
_AFTER = "<br/></p ><style>p > a { }</style> &euro;&#8364;&#x1F600;&#150;&bogus; &amp;lt; AT&T &"


@register("html_references", "F12", "SELECT doc_id, text || ' €€😀–&bogus; &lt; AT&T &' AS text FROM documents")
def q_html_references(spark, sf_dir):
    """Every document as HTML with references and quoted attributes, back to its text."""
    html = F.col("text")
    for ch, ref in _WRITTEN:
        html = F.replace(html, F.lit(ch), F.lit(ref))
    page = F.concat(F.lit(_BEFORE), html, F.lit(_AFTER))
    return load(spark, sf_dir, "documents").select("doc_id", html_to_text(page).alias("text"))


@register(
    "archive_parts", "F8 P8 F5",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time,
      {season_case('month(ts)')} AS season
    FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'""",
)
def q_archive_parts(spark, sf_dir):
    return reports.archive_parts(load(spark, sf_dir, "events"), ts="ts", content=None, year=2024)


@register(
    "chunk_text", "V1",
    f"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS toks FROM documents),
    s AS (SELECT doc_id, toks, unnest(range(0, greatest(len(toks) - {OVERLAP} - 1, 0) + 1, {CHUNK - OVERLAP})) AS st
          FROM t WHERE len(toks) > 0)
    SELECT doc_id, CAST(st // {CHUNK - OVERLAP} AS INTEGER) AS chunk_no,
      CAST(len(list_slice(toks, st + 1, st + {CHUNK})) AS INTEGER) AS n_tokens,
      array_to_string(list_slice(toks, st + 1, st + {CHUNK}), ' ') AS chunk
    FROM s""",
)
def q_chunk_text(spark, sf_dir):
    return retrieval.chunk_text(load(spark, sf_dir, "documents"), size=CHUNK, overlap=OVERLAP)


@register("embed_hash", "V2")
def q_embed_hash(spark, sf_dir):
    docs = retrieval.embed_hash(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.size("embedding").alias("dim"), F.bround(retrieval.norm(F.col("embedding")), 6).alias("norm"))


def _label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = load(spark, sf_dir, "embeddings")
    return retrieval.centroids(emb, "label", out="q_embedding").withColumnRenamed("label", "query_label")


_CENTROIDS_SQL = """WITH ex AS (SELECT label, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS x FROM embeddings),
  cm AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM ex GROUP BY label, pos),
  q AS (SELECT label AS query_label, list(m ORDER BY pos) AS qv FROM cm GROUP BY label)"""


@register(
    "top_k_cosine", "V3 J5 R3",
    f"""{_CENTROIDS_SQL},
  s AS (SELECT q.query_label, e.vec_id, round_even(list_cosine_similarity(q.qv, CAST(e.embedding AS DOUBLE[])), 9) AS similarity
        FROM q CROSS JOIN embeddings e)
  SELECT query_label, CAST(rank AS INTEGER) AS rank, vec_id, similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY similarity DESC, vec_id) AS rank FROM s) t
  WHERE rank <= {TOP_K}""",
)
def q_top_k_cosine(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings")
    return retrieval.top_k(_label_queries(spark, sf_dir), emb, TOP_K, qid="query_label", iid="vec_id")


@register(
    "top_k_filtered", "V4 V3 R3",
    f"""{_CENTROIDS_SQL},
  s AS (SELECT q.query_label, e.vec_id, round_even(list_cosine_similarity(q.qv, CAST(e.embedding AS DOUBLE[])), 9) AS similarity
        FROM q JOIN embeddings e ON e.label = q.query_label)
  SELECT query_label, CAST(rank AS INTEGER) AS rank, vec_id, similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY similarity DESC, vec_id) AS rank FROM s) t
  WHERE rank <= {TOP_K}""",
)
def q_top_k_filtered(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings").withColumnRenamed("label", "query_label")
    return retrieval.top_k(_label_queries(spark, sf_dir), emb, TOP_K, qid="query_label", iid="vec_id", on="query_label")


def digest_terms_sql(source: str, key: str, column: str) -> str:
    """(key, bucket, v): the non-zero components of ``embed_digest`` of a relation's text column."""
    bucket = "CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % 256"
    return f"""SELECT {key}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS v FROM (
      SELECT {key}, {bucket} AS bucket, CAST(count(*) AS DOUBLE) AS n
      FROM (SELECT {key}, unnest(list_filter(string_split_regex(lower({column}), '\\s+'), lambda x: x <> '')) AS t FROM {source}) GROUP BY 1, 2)"""


@register(
    "route_table", "V5 V2",
    f"""WITH dv AS ({digest_terms_sql('documents', 'doc_id', 'text')}),
    held AS (SELECT lang, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY lang),
    cv AS (SELECT d.lang AS table_name, dv.bucket, sum(dv.v) / any_value(held.n) AS v FROM dv JOIN documents d ON d.doc_id = dv.doc_id JOIN held ON held.lang = d.lang GROUP BY 1, 2),
    cn AS (SELECT table_name, sqrt(sum(v * v)) AS size FROM cv GROUP BY 1),
    sims AS (SELECT dv.doc_id, cv.table_name, round_even(sum(dv.v * cv.v) / any_value(cn.size), 9) AS similarity
      FROM dv JOIN cv ON cv.bucket = dv.bucket JOIN cn ON cn.table_name = cv.table_name GROUP BY 1, 2)
    SELECT s.doc_id AS qid, s.table_name, s.similarity, d.lang FROM sims s JOIN documents d ON d.doc_id = s.doc_id
    QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY s.similarity DESC, s.table_name) = 1""",
)
def q_route_table(spark, sf_dir):
    """Each document routed to the language whose centroid (of hashed
    embeddings) is closest: the catalog has one entry per language."""
    # embedded once, then read twice (catalog and routing)
    docs = materialised(retrieval.embed_digest(load(spark, sf_dir, "documents").select("doc_id", "lang", "text")), "embedded")
    catalog = retrieval.centroids(docs, "lang").withColumnRenamed("lang", "table_name")
    qs = docs.select(F.col("doc_id").alias("qid"), F.col("embedding").alias("q_embedding"), "lang")
    return retrieval.route_table(qs, catalog, keep=("lang",))


@register(
    "title_filter", "P15 U2",
    "SELECT 'documents' AS source, doc_id AS item_id FROM documents WHERE "
    + " OR ".join(f"contains(text, '{w}')" for w in TITLE_WORDS)
    + " UNION ALL SELECT 'benchmark' AS source, item_id FROM benchmark WHERE "
    + " OR ".join(f"contains(text, '{w}')" for w in TITLE_WORDS),
)
def q_title_filter(spark, sf_dir):
    """Items whose text contains any of the words (case-sensitive), from two
    sources concatenated with duplicates kept; each table is scanned once and
    the contains-filter is pushed into the scan."""
    docs = reports.title_filter(load(spark, sf_dir, "documents"), "text", TITLE_WORDS)
    bench = reports.title_filter(load(spark, sf_dir, "benchmark"), "text", TITLE_WORDS)
    return reports.concat_lists([
        docs.select(F.lit("documents").alias("source"), F.col("doc_id").alias("item_id")),
        bench.select(F.lit("benchmark").alias("source"), "item_id"),
    ])


# --- questions built from orders ------------------------------------------------------

def questions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order in one of seven forms (six name a day or a month)."""
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.when(k % 3 == 0, F.to_date("o_orderdate")).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (k % 35).cast("int")))
    day = F.dayofmonth(d)
    month = F.date_format(d, "MMMM")
    year = F.year(d).cast("string")
    suffix = (
        F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th")
    )
    form = F.when(k % 7 == 0, F.lit(6)).otherwise((k % 6).cast("int"))
    ordinal = F.element_at(F.array(*[F.lit(w) for w in ORDINAL_WORDS]), day)
    q = (
        F.when(form == 0, F.concat(F.lit("Would "), month, F.lit(" "), day.cast("string"), F.lit(", "), year, F.lit(" have suited a picnic?")))
        .when(form == 1, F.concat(F.lit("What does the weather look like on "), month, F.lit(" "), day.cast("string"), suffix, F.lit(", "), year, F.lit("?")))
        .when(form == 2, F.concat(F.lit("Weather report for "), F.date_format(d, "yyyyMMdd")))
        .when(form == 3, F.concat(F.lit("Report for "), F.date_format(d, "yyyy-MM-dd"), F.lit(" please")))
        .when(form == 4, F.concat(F.lit("Can you generate the weather report for "), ordinal, F.lit(" day of "), month, F.lit(", "), year, F.lit(" in De Bilt?")))
        .when(form == 5, F.concat(F.lit("How many days did it rain in "), month, F.lit(", "), year, F.lit(" in Eindhoven?")))
        .otherwise(F.concat(F.lit("Which coat do people wear in "), month, F.lit("?")))
    )
    return o.select(F.col("o_orderkey").alias("qid"), q.alias("question"))


_ORD_LIST = "[" + ", ".join(f"'{w}'" for w in ORDINAL_WORDS) + "]"
QUESTIONS_SQL = f"""q0 AS (
  SELECT o_orderkey AS qid,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE)
         ELSE CAST(DATE '2024-01-01' + CAST(o_orderkey % 35 AS INTEGER) AS DATE) END AS d,
    CASE WHEN o_orderkey % 7 = 0 THEN 6 ELSE CAST(o_orderkey % 6 AS INTEGER) END AS form
  FROM orders),
q1 AS (
  SELECT qid, d, form, day(d) AS dd, strftime(d, '%B') AS mon, CAST(year(d) AS VARCHAR) AS yr,
    CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd' WHEN day(d) IN (3, 23) THEN 'rd' ELSE 'th' END AS sfx
  FROM q0),
qs AS (
  SELECT qid, form, d,
    CASE form
      WHEN 0 THEN 'Would ' || mon || ' ' || CAST(dd AS VARCHAR) || ', ' || yr || ' have suited a picnic?'
      WHEN 1 THEN 'What does the weather look like on ' || mon || ' ' || CAST(dd AS VARCHAR) || sfx || ', ' || yr || '?'
      WHEN 2 THEN 'Weather report for ' || strftime(d, '%Y%m%d')
      WHEN 3 THEN 'Report for ' || strftime(d, '%Y-%m-%d') || ' please'
      WHEN 4 THEN 'Can you generate the weather report for ' || list_element({_ORD_LIST}, dd) || ' day of ' || mon || ', ' || yr || ' in De Bilt?'
      WHEN 5 THEN 'How many days did it rain in ' || mon || ', ' || yr || ' in Eindhoven?'
      ELSE 'Which coat do people wear in ' || mon || '?' END AS question
  FROM q1)"""


@register(
    "question_dates", "F20",
    f"""WITH {QUESTIONS_SQL}
    SELECT qid, question, CASE WHEN form <= 4 THEN d END AS q_date,
      CASE WHEN form = 5 THEN CAST(date_trunc('month', d) AS DATE) END AS month_start,
      CASE WHEN form = 5 THEN CAST(last_day(d) AS DATE) END AS month_end
    FROM qs""",
)
def q_question_dates(spark, sf_dir):
    return routing.with_question_dates(questions_from_orders(spark, sf_dir))


@register(
    "route_questions", "V6",
    f"""WITH {QUESTIONS_SQL}
    SELECT qid, CASE WHEN form <= 5 THEN 'observations' ELSE 'articles' END AS route FROM qs""",
)
def q_route_questions(spark, sf_dir):
    return routing.route(questions_from_orders(spark, sf_dir)).select("qid", "route")


@register(
    "answer_context", "V7 F20 V6",
    f"""{WITH_OBS}, {QUESTIONS_SQL},
    per_day AS (SELECT obs_date AS day, count(*) AS n FROM obs GROUP BY obs_date),
    per_month AS (SELECT CAST(date_trunc('month', day) AS DATE) AS m, sum(n) AS n FROM per_day GROUP BY 1),
    c AS (
      SELECT qs.qid, qs.form,
        CASE WHEN qs.form <= 4 THEN COALESCE(pd.n, 0) WHEN qs.form = 5 THEN COALESCE(pm.n, 0) ELSE 0 END AS n
      FROM qs LEFT JOIN per_day pd ON qs.form <= 4 AND pd.day = qs.d
              LEFT JOIN per_month pm ON qs.form = 5 AND pm.m = CAST(date_trunc('month', qs.d) AS DATE))
    SELECT qid, CASE WHEN form = 6 THEN 'articles' WHEN n = 0 THEN 'both' ELSE 'observations' END AS route,
      CAST(n AS BIGINT) AS n_obs_rows
    FROM c""",
)
def q_answer_context(spark, sf_dir):
    routed = routing.route(questions_from_orders(spark, sf_dir))
    return routing.answer_context(routed, observations(spark, sf_dir))
