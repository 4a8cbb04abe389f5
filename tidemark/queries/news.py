"""News feeds, pages, news tables, prompts, responses and chat data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import chat, news
from tidemark.plans.news import analyse_articles
from tidemark.plans.scoring import score_once
from tidemark.queries import views as v
from tidemark.queries.registry import query, settle
from tidemark.schemas import REPORT_ENTRY
from tidemark.session import scratch_path
from tidemark.sources import feeds, files, pages
from tidemark.sources.jsonparts import array_lines, keyed_entries

# --- feed and pages --------------------------------------------------------------------


@query(
    "s7_normalize_news",
    f"""SELECT company, id AS seq, title, originallink, pub_date FROM
       (SELECT * FROM {v.ARTICLES} QUALIFY row_number() OVER (PARTITION BY company, link ORDER BY id DESC) = 1) WHERE pub_date IS NOT NULL""",
)
def _(spark, sf):
    """Articles in Spanish have no original link: the feed's own counts."""
    date = F.coalesce(F.date_format("pub_date", "EEE, dd MMM yyyy HH:mm:ss +0000"), F.lit("yesterday"))
    item = F.struct(
        "title", "originallink", "link", F.col("content").alias("description"), date.alias("pubDate")
    )
    answers = v.articles(spark, sf).select("company", F.col("id").alias("seq"), F.to_json(F.struct(F.array(item).alias("items"))).alias("payload"))
    return feeds.normalize("news", answers).select("company", "seq", "title", "originallink", "pub_date")


def _sql_replace_entities(c: str) -> str:
    for entity, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        c = f"replace({c}, '{entity}', '{text}')"
    return c


def _sql_squeeze(c: str) -> str:
    c = f"regexp_replace({c}, '[ \\t\\r\\f]+', ' ', 'g')"
    c = f"regexp_replace({c}, ' ?\\n[ \\n]*', '\\n', 'g')".replace("'\\n', 'g'", "chr(10), 'g'")
    return f"regexp_replace({c}, '^[ \\n]+|[ \\n]+$', '', 'g')"


def _sql_strip(c: str) -> str:
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', ' ', 'g')"
    for name in ("script", "style", "noscript", "nav", "header", "footer", "aside", "form"):
        c = f"regexp_replace({c}, '(?is)<{name}\\b[^>]*>.*?</{name}>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?i)</?(p|br|div|li|h1|h2|h3|h4|h5|h6|tr|section|article)\\b[^>]*>', chr(10), 'g')"
    return _sql_squeeze(_sql_replace_entities(f"regexp_replace({c}, '(?s)<[^>]*>', '', 'g')"))


_ARTICLE = "regexp_extract(html, '(?is)<article\\b[^>]*>(.*)</article>', 1)"
_BODY = "regexp_extract(html, '(?is)<body\\b[^>]*>(.*)</body>', 1)"
_TEXT = _sql_strip(f"(CASE WHEN {_ARTICLE} <> '' THEN {_ARTICLE} WHEN {_BODY} <> '' THEN {_BODY} ELSE html END)")
_TITLE = _sql_squeeze(_sql_replace_entities("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))


@query(
    "s8_extract_articles",
    f"""SELECT page_id, url, title, CASE WHEN t <> '' THEN md5(t) END AS content_md5,
       CASE WHEN t = '' THEN 'no article text' END AS error
       FROM (SELECT page_id, url, {_TITLE} AS title, {_TEXT} AS t FROM pages)""",
)
def _(spark, sf):
    rows = pages.extract_articles(v.table(spark, sf, "pages"), whole=True)
    return rows.select("page_id", "url", "title", F.md5("content").alias("content_md5"), "error")


# The same blocks and the same tree in SQL, over pages with a list of links on either side of the article and a
# link that holds blocks.
_MENU = '<ul><li><a href="/a">More about this</a></li><li><a href="/b"><div>All about <b>that</b></div><div>and more</div></a></li></ul>'
_RELATED = '<section><h4>Read also</h4><p><a href="/c">What others have written about the same thing</a> (3)</p><p><a name="x">One more</section>'
_AROUND = f"replace(replace(html, '<article>', '{_MENU}<article>'), '</article>', '</article>{_RELATED}')"


def _sql_blocks(html: str) -> str:
    c = f"regexp_replace({html}, '(?s)<!--.*?-->', ' ', 'g')"
    for name in text.HIDDEN_ELEMENTS:
        c = f"regexp_replace({c}, '(?is)<{name}\\b[^>]*>.*?</{name}>', ' ', 'g')"
    for pattern, mark in (
        ("[\\x01-\\x03]", "' '"), ("(?i)&#(0*[1-3]|x0*[1-3]);", "' '"), ("(?i)<br\\b[^>]*>", "chr(10)"), ("(?i)<a\\b[^>]*>", "chr(1)"),
        ("(?i)</a\\b[^>]*>", "chr(2)"), (f"(?i)</?({text.BLOCK_ELEMENTS})\\b[^>]*>", "chr(3)"), ("(?s)<[^>]*>", "''"),
    ):
        c = f"regexp_replace({c}, '{pattern}', {mark}, 'g')"
    linked = """chr(1) || replace(split_part(p, m, 1), chr(3), chr(2) || chr(3) || chr(1)) || chr(2)
        || replace(substr(p, len(split_part(p, m, 1)) + 1), chr(2), '')""".replace("m,", "CASE WHEN contains(p, chr(2)) THEN chr(2) ELSE chr(3) END,")
    words = "CASE WHEN {0} = '' THEN 0 ELSE greatest(len(regexp_split_to_array({0}, '[ \n]+')), len({0}) // 10) END"
    links = "array_to_string(regexp_extract_all(b, chr(1) || '([^' || chr(2) || ']*)' || chr(2), 1), ' ')"
    plain = _sql_squeeze("replace(replace(b, chr(1), ''), chr(2), '')")
    return f"""(SELECT page_id, list_transform(list_filter(list_transform(string_split(t, chr(3)), lambda b:
        {{'text': {plain}, 'links': {_sql_squeeze(links)}}}), lambda b: b.text <> ''), lambda b:
        {{'text': b.text, 'words': {words.format("b.text")}, 'links': ({words.format("b.links")}) / CAST({words.format("b.text")} AS DOUBLE)}}) AS blocks
      FROM (SELECT page_id, replace(parts[1], chr(2), '') || array_to_string(list_transform(parts[2:], lambda p: {linked}), '') AS t
        FROM (SELECT page_id, string_split({_sql_replace_entities(c)}, chr(1)) AS parts FROM pages)))"""


@query(
    "s8_article_blocks",
    f"""SELECT page_id, md5(CASE WHEN main <> '' THEN main ELSE t END) AS content_md5, false AS has_links
       FROM (SELECT page_id, array_to_string(list_transform(list_filter(blocks, lambda b, i: b.links <= 0.333333 AND CASE
         WHEN coalesce(blocks[i - 1].links, 0) <= 0.555556
         THEN b.words > 16 OR coalesce(blocks[i + 1].words, 0) > 15 OR coalesce(blocks[i - 1].words, 0) > 4
         ELSE b.words > 40 OR coalesce(blocks[i + 1].words, 0) > 17 END), lambda b: b.text), chr(10)) AS main
         FROM {_sql_blocks(_AROUND)})
       JOIN (SELECT page_id, {_TEXT} AS t FROM (SELECT page_id, {_AROUND} AS html FROM pages)) USING (page_id)""",
)
def _(spark, sf):
    # A page without running text gives what its article element holds.
    rows = pages.extract_articles(v.table(spark, sf, "pages").select("page_id", F.expr(_AROUND).alias("html")))
    has_links = F.coalesce(F.col("content").rlike("More about this|All about that|same thing|One more"), F.lit(False))
    return rows.select("page_id", F.md5(F.coalesce("content", F.lit(""))).alias("content_md5"), has_links.alias("has_links"))


# Pages with known text around the real ones: references of every kind, and a list inside other elements.
_KNOWN_HTML = (
    '<div class="top"><div>x</div></div><div id="a" class="box hotNewsList"><div><ul><li><div><b>1</b> <a href="#">first &mdash; one</a></div></li>'
    "<li><p><a href='#'>second</a><a>third</a></p></li></ul></div></div><div><ul><li><a>not this</a></li></ul></div>"
    "<article>It&#8217;s &#x27;so&#x27; &hellip; &amp;lt; &unknown; &eacute;&copy;</article>"
)
_KNOWN_TEXT = "It’s ''so'' … &lt; &unknown; é©"


@query("s8_known_text", f"SELECT page_id, '{_KNOWN_TEXT}' AS first_line, md5({_TEXT}) AS rest_md5 FROM pages WHERE html LIKE '%<article>%'")
def _(spark, sf):
    """A known article before the text of each page's own."""
    article = F.regexp_extract(F.lit(_KNOWN_HTML), "(?s)(<article>.*)</article>", 1)
    known = v.table(spark, sf, "pages").where(F.contains("html", F.lit("<article>")))
    known = known.select("page_id", F.replace("html", F.lit("<article>"), F.concat(article, F.lit("<p>"))).alias("html"))
    content = pages.extract_articles(known, whole=True).select("page_id", F.split("content", "\n", 2).alias("c"))
    return content.select("page_id", F.get("c", 0).alias("first_line"), F.md5(F.coalesce(F.get("c", 1), F.lit(""))).alias("rest_md5"))


@query(
    "s9_known_headlines",
    """SELECT page_id, CAST(r AS INTEGER) AS rank, h AS headline FROM pages,
       (SELECT unnest([0, 1, 2]) AS r, unnest(['first — one', 'second', 'third']) AS h)""",
)
def _(spark, sf):
    known = v.table(spark, sf, "pages").select("page_id", F.concat("html", F.lit(_KNOWN_HTML)).alias("html"))
    return pages.top_headlines(known, 10, "div.hotNewsList")


_ANCHOR = _sql_squeeze(_sql_replace_entities("regexp_replace(a, '(?s)<[^>]*>', '', 'g')"))
HEADLINES = f"""SELECT page_id, url, CAST(r - 1 AS INTEGER) AS rank, {_ANCHOR} AS headline FROM
  (SELECT page_id, url, unnest(t) AS a, generate_subscripts(t, 1) AS r FROM
    (SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?is)<nav\\b[^>]*>(.*?)</nav>', 1),
      '(?is)<li\\b[^>]*>[ \\t\\r\\n]*<a\\b[^>]*>(.*?)</a>', 1) AS t FROM pages)) WHERE r <= %d"""


@query("s9_top_headlines", HEADLINES % 10)
def _(spark, sf):
    return pages.top_headlines(v.table(spark, sf, "pages"))


@query("o4_first_headlines", HEADLINES % 3)
def _(spark, sf):
    return pages.top_headlines(v.table(spark, sf, "pages"), 3)


@query(
    "s10_keyed_json",
    f"""SELECT CAST(id AS VARCHAR) AS id, sentiment, coalesce(array_to_string(positiveKeywords, '|'), 'none') AS positive, pubDate AS report_date
       FROM {v.REPORTS}""",
)
def _(spark, sf):
    path = scratch_path(spark, "reports")
    entries = chat.keyed_entries(v.reports(spark, sf), "id", ["sentiment", "positiveKeywords", "negativeKeywords", "pubDate"])
    files.write_keyed_json(entries, path)
    back = files.read_keyed_json(spark, path, REPORT_ENTRY)
    positive = F.coalesce(F.array_join("entry.positiveKeywords", "|"), F.lit("none"))
    return back.select("id", "entry.sentiment", positive.alias("positive"), F.col("entry.pubDate").alias("report_date"))


@query(
    "s10_keyed_documents",
    f"SELECT CAST(id AS VARCHAR) AS id, sentiment, pubDate AS report_date FROM {v.REPORTS}",
)
def _(spark, sf):
    path = scratch_path(spark, "documents")
    entries = chat.keyed_entries(v.reports(spark, sf), "id", ["sentiment", "positiveKeywords", "negativeKeywords", "pubDate"])
    files.write_keyed_documents(entries, path, entries_per_document=100)
    back = files.read_keyed_documents(spark, path, REPORT_ENTRY)
    return back.select("id", "entry.sentiment", F.col("entry.pubDate").alias("report_date"))


# --- news tables -----------------------------------------------------------------------


@query(
    "w6_with_position",
    f"""SELECT id, company, row_number() OVER (PARTITION BY company ORDER BY pub_date NULLS LAST,
         CASE WHEN pub_date IS NULL THEN md5(link || chr(1) || id) END, link, id) - 1 AS position FROM {v.ARTICLES}""",
)
def _(spark, sf):
    rows = v.articles(spark, sf).select("id", "company", "pub_date", "link")
    return news.article_positions(rows, tie=["link", "id"]).select("id", "company", "position")


def _load(spark, sf):
    """Articles without German texts; what is stored already are the articles in French."""
    articles = v.articles(spark, sf)
    contents = articles.where("lang <> 'de'").select("id", "content")
    existing = articles.where("lang = 'fr'").select((F.col("id") + 1).alias("news_id"), F.col("link").alias("news_api"))
    return news.load_news(articles.drop("content", "lang"), contents, v.reports(spark, sf), existing)


_NUMBERED = f"""known AS (SELECT max(id) + 1 AS last_id FROM {v.ARTICLES} WHERE lang = 'fr'),
  fresh AS (SELECT * FROM {v.ARTICLES} WHERE pub_date IS NOT NULL AND link NOT IN (SELECT md5(text) FROM documents WHERE lang = 'fr')
    QUALIFY row_number() OVER (PARTITION BY link ORDER BY company, pub_date, id) = 1),
  numbered AS (SELECT f.*, (SELECT last_id FROM known) + row_number() OVER (ORDER BY md5(link), link) AS news_id,
    r.sentiment, r.positiveKeywords, r.negativeKeywords, r.pubDate AS report_date, r.id IS NOT NULL AS has_report
    FROM fresh f LEFT JOIN {v.REPORTS} r ON f.id = r.id)"""


@query(
    "k6_news_main",
    f"""WITH {_NUMBERED} SELECT news_id, title, CASE WHEN lang = 'de' THEN '' ELSE md5(content) END AS content_md5, pub_date,
       'Naver' AS source, link AS news_api FROM numbered""",
)
def _(spark, sf):
    main = _load(spark, sf)["news_main"]
    text = F.when(F.col("content") != "", F.md5("content")).otherwise("")
    return main.withColumn("content_md5", text).drop("content")


@query("k6_news_company", f"WITH {_NUMBERED} SELECT news_id, company AS company_code FROM numbered WHERE company <> ''")
def _(spark, sf):
    return _load(spark, sf)["news_company"]


@query(
    "k6_news_sentiment",
    f"""WITH {_NUMBERED} SELECT news_id, coalesce(try_cast(sentiment AS DOUBLE), 0.0) AS sentiment,
       coalesce(array_to_string(positiveKeywords, ', '), '') AS positive_keywords,
       coalesce(array_to_string(negativeKeywords, ', '), '') AS negative_keywords,
       coalesce(try_cast(report_date AS TIMESTAMP), pub_date) AS pub_date, has_report FROM numbered""",
)
def _(spark, sf):
    return _load(spark, sf)["news_sentiment"]


@query(
    "k6_load_news_tables",
    f"""WITH {_NUMBERED} SELECT 'news_main' AS name, news_id, link AS value FROM numbered
       UNION ALL SELECT 'news_company', news_id, company FROM numbered WHERE company <> ''
       UNION ALL SELECT 'news_sentiment', news_id, CAST(has_report AS VARCHAR) FROM numbered
       UNION ALL SELECT 'news_main', id + 1, link FROM {v.ARTICLES} WHERE lang = 'fr'""",
)
def _(spark, sf):
    """Loads into the tables that the load reads: the first run stops after its staging and one table, the second
    completes it, the third adds nothing."""
    home = scratch_path(spark, "news-tables")
    articles = v.articles(spark, sf)
    contents, reports = articles.where("lang <> 'de'").select("id", "content"), v.reports(spark, sf)
    known = articles.where("lang = 'fr'").select((F.col("id") + 1).alias("news_id"), F.col("link").alias("news_api"))
    articles = articles.drop("content", "lang")
    # The tables as they are first: French articles, no companies and no scores.
    staged = news.stage_news(articles, contents, reports, known, f"{home}/staging")
    empty = news.news_tables(staged)
    tables = {name: f"{home}/{name}" for name in empty}
    empty["news_main"].limit(0).unionByName(known, allowMissingColumns=True).write.parquet(tables["news_main"])
    for name in ("news_company", "news_sentiment"):
        empty[name].limit(0).write.parquet(tables[name])
    empty["news_company"].write.mode("append").parquet(tables["news_company"])
    for _ in range(2):
        news.load_news_tables(articles, contents, reports, tables, f"{home}/staging")
    values = {"news_main": F.col("news_api"), "news_company": F.col("company_code"), "news_sentiment": F.col("has_report").cast("string")}
    parts = [spark.read.parquet(tables[n]).select(F.lit(n).alias("name"), "news_id", c.alias("value")) for n, c in values.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("k6_rejected", f"SELECT id, company FROM {v.ARTICLES} WHERE pub_date IS NULL")
def _(spark, sf):
    return _load(spark, sf)["rejected"].select("id", "company")


# --- prompts and responses -------------------------------------------------------------


@query(
    "l1_build_prompts",
    f"""SELECT doc_id, CAST(m AS INTEGER) AS at, CASE m WHEN 0 THEN 'system' ELSE 'user' END AS role,
       CASE m WHEN 0 THEN md5('{chat.SYSTEM_PROMPT}') ELSE md5('News article:' || chr(10) || chr(10) || text || chr(10) || chr(10)
         || 'Return the analysis of this article as JSON.') END AS content_md5
       FROM documents, (SELECT unnest([0, 1]) AS m)""",
)
def _(spark, sf):
    prompts = chat.build_prompts(v.table(spark, sf, "documents").select("doc_id", "text"), "text")
    rows = prompts.select("doc_id", F.posexplode("messages").alias("at", "m"))
    return rows.select("doc_id", "at", "m.role", F.md5("m.content").alias("content_md5"))


def length_scorer():
    """A scorer without a model: short articles score high, one above 5,000 characters fails."""
    wrapping = len(chat.ARTICLE_INTRO) + len(chat.ARTICLE_REQUEST)

    def score(text: str) -> str:
        n = len(text) - wrapping
        if n > 5000:
            raise ValueError("article too long")
        return f'{{"Sentiment": {100 / (100 + n)!r}}}'

    return score


@query(
    "l2_score_articles",
    """SELECT doc_id, CASE WHEN length(text) <= 5000 THEN CAST(100 / (100 + length(text)) AS FLOAT)::DOUBLE END AS score,
       CASE WHEN length(text) > 5000 THEN 'ValueError: article too long' END AS error FROM documents WHERE text <> ''""",
)
def _(spark, sf):
    scored = chat.score_articles(v.table(spark, sf, "documents").select("doc_id", "text"), length_scorer, "doc_id", "text")
    score = settle(F.get_json_object("response", "$.Sentiment").cast("double"))
    return scored.select("doc_id", score.alias("score"), "error")


@query(
    "l2_score_once",
    """SELECT doc_id, CASE WHEN length(text) <= 5000 THEN CAST(100 / (100 + length(text)) AS FLOAT)::DOUBLE END AS score,
       CASE WHEN length(text) > 5000 THEN 'ValueError: article too long' END AS error FROM documents WHERE text <> ''""",
)
def _(spark, sf):
    """English documents are scored first; the run of all documents finds their answers, and asks for equal texts once."""
    path = scratch_path(spark, "answers")
    docs = v.table(spark, sf, "documents").select("doc_id", "text", "lang")
    for some in (docs.where("lang = 'en'"), docs):
        scored = score_once(some, length_scorer, path, "doc_id", "text", files_per_step=8, tries=2, pause=0.0)
    score = settle(F.get_json_object("response", "$.Sentiment").cast("double"))
    return scored.select("doc_id", score.alias("score"), "error")


@query(
    "l2_analyse_articles",
    f"""SELECT id, CASE WHEN length(t) <= 5000 THEN CAST(100 / (100 + length(t)) AS FLOAT)::DOUBLE END AS score,
       CASE WHEN length(t) > 5000 THEN 'ValueError: article too long' END AS error
       FROM (SELECT a.page_id AS id, {_TEXT} AS t FROM (SELECT page_id, page_id % 40 AS link FROM pages) a
         JOIN (SELECT page_id % 40 AS link, arg_max(html, page_id) AS html FROM pages GROUP BY page_id % 40) b ON a.link = b.link) WHERE t <> ''""",
)
def _(spark, sf):
    """Many articles share a page that was fetched many times: the last copy is extracted and scored."""
    rows = v.table(spark, sf, "pages").withColumn("link", (F.col("page_id") % 40).cast("string"))
    date = F.timestamp_add("HOUR", F.col("page_id"), v.ntz("2024-01-01 00:00:00"))
    articles = rows.select(
        F.col("page_id").alias("id"), F.lit("").alias("title"), F.col("link").alias("originallink"), "link", date.alias("pub_date")
    )
    out = analyse_articles(articles, rows.select(F.col("link").alias("url"), "html", "page_id"), length_scorer, ["page_id"], whole=True, pause=0.0)
    reports = out.reports.select("id", settle(F.col("sentiment").cast("double")).alias("score"), F.lit(None).cast("string").alias("error"))
    return reports.unionByName(out.failures.withColumn("score", F.lit(None).cast("double")))


def _responses(spark, sf):
    """Responses for labelled documents: those for toxic ones are cut JSON."""
    labels = v.table(spark, sf, "labels")
    docs = v.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    rows = docs.join(labels, "doc_id")
    words = v.long_words()
    answer = F.to_json(
        F.struct(
            F.col("source").alias("CompanyName"),
            F.col("lang").alias("CompanySector"),
            (F.col("quality") * 1.25 - 0.125 * F.col("toxic")).cast("string").alias("Sentiment"),
            words.alias("PositiveKeywords"),
            F.array(F.lit("§")).alias("NegativeKeywords"),
        )
    )
    response = F.when((F.col("toxic") == 1) & (F.col("quality") == 1), F.concat(F.lit("{"), answer)).otherwise(answer)
    return rows.select("doc_id", "text", response.alias("response"))


_ANSWERS = f"""(SELECT doc_id, text, source, lang, toxic = 1 AND quality = 1 AS bad, quality * 1.25::DOUBLE - 0.125::DOUBLE * toxic AS s,
  {v.LONG_WORDS} AS words FROM documents JOIN labels USING (doc_id))"""


@query(
    "l3_parse_analysis",
    f"""SELECT doc_id, CASE WHEN NOT bad THEN source END AS companyName, CASE WHEN NOT bad THEN lang END AS companySector,
       CASE WHEN NOT bad THEN s END AS sentiment, CASE WHEN NOT bad THEN array_to_string(words, ',') END AS positive,
       CASE WHEN bad THEN 'Invalid JSON from GPT' END AS error, bad AS keeps_raw FROM {_ANSWERS}""",
)
def _(spark, sf):
    parsed = chat.parse_analysis(_responses(spark, sf))
    return parsed.select(
        "doc_id",
        "companyName",
        "companySector",
        F.col("sentiment").cast("double").alias("sentiment"),
        F.array_join("positiveKeywords", ",").alias("positive"),
        "error",
        (F.col("raw_response") == F.col("response")).alias("keeps_raw"),
    ).withColumn("keeps_raw", F.coalesce("keeps_raw", F.lit(False)))


@query(
    "l4_check_analysis",
    f"""SELECT doc_id, NOT bad AND s BETWEEN 0 AND 1 AS score_in_range, NOT bad AND abs(s - round(s, 2)) < 1e-9 AS score_two_decimals,
       bad OR len(words) <= 5 AS few_keywords, bad OR contains(text, '§') AS keywords_in_text FROM {_ANSWERS}""",
)
def _(spark, sf):
    checked = chat.check_analysis(chat.parse_analysis(_responses(spark, sf)), "text")
    return checked.select("doc_id", "score_in_range", "score_two_decimals", "few_keywords", "keywords_in_text")


# --- chat data -------------------------------------------------------------------------


@query(
    "l5_to_jsonl",
    "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations",
)
def _(spark, sf):
    turns = v.table(spark, sf, "conversations")
    docs = turns.select(F.to_json(F.struct(F.array(F.struct(*turns.columns)).alias("games"))).alias("doc"))
    lines = chat.to_jsonl(docs).select(F.from_json("line", turns.schema).alias("t")).select("t.*")
    return lines.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    "l5_array_lines",
    "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations",
)
def _(spark, sf):
    """One document for each role, whose array `games` holds all its turns; many tasks read it."""
    path = scratch_path(spark, "games")
    turns = v.table(spark, sf, "conversations")
    docs = turns.groupBy("role").agg(F.to_json(F.struct(F.lit(1).alias("v"), F.collect_list(F.struct("*")).alias("games"))).alias("value"))
    docs.select("role", "value").write.partitionBy("role").text(path)
    lines = array_lines(spark, path, "games", "*.txt").select(F.from_json("line", turns.schema).alias("t")).select("t.*")
    return lines.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    "s10_large_document",
    f"SELECT CAST(id AS VARCHAR) AS id, sentiment, pubDate AS report_date FROM {v.REPORTS}",
)
def _(spark, sf):
    """All reports in one document of the form {"id": {...}, ...}."""
    path = scratch_path(spark, "report-document")
    entries = chat.keyed_entries(v.reports(spark, sf), "id", ["sentiment", "positiveKeywords", "negativeKeywords", "pubDate"])
    members = entries.select(F.concat(F.lit('"'), "id", F.lit('": '), F.to_json("entry")).alias("m"))
    whole = members.agg(F.concat(F.lit("{\n"), F.array_join(F.collect_list("m"), ",\n"), F.lit("\n}")).alias("value"))
    whole.write.text(path)
    back = keyed_entries(spark, path, REPORT_ENTRY, "*.txt")
    return back.select("id", "entry.sentiment", F.col("entry.pubDate").alias("report_date"))


@query(
    "l6_reassemble_blocks",
    """SELECT source AS file, doc_id * 8 + CASE WHEN lang = 'fr' THEN 2 ELSE 1 END AS start, doc_id, md5(text) AS text_md5
       FROM documents WHERE lang <> 'de'""",
)
def _(spark, sf):
    """Every document as a block of lines in the file of its source: in German the block is no
    JSON, in French it is opened twice, in Spanish more text follows it."""
    lang = F.col("lang")
    body = F.concat(F.lit('  "doc_id": '), F.col("doc_id").cast("string"), F.lit(","))
    text = F.concat(F.lit('  "text": '), F.to_json(F.struct("text")).substr(F.lit(9), F.length(F.to_json(F.struct("text"))) - 9))
    lines = F.array(
        F.when(lang == "fr", F.lit("{")).otherwise(F.lit("between")),
        F.when(lang == "fr", F.lit("lost")).otherwise(F.lit(" {")),
        F.when(lang == "fr", F.lit("{")).otherwise(F.when(lang == "de", F.lit("no json")).otherwise(F.lit(""))),
        body,
        text,
        F.lit("} "),
        F.when(lang == "es", F.lit("}")).otherwise(F.lit("")),
    )
    docs = v.table(spark, sf, "documents")
    rows = docs.select(F.col("source").alias("file"), "doc_id", F.posexplode(lines).alias("at", "line"))
    blocks = chat.reassemble_blocks(rows.select("file", (F.col("doc_id") * 8 + F.col("at")).alias("line_no"), "line"))
    parsed = F.from_json("json", "doc_id BIGINT, text STRING")
    return blocks.select("file", "start", parsed["doc_id"].alias("doc_id"), F.md5(parsed["text"]).alias("text_md5"))


@query(
    "l7_recent_context",
    """SELECT conv_id, md5(string_agg(role || ':' || text, '|' ORDER BY turn)) AS messages_md5, count(*) AS n_messages
       FROM (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 5)
       WHERE role IN ('user', 'assistant') GROUP BY conv_id""",
)
def _(spark, sf):
    context = chat.recent_context(v.chat(spark, sf))
    joined = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return context.select("conv_id", F.md5(joined).alias("messages_md5"), F.size("messages").cast("bigint").alias("n_messages"))


@query(
    "a8_nested_messages",
    """SELECT conv_id, md5(string_agg(role || ':' || text, '|' ORDER BY turn)) AS messages_md5
       FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    nested = chat.nested_messages(v.table(spark, sf, "conversations"))
    joined = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return nested.select("conv_id", F.md5(joined).alias("messages_md5"))


@query(
    "a8_message_pieces",
    """SELECT role AS speaker, md5(string_agg(coalesce(text, ''), '|' ORDER BY conv_id, turn, text)) AS messages_md5, true AS bounded
       FROM conversations GROUP BY role""",
)
def _(spark, sf):
    """A few speakers hold all messages: each in pieces of at most 20,000 bytes, which joined are the whole."""
    turns = v.table(spark, sf, "conversations").select(
        F.col("role").alias("speaker"), F.struct("conv_id", "turn").alias("at"), F.lit("").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    pieces = chat.message_pieces(turns, ["speaker"], "at", max_bytes=20_000)
    texts = F.transform("messages", lambda m: m["content"])
    size = F.aggregate(F.transform(texts, F.octet_length), F.lit(0), lambda a, n: a + n)
    bounded = F.every((size <= 20_000) | (F.size("messages") == 1))
    joined = F.array_join(F.flatten(F.sort_array(F.collect_list(F.struct("first", texts.alias("t"))))["t"]), "|")
    return pieces.groupBy("speaker").agg(F.md5(joined).alias("messages_md5"), bounded.alias("bounded"))


@query(
    "a8_keyed_entries",
    f"SELECT CAST(id AS VARCHAR) AS id, title, originallink, md5(content) AS content_md5 FROM {v.ARTICLES}",
)
def _(spark, sf):
    entries = chat.keyed_entries(v.articles(spark, sf), "id", ["title", "originallink", "content"])
    return entries.select("id", "entry.title", "entry.originallink", F.md5("entry.content").alias("content_md5"))


_EXAMPLES = """(SELECT a.role AS r1, b.role AS r2, length(a.text) AS n FROM conversations a
  JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


@query(
    "a6_validate_chat",
    f"""WITH x AS {_EXAMPLES},
       kept AS (SELECT * FROM x WHERE n BETWEEN 60 AND 1200),
       counts AS (SELECT 'data_type' AS error, (SELECT count(*) FROM x WHERE n < 60) AS n
         UNION ALL SELECT 'missing_messages_list', (SELECT count(*) FROM x WHERE n > 1200)
         UNION ALL SELECT 'message_missing_key', (SELECT count(*) FROM kept WHERE r1 = 'system')
         UNION ALL SELECT 'message_unrecognized_key', (SELECT count(*) FROM kept WHERE r1 = 'assistant')
         UNION ALL SELECT 'unrecognized_role', (SELECT count(*) FROM kept WHERE r2 = 'user')
         UNION ALL SELECT 'missing_content', (SELECT count(*) FROM kept WHERE r1 = 'system')
         UNION ALL SELECT 'example_missing_assistant_message', (SELECT count(*) FROM kept WHERE r1 <> 'assistant' AND r2 <> 'assistant'))
       SELECT error, n FROM counts WHERE n > 0""",
)
def _(spark, sf):
    """Examples of two turns each: short ones are lists, long ones have no messages, a system
    message lacks its content, an answer has an unknown key, a second user is called "guest"."""
    turns = v.table(spark, sf, "conversations")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("r2"), F.col("text").alias("t2"))
    pairs = turns.join(after, ["conv_id", "turn"])
    first = F.struct(
        "role",
        F.when(F.col("role") != "system", F.col("text")).alias("content"),
        F.when(F.col("role") == "assistant", F.lit(1)).alias("score"),
    )
    second = F.struct(
        F.when(F.col("r2") == "user", F.lit("guest")).otherwise(F.col("r2")).alias("role"),
        F.col("t2").alias("content"),
        F.lit(None).cast("int").alias("score"),
    )
    example = F.to_json(F.struct(F.array(first, second).alias("messages")))
    n = F.length("text")
    raw = F.when(n < 60, F.lit("[1, 2]")).when(n > 1200, F.lit('{"messages": []}')).otherwise(example)
    return chat.validate_chat(pairs.select(raw.alias("raw")))
