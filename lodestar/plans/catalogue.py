"""The registered queries and their DuckDB oracles, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions import url as U
from lodestar.operators import folds, logstats, sets
from lodestar.operators.guides import article_text, page_links, parse_pages

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Register the decorated (spark, tables) function under its name, with its oracle."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def long(*names: str) -> dict:
    return {n: F.col(n).cast("long") for n in names}


# --- URLs ---------------------------------------------------------------------------------------

CANONICAL = r"""(lower(regexp_extract(b, '^[A-Za-z][A-Za-z0-9+.-]*:', 0)) || substr(b, length(regexp_extract(b, '^[A-Za-z][A-Za-z0-9+.-]*:', 0)) + 1))"""
BARE = r"""rtrim(regexp_replace(regexp_replace(trim(url), '(?s)[?#].*$', ''), ';[^/]*$', ''), '/')"""
PAGES_CANONICAL = f"(SELECT page_id, url, html, {CANONICAL} AS canonical_url FROM (SELECT *, {BARE} AS b FROM pages))"


@query(f"SELECT page_id, canonical_url FROM {PAGES_CANONICAL}")
def url_canonical(spark, t):
    return t("pages").select("page_id", U.canonical_url(F.col("url")).alias("canonical_url"))


@query(f"SELECT page_id, list_extract(string_split(canonical_url, '/'), -1) AS slug FROM {PAGES_CANONICAL}")
def url_slug(spark, t):
    return t("pages").select("page_id", U.slug(F.col("url")).alias("slug"))


@query(
    f"""SELECT page_id, coalesce(nullif(list_extract(string_split(trim(regexp_replace(canonical_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '/'), '/'), -1), ''), 'root') AS topic_slug
    FROM {PAGES_CANONICAL}"""
)
def topic_slug(spark, t):
    return t("pages").select("page_id", U.topic_slug(F.col("url")).alias("topic_slug"))


@query(
    r"""WITH p AS (SELECT page_id, url, n, regexp_extract(url, '#.*$', 0) AS frag, regexp_replace(url, '#.*$', '') AS bare FROM pages, (VALUES (1), (2)) v(n)),
    q AS (SELECT *, regexp_extract(bare, '\?(.*)$', 1) AS query, regexp_replace(bare, '\?.*$', '') AS base FROM p),
    r AS (SELECT *, list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT starts_with(x, 'guide=') AND NOT (n > 1 AND starts_with(x, 'page='))) AS rest,
                 len(list_filter(string_split(query, '&'), lambda x: starts_with(x, 'page='))) > 0 AND n > 1 AS has_page FROM q)
    SELECT page_id, n, base || '?' || CASE WHEN has_page THEN 'page=2&' || array_to_string(list_append(rest, 'guide=1'), '&')
      ELSE array_to_string(list_concat(list_append(rest, 'guide=1'), CASE WHEN n > 1 THEN ['page=2'] ELSE [] END), '&') END || frag AS listing_url FROM r"""
)
def url_listing(spark, t):
    pages = t("pages").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    return pages.select("page_id", "n", U.listing_url(F.col("url"), F.col("n")).alias("listing_url"))


@query(f"SELECT min(page_id) AS page_id, canonical_url FROM {PAGES_CANONICAL} GROUP BY canonical_url")
def url_dedup(spark, t):
    return folds.first_by(t("pages").select("page_id", U.canonical_url(F.col("url")).alias("canonical_url")), ["canonical_url"], "page_id")


# --- pages --------------------------------------------------------------------------------------

#: The article's text nodes, trimmed and joined by newlines, as the pages of the test tables allow it in SQL.
UNESCAPED = """replace(replace(replace(replace({}, '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"""
ARTICLE = r"""(SELECT page_id, url, array_to_string(list_filter(list_transform(
  string_split_regex(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '<[^>]*>'), lambda x: trim(""" + UNESCAPED.format("x") + r""", ' ' || chr(10) || chr(9) || chr(13))), lambda x: x <> ''), chr(10)) AS body,
  trim(""" + UNESCAPED.format(r"regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')") + r""") AS title FROM pages)"""
WORDS = r"len(list_filter(string_split_regex({}, '\s+'), lambda x: x <> ''))"


@query(f"SELECT page_id, title FROM {ARTICLE}")
def page_title(spark, t):
    return article_text(t("pages")).select("page_id", "title")


@query(
    f"""SELECT page_id, body AS combined_text, {WORDS.format('body')}::BIGINT AS word_count, ceil({WORDS.format('body')} / 225.0)::INT AS reading_time_minutes FROM {ARTICLE}"""
)
def page_text_stats(spark, t):
    words = T.word_count(F.col("combined_text"))
    return article_text(t("pages")).select("page_id", "combined_text", words.alias("word_count"), T.reading_minutes(words).alias("reading_time_minutes"))


@query(f"SELECT page_id, sha256(body) AS content_hash FROM {ARTICLE}")
def page_content_hash(spark, t):
    return article_text(t("pages")).select("page_id", T.content_hash(F.col("combined_text")).alias("content_hash"))


@query(
    f"""SELECT page_id, title, len(body) > 0 AS has_text, 1 AS section_count, {WORDS.format('body')} AS max_section_word_count,
    nullif(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), '') AS heading_slug FROM {ARTICLE}"""
)
def guide_sections(spark, t):
    g = parse_pages(t("pages"))
    return g.select(
        "page_id",
        "title",
        (F.length("combined_text") > 0).alias("has_text"),
        F.col("stats.section_count").alias("section_count"),
        F.col("stats.max_section_word_count").cast("long").alias("max_section_word_count"),
        F.col("sections")[0]["heading_slug"].alias("heading_slug"),
    )


LINKS = r"""(SELECT page_id, url, generate_subscripts(a, 1) AS pos, unnest(a) AS href FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS a FROM pages) WHERE len(a) > 0)"""


@query(
    f"""SELECT page_id, pos, href, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', 0) || href ELSE href END AS link
    FROM {LINKS}"""
)
def page_link_list(spark, t):
    links = page_links(t("pages"))
    return links.select("page_id", F.col("pos").cast("long").alias("pos"), "href", U.absolute_root_relative(F.col("url"), F.col("href")).alias("link"))


@query(f"SELECT page_id, count(*) AS raw_total, count(DISTINCT href) AS n_links FROM {LINKS} GROUP BY page_id")
def page_link_counts(spark, t):
    return page_links(t("pages")).groupBy("page_id").agg(F.count("*").alias("raw_total"), F.count_distinct("href").alias("n_links"))


@query(
    f"""SELECT page_id, href, min(pos) AS pos FROM {LINKS} WHERE (contains(href, 'th') OR contains(href, 'de')) AND NOT (contains(href, '#') OR contains(href, 'javascript:'))
    GROUP BY page_id, href"""
)
def topic_links(spark, t):
    links = page_links(t("pages")).where(U.is_topic_link(F.col("href"), ["#", "javascript:"], ["th", "de"]))
    return folds.first_by(links.select("page_id", "href", F.col("pos").cast("long").alias("pos")), ["page_id", "href"], "pos")


@query(
    f"""SELECT p.page_id, (contains(lower(html), 'captcha') OR contains(lower(html), 'are you a human') OR contains(lower(html), 'cf-challenge') OR contains(lower(html), 'data-sitekey')
      OR contains(lower(html), 'cloudflare ray id')) AND (regexp_matches(lower(html), '<form[^>]*>') OR regexp_matches(lower(html), 'recaptcha|hcaptcha|cf-challenge')) AS is_challenge,
      coalesce(title, '') = '' OR length(body) < 80 AS is_thin FROM pages p JOIN {ARTICLE} a USING (page_id)"""
)
def page_quality(spark, t):
    pages = article_text(t("pages"), keep=["html"])
    return pages.select("page_id", U.is_challenge(F.col("html")).alias("is_challenge"), U.is_thin(F.col("title"), F.col("combined_text")).alias("is_thin"))


@query(
    f"""SELECT host, count(*) AS n_pages, sum(w)::BIGINT AS n_words, sum(ceil(w / 225.0))::BIGINT AS minutes, count(DISTINCT body) AS n_texts FROM (
    SELECT regexp_extract(c.canonical_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, a.body, {WORDS.format('a.body')} AS w FROM {ARTICLE} a JOIN
      (SELECT page_id, canonical_url, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id DESC) AS n FROM {PAGES_CANONICAL}) c USING (page_id) WHERE c.n = 1) GROUP BY host"""
)
def host_digest(spark, t):
    """Flagship: the newest page of each canonical URL, its article's words and reading time, by host."""
    pages = t("pages").withColumn("canonical_url", U.canonical_url(F.col("url")))
    keep = pages.groupBy("canonical_url").agg(F.max("page_id").alias("newest")).select("newest")
    # Ids alone are shuffled; pages are parsed where they are read.
    newest = pages.select("page_id", "url", "html", "canonical_url").join(keep, F.col("page_id") == F.col("newest"), "left_semi")
    texts = article_text(newest, keep=["canonical_url"])
    words = texts.select(U.host(F.col("canonical_url")).alias("host"), T.word_count(F.col("combined_text")).alias("w"), "combined_text")
    return words.groupBy("host").agg(
        F.count("*").alias("n_pages"), F.sum("w").alias("n_words"), F.sum(T.reading_minutes(F.col("w"))).alias("minutes"), F.count_distinct("combined_text").alias("n_texts")
    )


# --- documents ----------------------------------------------------------------------------------


@query(f"SELECT doc_id, {WORDS.format('text')}::BIGINT AS word_count, ceil({WORDS.format('text')} / 225.0)::INT AS reading_time_minutes FROM documents")
def doc_reading_time(spark, t):
    words = T.word_count(F.col("text"))
    return t("documents").select("doc_id", words.alias("word_count"), T.reading_minutes(words).alias("reading_time_minutes"))


@query("SELECT doc_id, nullif(trim(regexp_replace(lower(string_split(text, chr(10))[1]), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug FROM documents")
def doc_slug(spark, t):
    return t("documents").select("doc_id", T.slugify(F.split(F.col("text"), "\n")[0]).alias("slug"))


@query("SELECT doc_id, CASE WHEN text <> '' THEN sha256(text) END AS content_hash FROM documents")
def doc_hash(spark, t):
    return t("documents").select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))


@query(
    f"""SELECT doc_id, sum(w)::BIGINT AS word_count, count(*) AS section_count, max(w)::BIGINT AS max_section_word_count, round_even(sum(w)::DOUBLE / count(*), 0)::INT AS avg_section_word_count,
    ceil(sum(w) / 225.0)::INT AS reading_time_minutes FROM (SELECT doc_id, {WORDS.format('s')} AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents)) GROUP BY doc_id"""
)
def doc_section_stats(spark, t):
    counts = F.transform(F.split(F.col("text"), "\n"), T.word_count)
    d = t("documents").select("doc_id", F.explode(counts).alias("w"))
    total = F.sum("w")
    return d.groupBy("doc_id").agg(
        total.alias("word_count"),
        F.count("*").alias("section_count"),
        F.max("w").alias("max_section_word_count"),
        T.half_even(total, F.count("*")).alias("avg_section_word_count"),
        T.reading_minutes(total).alias("reading_time_minutes"),
    )


@query(r"SELECT doc_id, regexp_extract(text, '\(\d{3}\)\s*\d{3}[- ]?\d{4}', 0) AS phone FROM documents WHERE regexp_matches(text, '\(\d{3}\)\s*\d{3}[- ]?\d{4}')")
def doc_phone(spark, t):
    return t("documents").select("doc_id", T.phone(F.col("text")).alias("phone")).where("phone is not null")


DATES = ["Aug 11, 2021", "August 11, 2021", "Sept 3, 2021", "Feb 31, 2021", "x 2021-13-45 y", "may 5, 2020", "none", "Jan 2, 1999", "Updated Dec 25, 2023 2024-01-01"]


@query(
    "SELECT * FROM (VALUES (0, '2021-08-11'), (1, NULL), (2, NULL), (3, NULL), (4, '2021-13-45'), (5, '2020-05-05'), (6, NULL), (7, NULL), (8, '2023-12-25')) v(id, published_date)"
)
def published_dates(spark, t):
    rows = spark.createDataFrame(list(enumerate(DATES)), "id int, s string")
    return rows.select("id", T.published_date(F.col("s")).alias("published_date"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash, count(*) AS n_copies FROM documents GROUP BY sha256(text)")
def doc_exact_dedup(spark, t):
    d = t("documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return d.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))


VERSION_EVENTS = """(SELECT source AS k, doc_id AS seq, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE sha256(text) END AS h, CASE WHEN doc_id % 5 <> 0 THEN lang END AS tp FROM documents)"""
VERSIONS = f"""(SELECT k, seq, h, tp, rn, coalesce(rn > 1 AND nullif(h, '') IS NOT NULL AND nullif(h, '') IS DISTINCT FROM p, false) AS upd FROM (SELECT *,
  row_number() OVER (PARTITION BY k ORDER BY seq) AS rn, last_value(nullif(h, '') IGNORE NULLS) OVER (PARTITION BY k ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {VERSION_EVENTS}))"""


def version_events(t):
    d = t("documents")
    content = F.when(d.doc_id % 7 == 0, F.lit(None)).when(d.doc_id % 11 == 0, "").otherwise(F.sha2(d.text, 256))
    return d.select(F.col("source").alias("key"), F.col("doc_id").alias("seq"), content.alias("content_hash"), F.when(d.doc_id % 5 != 0, d.lang).alias("primary_topic"))


@query(
    f"""SELECT key, seq, version, is_new, is_updated, last_value(tp IGNORE NULLS) OVER (PARTITION BY key, version ORDER BY seq ROWS UNBOUNDED PRECEDING) AS held_topic FROM (
    SELECT k AS key, seq, tp, rn = 1 AS is_new, upd AS is_updated, (1 + sum(upd::INT) OVER (PARTITION BY k ORDER BY seq ROWS UNBOUNDED PRECEDING))::INT AS version FROM {VERSIONS})"""
)
def doc_versions(spark, t):
    v = folds.versioned(version_events(t), "key", "seq")
    return v.select("key", "seq", "version", "is_new", "is_updated", "held_topic")


@query(
    f"""SELECT key, max(version) AS version, arg_max(h, seq) FILTER (WHERE coalesce(h, '') <> '') AS content_hash, first(topic ORDER BY seq DESC) AS primary_topic FROM (
    SELECT *, last_value(tp IGNORE NULLS) OVER (PARTITION BY key, version ORDER BY seq ROWS UNBOUNDED PRECEDING) AS topic FROM (
    SELECT k AS key, seq, h, tp, (1 + sum(upd::INT) OVER (PARTITION BY k ORDER BY seq ROWS UNBOUNDED PRECEDING))::INT AS version FROM {VERSIONS})) GROUP BY key"""
)
def state_upsert(spark, t):
    """The first half of the events makes the state, the second half is upserted into it."""
    events = version_events(t)
    half = F.col("seq") < 500
    empty = spark.createDataFrame([], "key string, content_hash string, primary_topic string, version int")
    state = folds.upsert(empty, events.where(half), "key", "seq")
    return folds.upsert(state, events.where(~half), "key", "seq").select("key", "version", "content_hash", "primary_topic")


MERGE = """(SELECT sha256(text) AS k, doc_id AS seq, CASE WHEN doc_id % 4 > 0 THEN doc_id % 3 END AS version, quality = 1 AS upd, CASE WHEN doc_id % 6 > 0 THEN (doc_id * 37) % 100 END AS seen
  FROM documents LEFT JOIN labels USING (doc_id))"""


@query(
    f"""WITH r AS (SELECT *, dense_rank() OVER (PARTITION BY k ORDER BY coalesce(version, 0) DESC, coalesce(upd, false) DESC) AS dr FROM {MERGE}),
    b AS (SELECT *, first_value(seen) OVER (PARTITION BY k ORDER BY seq) IS NULL AS head, row_number() OVER (PARTITION BY k ORDER BY seq) AS n,
      row_number() OVER (PARTITION BY k ORDER BY seen DESC NULLS LAST, seq) AS m FROM r WHERE dr = 1)
    SELECT k AS canonical_url, seq, version FROM b WHERE CASE WHEN head THEN n = 1 ELSE m = 1 END"""
)
def merge_precedence(spark, t):
    d = t("documents").join(t("labels"), "doc_id", "left")
    records = d.select(
        F.sha2("text", 256).alias("canonical_url"),
        F.col("doc_id").alias("seq"),
        F.when(F.col("doc_id") % 4 > 0, F.col("doc_id") % 3).alias("version"),
        (F.col("quality") == 1).alias("is_updated"),
        F.when(F.col("doc_id") % 6 > 0, (F.col("doc_id") * 37) % 100).alias("last_seen"),
    )
    return folds.merge_records(records, "canonical_url", "seq").select("canonical_url", "seq", "version")


@query("SELECT count(*) AS total, count(DISTINCT CASE WHEN text <> '' THEN sha256(text) END) AS unique_keys FROM documents")
def merge_summary(spark, t):
    return folds.merge_summary(t("documents").select(T.content_hash(F.col("text")).alias("k")), "k")


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def existing_skip(spark, t):
    return sets.unseen(t("documents").select("doc_id"), t("labels").select("doc_id"), ["doc_id"])


@query("SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def state_lookup(spark, t):
    return sets.seen(t("documents").select("doc_id"), t("labels").select("doc_id"), ["doc_id"])


@query("SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region WHERE (SELECT count(*) FROM nation) < 500 AND r_name NOT IN (SELECT n_name FROM nation)")
def seed_fallback(spark, t):
    return sets.with_seeds(t("nation").select(F.col("n_name").alias("name")), t("region").select(F.col("r_name").alias("name")), "name", 500)


@query("SELECT DISTINCT k FROM (SELECT sha256(text) AS k FROM documents UNION ALL SELECT sha256(text) FROM benchmark UNION ALL SELECT sha256(text) FROM conversations)")
def key_union(spark, t):
    every = t("documents").select("text").union(t("benchmark").select("text")).union(t("conversations").select("text"))
    return every.select(F.sha2("text", 256).alias("k")).distinct()


@query("SELECT doc_id, text AS title, source AS canonical_url FROM documents WHERE coalesce(text, '') <> '' AND coalesce(source, '') <> ''")
def valid_items(spark, t):
    from lodestar.sources.jsonl import valid

    d = t("documents").select("doc_id", F.col("text").alias("title"), F.col("source").alias("canonical_url"))
    return valid(d)


# --- relational state ---------------------------------------------------------------------------

VISITS = """(SELECT user_id AS topic, count(*) AS pages_crawled, count_if(event_type = 'click')::BIGINT AS guides_crawled, arg_max(event_id % 20, event_id) AS last_page_number, bool_or(event_type = 'purchase') AS is_complete
  FROM events GROUP BY user_id)"""


def visits(t):
    e = t("events")
    return e.select(
        F.col("user_id").alias("topic"), F.col("event_id").alias("seq"), F.lit(1).cast("long").alias("pages"), (e.event_type == "click").cast("long").alias("guides"),
        (e.event_id % 20).alias("page_number"), (e.event_type == "purchase").alias("complete"),
    )


@query(f"SELECT * FROM {VISITS}")
def topic_progress(spark, t):
    """The first visits make the state, the later ones are added to it."""
    v = visits(t)
    return folds.progress(v.where("seq >= 500"), folds.progress(v.where("seq < 500")))


@query(f"SELECT c_custkey AS topic, (coalesce(last_page_number, 0) + 1)::BIGINT AS start_page, coalesce(is_complete, false) AS exhausted FROM customer LEFT JOIN {VISITS} v ON v.topic = c_custkey")
def resume_progress(spark, t):
    return sets.resume(t("customer").select(F.col("c_custkey").alias("topic")), folds.progress(visits(t)))


@query("SELECT c_custkey, c_name, coalesce((SELECT count(*) FROM orders WHERE o_custkey = c_custkey), 0) AS n_guides FROM customer")
def topic_guide_counts(spark, t):
    customers = t("customer").select("c_custkey", "c_name")
    return sets.topic_counts(customers, t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT user_id, event_type FROM events GROUP BY ALL")
def bridge_insert_ignore(spark, t):
    pairs = t("events").select("user_id", "event_type", "event_id")
    bridge = pairs.where("event_id % 2 = 0").select("user_id", "event_type").distinct()
    return sets.insert_ignore(bridge, pairs.where("event_id % 2 = 1").select("user_id", "event_type"), ["user_id", "event_type"])


@query("SELECT c_nationkey AS topic, min(c_custkey) AS first_key, arg_max(c_mktsegment, c_custkey) AS segment FROM customer GROUP BY c_nationkey")
def topic_attributes(spark, t):
    c = t("customer").select(F.col("c_nationkey").alias("topic"), F.col("c_custkey").alias("first_key"), F.col("c_mktsegment").alias("segment"))
    first = folds.first_by(c, ["topic"], "first_key").select("topic", "first_key")
    return first.join(folds.last_value(c, "topic", "segment", "first_key"), "topic")


@query("SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n <= 3")
def page_cap_topn(spark, t):
    return sets.top_n(t("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], 3).select("l_orderkey", "l_linenumber")


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_name LIMIT 10")
def topic_cap(spark, t):
    return t("nation").select("n_nationkey", "n_name").orderBy("n_name").limit(10)


@query(
    """SELECT conv_id, turn, round, row_number() OVER (PARTITION BY round ORDER BY conv_id) AS place FROM
    (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS round FROM conversations)"""
)
def round_robin(spark, t):
    return sets.round_robin(t("conversations").select("conv_id", "turn"), "conv_id", "turn").withColumns(long("round", "place"))


@query("SELECT n_nationkey, n_name, row_number() OVER (ORDER BY md5(n_name || '7'), n_name) - 1 AS place FROM nation")
def seeded_shuffle(spark, t):
    """The rows in their order; the place is that of the partitions laid end to end."""
    shuffled = sets.seeded_order(t("nation").select("n_nationkey", "n_name"), "n_name", "7")
    return shuffled.coalesce(1).withColumn("place", F.monotonically_increasing_id())


@query(
    """SELECT 0 AS table_no, n_nationkey AS place, n_name AS name, row_number() OVER (ORDER BY n_nationkey) AS seq FROM nation
    UNION ALL SELECT 1, r_regionkey, r_name, (SELECT count(*) FROM nation) + row_number() OVER (ORDER BY r_regionkey) FROM region"""
)
def ordered_union(spark, t):
    """Two tables one after the other, numbered in that order."""
    n, r = t("nation").select(F.col("n_nationkey").alias("place"), F.col("n_name").alias("name")), t("region").select(F.col("r_regionkey").alias("place"), F.col("r_name").alias("name"))
    both = sets.ordered_union([n, r], "place")
    return both.select(F.col("seq.table").alias("table_no"), "place", "name", F.row_number().over(Window.orderBy("seq")).cast("long").alias("seq"))


@query("SELECT count(*) AS n_items, count_if(coalesce(quality, 0) = 0)::BIGINT AS n_dropped FROM documents LEFT JOIN labels USING (doc_id)")
def dropped_items(spark, t):
    """Documents as items whose title is there only where they are labelled good."""
    from lodestar.sources.jsonl import drop_report

    d = t("documents").join(t("labels"), "doc_id", "left")
    return drop_report(d.select(F.lit("u").alias("canonical_url"), F.when(F.col("quality") != 0, "title").alias("title")))


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n <= 2")
def topic_page_cap(spark, t):
    """Of each topic and kind of page the first two."""
    return sets.top_n(t("events"), ["user_id", "event_type"], ["event_id"], 2).select("user_id", "event_id")


# --- request log --------------------------------------------------------------------------------


def errors(t):
    return t("events").where("event_type = 'error'").select("event_id", "ts", "user_id", "value")


@query("SELECT event_id, ((row_number() OVER (ORDER BY epoch_us(ts) + event_id % 7 * 60000000, event_id) - 1) // 3)::BIGINT AS tick FROM events WHERE event_type = 'error'")
def release_batches(spark, t):
    ready = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 7 * 60_000_000
    return logstats.release_order(errors(t).select("event_id", ready.alias("ready")), "ready", "event_id").select("event_id", "tick")


@query("SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 12 HOURS PRECEDING AND CURRENT ROW) AS n_recent FROM events WHERE event_type = 'error'")
def storm_counts(spark, t):
    return logstats.trailing_count(errors(t), "ts", 12 * 3600, ["user_id"]).select("user_id", "event_id", "n_recent")


@query(
    """WITH b AS (SELECT event_id, least(300.0, CASE WHEN event_id % 2 = 0 THEN 5 ELSE 2 END * pow(2, event_id % 9))::DOUBLE * (0.75::DOUBLE + (event_id % 51)::DOUBLE / 100::DOUBLE) AS delay FROM events),
    r AS (SELECT event_id, CASE WHEN event_id % 17 = 0 AND (event_id % 400)::DOUBLE > delay THEN (event_id % 400)::DOUBLE + 2 ELSE delay END AS delay FROM b)
    SELECT event_id, CASE WHEN event_id % 23 = 0 AND 90::DOUBLE > delay THEN 92::DOUBLE ELSE delay END AS delay FROM r"""
)
def backoff_delay(spark, t):
    e = F.col("event_id")
    jitter = F.lit(0.75) + (e % 51).cast("double") / 100.0
    header, held = F.when(e % 17 == 0, (e % 400).cast("double")), F.when(e % 23 == 0, 90.0)
    return t("events").select("event_id", logstats.backoff(e % 9, e % 2 == 0, jitter=jitter, retry_after=header, throttled=held).alias("delay"))


@query(
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 24 HOURS THEN 1 ELSE 0 END AS brk FROM events WHERE event_type = 'error'),
    i AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g)
    SELECT user_id, event_id, island::BIGINT AS island, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS streak FROM i"""
)
def captcha_streak(spark, t):
    return logstats.streaks(errors(t), "user_id", "ts", 24 * 3600).select("user_id", "event_id", "island", F.col("streak").cast("long").alias("streak"))


@query(
    """WITH v AS (SELECT user_id, event_id, ts, round(value * 100)::BIGINT AS c FROM events),
    w AS (SELECT user_id, event_id, count(c) OVER f AS n, (sum(c) OVER f)::BIGINT AS total, list(c) OVER f AS l FROM v WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
    p AS (SELECT user_id, event_id, n, total, list_sort(l)[floor(0.9::DOUBLE * (n - 1))::INT + 1] AS p90 FROM w)
    SELECT user_id, event_id, n, total, p90, CASE WHEN n < 5 THEN 'none' WHEN total > 300 * n OR p90 > 500 THEN 'slow' WHEN total < 120 * n THEN 'fast' ELSE 'steady' END AS pace FROM p"""
)
def latency_rolling(spark, t):
    e = t("events").select("user_id", "event_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return logstats.rolling_latency(e, "user_id", ["ts", "event_id"], "cents").select("user_id", "event_id", "n", "total", "p90", "pace")


TOPIC_PAGES = """(SELECT user_id AS topic, page, guides, event_id % 5 > 0 AS has_next, 40 AS total_pages FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page,
  CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 4 END AS guides FROM events))"""


def topic_pages(t):
    e = t("events")
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(
        F.col("user_id").alias("topic"), page.alias("page"), F.when(e.event_id % 3 == 0, 0).otherwise(e.event_id % 4).alias("guides"), (e.event_id % 5 > 0).alias("has_next"), F.lit(40).alias("total_pages")
    )


@query(
    f"""SELECT topic, min(page) FILTER (WHERE guides = 0 AND (NOT has_next OR prev = 0 OR page >= total_pages))::BIGINT AS exhausted_at
    FROM (SELECT *, lag(guides) OVER (PARTITION BY topic ORDER BY page) AS prev FROM {TOPIC_PAGES}) GROUP BY topic"""
)
def topic_exhaustion(spark, t):
    return logstats.exhaustion(topic_pages(t)).withColumns(long("exhausted_at"))


@query(
    """SELECT conv_id, turn, n_items, complete_at, lag(complete_at) OVER (PARTITION BY conv_id ORDER BY turn) AS opened_at FROM
    (SELECT conv_id, turn, count(*) AS n_items, max(length(text)) AS complete_at FROM conversations GROUP BY conv_id, turn)"""
)
def page_barrier(spark, t):
    c = t("conversations").select("conv_id", "turn", F.length("text").cast("long").alias("done"))
    return logstats.page_barrier(c, "conv_id", "turn", "done")


@query(
    """SELECT user_id, event_id, gap_us FROM (SELECT user_id, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap_us FROM events) WHERE gap_us > 43200000000"""
)
def stall_watchdog(spark, t):
    return logstats.stalls(t("events").select("user_id", "event_id", "ts"), "user_id", "ts", 12 * 3600).select("user_id", "event_id", "gap_us")


@query(
    """SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, count(*) AS n_events, count_if(event_type = 'error')::BIGINT AS n_errors, count(DISTINCT user_id) AS n_topics FROM events GROUP BY ALL"""
)
def progress_windows(spark, t):
    w = t("events").groupBy(F.window("ts", "1 hour")).agg(
        F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors"), F.count_distinct("user_id").alias("n_topics")
    )
    return w.select(F.unix_micros(F.col("window.start").cast("timestamp")).alias("start_us"), "n_events", "n_errors", "n_topics")


@query(
    """SELECT count(*) AS pages, count_if(event_type = 'click')::BIGINT AS guides, count(DISTINCT user_id) AS topics, count_if(event_type = 'error')::BIGINT AS hits, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events"""
)
def crawl_counters(spark, t):
    of = lambda kind: F.count_if(F.col("event_type") == kind)
    return t("events").agg(
        F.count("*").alias("pages"), of("click").alias("guides"), F.count_distinct("user_id").alias("topics"), of("error").alias("hits"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")
    )


@query(
    """WITH RECURSIVE a AS (SELECT user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    f AS (SELECT user_id, n, us, CASE WHEN least(12.0::DOUBLE, 8.4::DOUBLE) >= 1 THEN 8.4::DOUBLE - 1 ELSE 8.4::DOUBLE END AS have, 1::BIGINT AS yes FROM a WHERE n = 1
      UNION ALL SELECT a.user_id, a.n, a.us, CASE WHEN x >= 1 THEN x - 1 ELSE x END, f.yes + CASE WHEN x >= 1 THEN 1 ELSE 0 END
      FROM (SELECT f.*, least(12.0::DOUBLE, f.have + 0.00001::DOUBLE * (greatest(0, b.us - f.us) / 1000000.0::DOUBLE)) AS x FROM f JOIN a b ON b.user_id = f.user_id AND b.n = f.n + 1) f JOIN a ON a.user_id = f.user_id AND a.n = f.n + 1)
    SELECT user_id, max(yes) AS admitted, max(n) - max(yes) AS delayed FROM f GROUP BY user_id"""
)
def token_bucket(spark, t):
    e = t("events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return logstats.token_bucket(e, "user_id", "event_id", "us", per_second=0.00001)


@query(
    """WITH RECURSIVE h AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts)) AS n FROM events WHERE event_type = 'error'),
    f AS (SELECT user_id, n, t, true AS is_on, t + 7500000000 AS till, 0 AS ext, 1 AS level, [t] AS hits, 1::BIGINT AS storms, 0::BIGINT AS total, 1.2::DOUBLE AS refill FROM h WHERE n = 1
      UNION ALL SELECT user_id, n, t, is_on OR starts, CASE WHEN starts THEN t + CASE WHEN len(hits) = 1 THEN 7500000000 ELSE 6750000000 END WHEN extends THEN till + 2000000000 ELSE till END,
        CASE WHEN extends THEN ext + 1 ELSE ext END, CASE WHEN starts THEN 1 WHEN extends THEN least(8, level + 1) ELSE level END, hits,
        storms + CASE WHEN starts THEN 1 ELSE 0 END, total + CASE WHEN extends THEN 1 ELSE 0 END, CASE WHEN extends THEN greatest(1.2::DOUBLE * 0.2::DOUBLE, refill * 0.85::DOUBLE) ELSE refill END
      FROM (SELECT *, NOT is_on AND (len(hits) = 1 OR len(hits) >= 5) AS starts, is_on AND ext < 6 AS extends FROM (
        SELECT f.user_id, b.n, b.t, f.is_on AND b.t < f.till AS is_on, f.till, CASE WHEN f.is_on AND b.t >= f.till THEN 0 ELSE f.ext END AS ext, CASE WHEN f.is_on AND b.t >= f.till THEN 0 ELSE f.level END AS level,
          list_filter(list_append(f.hits, b.t), lambda x: x >= b.t - 43200000000 AND NOT (f.is_on AND b.t >= f.till AND x <= b.t - 3600000000)) AS hits, f.storms, f.total, f.refill
        FROM f JOIN h b ON b.user_id = f.user_id AND b.n = f.n + 1)))
    SELECT user_id, storms, total AS extensions, till AS calm_us, level, refill FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1"""
)
def storm_machine(spark, t):
    """The 429 machine on a scale at which the events' hits make storms: hours for minutes."""
    e = errors(t).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return logstats.storm_machine(e, "user_id", "us", window_s=43200, calm_s=3600, first_cool=7500, cool=6750, extend=2000)


@query(
    """WITH RECURSIVE d AS (SELECT user_id, min(date_trunc('day', ts)) AS a, max(date_trunc('day', ts)) AS b FROM events GROUP BY user_id),
    e AS (SELECT user_id, date_trunc('day', ts) AS w, count_if(event_type = 'error') AS hits FROM events GROUP BY ALL),
    w AS (SELECT x.user_id, row_number() OVER (PARTITION BY x.user_id ORDER BY day) AS n, coalesce(hits, 0) AS hits FROM (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM d) x LEFT JOIN e ON e.user_id = x.user_id AND e.w = x.day),
    f AS (SELECT user_id, 0::BIGINT AS n, 0.8::DOUBLE AS g, 1.0::DOUBLE AS d, 0.6::DOUBLE AS r, 0 AS clean FROM d
      UNION ALL SELECT f.user_id, w.n, CASE WHEN hits > 0 THEN least(15::DOUBLE, g * pow(1.2::DOUBLE, hits)) WHEN clean >= 1 THEN greatest(0.3::DOUBLE, g * 0.9::DOUBLE) ELSE g END,
        CASE WHEN hits > 0 THEN least(5::DOUBLE, d * pow(1.25::DOUBLE, hits)) WHEN clean >= 1 THEN greatest(0.5::DOUBLE, d * 0.9::DOUBLE) ELSE d END,
        CASE WHEN hits = 0 AND clean >= 1 AND r < 1.2::DOUBLE THEN least(1.2::DOUBLE, r * 1.15::DOUBLE) ELSE r END,
        CASE WHEN hits > 0 THEN 0 WHEN clean >= 1 AND floor(g * 100) <> floor(greatest(0.3::DOUBLE, g * 0.9::DOUBLE) * 100) THEN 0 ELSE clean + 1 END
      FROM f JOIN w ON w.user_id = f.user_id AND w.n = f.n + 1)
    SELECT user_id, round(g, 6) AS global_gap, round(d, 6) AS guide_gap, round(r, 6) AS refill FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1"""
)
def adaptive_pacing(spark, t):
    """Each user's days as summary windows, days without events included."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp")
    days = t("events").groupBy("user_id", day.alias("w")).agg(F.count_if(F.col("event_type") == "error").alias("hits"))
    every = days.groupBy("user_id").agg(F.explode(F.sequence(F.min("w"), F.max("w"), F.expr("interval 1 day"))).alias("w"))
    dense = every.join(days, ["user_id", "w"], "left").select("user_id", "w", F.coalesce("hits", F.lit(0)).alias("hits"))
    paced = logstats.pacing(dense, "user_id", "w", "hits", refill=0.6)
    return paced.select("user_id", *[F.round(c, 6).alias(c) for c in ("global_gap", "guide_gap", "refill")])


@query(
    """WITH RECURSIVE a AS (SELECT user_id, epoch_us(ts) AS t, event_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS n,
      CASE WHEN event_id % 7 = 0 THEN epoch_us(ts) + 1 ELSE 0 END AS throttle_us, event_id % 11 = 0 AS storm, event_id % 9 AS in_flight FROM events),
    f AS (SELECT user_id, 0::BIGINT AS n, -1152921504606846976::BIGINT AS any_at, -1152921504606846976::BIGINT AS guide_at, -1 AS gate FROM a WHERE n = 1
      UNION ALL SELECT user_id, n, CASE WHEN gate IN (0, 5) THEN t ELSE any_at END, CASE WHEN gate IN (0, 5) THEN t WHEN gate = 2 THEN guide_at + 10200000000 ELSE guide_at END, gate
      FROM (SELECT f.user_id, a.n, a.t, any_at, guide_at, CASE WHEN any_at + 3600000000 > a.t THEN 1 WHEN guide_at + 10000000000 > a.t THEN 2 WHEN a.t < throttle_us THEN 3 WHEN storm THEN 4 WHEN in_flight >= 6 THEN 5 ELSE 0 END AS gate
        FROM f JOIN a ON a.user_id = f.user_id AND a.n = f.n + 1))
    SELECT user_id, count_if(gate = 0)::BIGINT AS admitted, count_if(gate = 1)::BIGINT AS global_gap, count_if(gate = 2)::BIGINT AS guide_gap, count_if(gate = 3)::BIGINT AS throttle,
      count_if(gate = 4)::BIGINT AS storm, count_if(gate = 5)::BIGINT AS in_flight FROM f GROUP BY user_id"""
)
def admission_gate(spark, t):
    e, us = t("events"), F.unix_micros(F.col("ts").cast("timestamp"))
    arrivals = e.select(
        "user_id", us.alias("us"), "event_id", F.when(e.event_id % 7 == 0, us + 1).otherwise(0).alias("throttle_us"), (e.event_id % 11 == 0).alias("storm"), (e.event_id % 9).alias("in_flight")
    )
    # By time, then by id.
    return logstats.admission(arrivals.withColumn("order", F.struct("us", "event_id")), "user_id", "order", "us", global_gap=3600, guide_gap=10_000, jitter=200)


@query(
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 24 HOURS THEN 1 ELSE 0 END AS brk FROM events WHERE event_type = 'error'),
    i AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g),
    k AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS streak, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW) AS n_recent FROM i)
    SELECT user_id, event_id, streak, n_recent, CASE WHEN n_recent >= 3 THEN 300.0 ELSE 120.0 END::DOUBLE AS cool, round(least(15.0, 0.3::DOUBLE * pow(1.5::DOUBLE, least(streak, 6))), 6)::DOUBLE AS global_target,
      round(least(6.0, 0.5::DOUBLE * pow(1.6::DOUBLE, least(streak, 6))), 6)::DOUBLE AS guide_target FROM k"""
)
def captcha_cooloff(spark, t):
    c = logstats.captcha(errors(t), "user_id", "ts", gap_s=24 * 3600, window_s=3 * 24 * 3600)
    return c.select(
        "user_id", "event_id", F.col("streak").cast("long").alias("streak"), "n_recent", "cool", F.round("global_target", 6).alias("global_target"), F.round("guide_target", 6).alias("guide_target")
    )


PACES = """(WITH v AS (SELECT user_id, ts, event_id, round(value)::BIGINT AS c FROM events),
    w AS (SELECT user_id, ts, event_id, count(c) OVER f AS n, (sum(c) OVER f)::BIGINT AS total, list(c) OVER f AS l FROM v WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
    p AS (SELECT *, list_sort(l)[floor(0.9::DOUBLE * (n - 1))::INT + 1] AS p90 FROM w)
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, CASE WHEN n < 5 THEN 'none' WHEN total > 300 * n OR p90 > 500 THEN 'slow' WHEN total < 120 * n THEN 'fast' ELSE 'steady' END AS pace FROM p)"""


@query(
    f"""WITH RECURSIVE p AS (SELECT * FROM {PACES}),
    f AS (SELECT DISTINCT user_id, 0::BIGINT AS n, 1.2::DOUBLE AS r, 0.8::DOUBLE AS g FROM p
      UNION ALL SELECT f.user_id, p.n, CASE pace WHEN 'slow' THEN greatest(0.4::DOUBLE, r * 0.9::DOUBLE) WHEN 'fast' THEN least(3::DOUBLE, r * 1.05::DOUBLE) ELSE r END,
        CASE pace WHEN 'slow' THEN least(15::DOUBLE, g * 1.1::DOUBLE) WHEN 'fast' THEN greatest(0.3::DOUBLE, g * 0.95::DOUBLE) ELSE g END FROM f JOIN p ON p.user_id = f.user_id AND p.n = f.n + 1)
    SELECT user_id, round(r, 6) AS refill, round(g, 6) AS global_gap FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1"""
)
def latency_adaptation(spark, t):
    e = t("events").select("user_id", "event_id", "ts", F.round("value").cast("long").alias("cents"))
    paced = logstats.rolling_latency(e, "user_id", ["ts", "event_id"], "cents")
    return logstats.latency_pacing(paced, "user_id", ["ts", "event_id"]).select("user_id", F.round("refill", 6).alias("refill"), F.round("global_gap", 6).alias("global_gap"))


@query("""SELECT event_id, '{"event":"' || event_type || '","spider":"lodestar","ts":' || (epoch_us(ts) // 1000000)::VARCHAR || '}' AS line FROM events""")
def log_lines(spark, t):
    from lodestar.sources.jsonl import log_line

    e = t("events")
    line = log_line(event=F.col("event_type"), spider=F.lit("lodestar"), ts=F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long"))
    return e.select("event_id", line.alias("line"))
