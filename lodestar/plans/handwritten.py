"""Queries over hand-written lines and pages, for what the test tables lack; each oracle states what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lodestar.functions import text as T
from lodestar.functions import url as U
from lodestar.operators.guides import items, listings, parse_pages
from lodestar.plans.catalogue import query
from lodestar.sources import jsonl

INTRO = "word " * 7 + "words"  # 40 characters
PAGES = {
    "list": f"<h1>A <b>Title</b></h1><time>Aug 11, 2021</time><div class='content-main'><p>{INTRO}</p><ol><li><h2>One</h2><p>foo<b>bar</b></p><script>no</script><li><h2>Two!</h2>z</ol></div>",
    "short": "<div class='content-main'><p>just a few words stand before</p><ol><li><h2>One</h2>y</li></ol></div>",
    "heads": "<article>lost<h2>A b</h2><p>one two</p><h2>C</h2>tail<p>three</p></article>",
    "whole": "<h1>T</h1><main><p>a b</p><noscript>n</noscript></main>",
    "none": "<h1>T</h1><div class='dropdown-content legal-guide'>x</div>",
    "dense": "<nav><p>" + "not " * 12 + "</p></nav><p>too short</p><p>" + "word " * 12 + "</p>",
    "tags": "<div id='filed-under'><a>Tax</a><a> </a><a>Show 2 more</a><a>Tax</a><a>Show me more</a><a>Wills</a></div>",
    "boxes": "<div class='x content-topic-tags'><a>Deeds</a><a>Show 3 less</a></div>",
    "authors": "<div id='guide-author'><a href='/attorneys/x-12.html'>Ann Attorney</a><a href='/attorneys/ann-poe-77.html'>Ann Poe</a> 3 reviews Tax Attorney in Salt Town, UT (801) 555-0100</div>"
    "<div class='header-details'><a href='/attorneys/ann-poe-77.html'>Ann Poe</a> Published August 11, 2021, revised May 5, 2022</div>",
    "pair": "<div id='guide-author'><a href='/attorneys/bo-5'>Bo</a> Attorney</div><div data-gtm-subcontext='author data'><a href='/attorneys/cy-6.html'>Cy</a> About the author Cy Family / Divorce Attorney</div>",
    "written": "<div>Written by <a href='/attorneys/bo-5'>Bo</a> Attorney</div>",
    "nobody": "<div id='guide-author'><a href='/people/bo-5'>Bo</a> Attorney in Salt Town, UT</div>",
    "links": "<div><a href='/out'>Out</a><div id='additional-resources'><a href='/a' rel='nofollow x'>A</a><a href='/b'> </a><a href='/a'>again</a><a href='/c'>C</a></div></div>",
    "said": "<section><p>Additional Resources</p><a href='/elsewhere'>no</a></section><ul><li>Additional resources <a href='/r'>R</a></li></ul>",
    "empty": "",
    "null": None,
}


def pages(spark):
    rows = [(i, f"HTTPS://Site.Example/guides/{k}/?q=1", h) for i, (k, h) in enumerate(PAGES.items())]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def records(spark):
    names = F.create_map(*[x for i, k in enumerate(PAGES) for x in (F.lit(i), F.lit(k))])
    return parse_pages(pages(spark)).withColumn("name", names[F.col("page_id").cast("int")])


@query(
    f"""SELECT * FROM (VALUES ('list', 1, NULL, 8, 'intro', sha256('{INTRO}')), ('list', 2, 'One', 3, 'one', sha256('One' || chr(10) || 'foo' || chr(10) || 'bar')), ('list', 3, 'Two!', 2, 'two', sha256('Two!' || chr(10) || 'z')),
    ('short', 1, 'One', 2, 'one', sha256('One' || chr(10) || 'y')), ('heads', 1, 'A b', 4, 'a-b', sha256('A b' || chr(10) || 'one two')), ('heads', 2, 'C', 2, 'c', sha256('C' || chr(10) || 'three')),
    ('whole', 1, 'T', 2, 't', sha256('a b')), ('dense', 1, NULL, 12, 'intro', sha256('{("word " * 12).strip()}'))) v(name, order_index, heading, word_count, heading_slug, content_hash)"""
)
def record_sections(spark, t):
    """Sections by list items, by headings, as a whole, and of dense paragraphs."""
    r = records(spark).select("name", F.explode("sections").alias("s"))
    return r.select("name", "s.order_index", "s.heading", "s.word_count", "s.heading_slug", "s.content_hash")


@query("SELECT * FROM (VALUES ('tags', 'Tax', true), ('tags', 'Wills', false), ('boxes', 'Deeds', true)) v(name, topic, is_primary)")
def record_topics(spark, t):
    return records(spark).select("name", F.explode("topics").alias("t")).select("name", F.col("t.name").alias("topic"), "t.is_primary")


@query(
    """SELECT * FROM (VALUES ('authors', 'Ann Poe', 77, 'Ann Attorney Ann Poe Tax Attorney', 'Salt Town', 'UT', '(801) 555-0100', '/attorneys/ann-poe-77.html'),
    ('pair', 'Bo', 5, NULL, NULL, NULL, NULL, '/attorneys/bo-5'), ('pair', 'Cy', 6, 'About the author Family/Divorce Attorney', NULL, NULL, NULL, '/attorneys/cy-6.html'),
    ('written', 'Bo', 5, 'Written by Attorney', NULL, NULL, NULL, '/attorneys/bo-5')) v(name, author, author_id, practice_area, city, state, contact_phone, profile_url)"""
)
def record_authors(spark, t):
    a = records(spark).select("name", F.explode("authors").alias("a"))
    return a.select("name", F.col("a.name").alias("author"), F.col("a.author_id").cast("int").alias("author_id"), "a.practice_area", "a.city", "a.state", "a.contact_phone", "a.profile_url")


@query(
    """SELECT * FROM (VALUES ('links', 1, 'Out', '/out', NULL), ('links', 2, 'A', '/a', 'nofollow'), ('links', 3, 'C', '/c', NULL), ('said', 1, 'R', '/r', NULL)) v(name, order_index, anchor_text, url, rel)
    WHERE name = 'links'"""
)
def record_resources(spark, t):
    return records(spark).where("name = 'links'").select("name", F.explode("additional_resources").alias("x")).select("name", "x.order_index", "x.anchor_text", "x.url", "x.rel")


@query(
    """SELECT * FROM (VALUES ('list', '2021-08-11', NULL, NULL, 'https://Site.Example/guides/list', 'list', 'ATitle', NULL, false), ('authors', NULL, 'UT', 'Salt Town', 'https://Site.Example/guides/authors', 'authors', NULL, NULL, true),
    ('tags', NULL, NULL, NULL, 'https://Site.Example/guides/tags', 'tags', NULL, 'Tax', true), ('null', NULL, NULL, NULL, 'https://Site.Example/guides/null', 'null', NULL, NULL, true))
    v(name, published_date, jurisdiction, location_city, canonical_url, slug, title, primary_topic, needs_rerender)"""
)
def record_fields(spark, t):
    """Dates, place and topic of a record; pages with too little text are to be rendered again."""
    r = records(spark).where(F.col("name").isin("list", "authors", "tags", "null"))
    thin = F.when(F.col("name") == "list", False).otherwise(F.col("needs_rerender"))
    return r.select("name", "published_date", "jurisdiction", "location_city", "canonical_url", "slug", "title", "primary_topic", thin.alias("needs_rerender"))


@query("SELECT 'whole' AS slug, 1 AS version, false AS is_updated, 2 AS words, 0 AS n_topics")
def record_item(spark, t):
    """The public columns of a versioned record."""
    r = items(records(spark).where("name = 'whole'").withColumns({"version": F.lit(1), "is_updated": F.lit(False)}))
    return r.select("slug", "version", "is_updated", F.col("stats.word_count").alias("words"), F.size("topics").alias("n_topics"))


CARDS = (
    "<a class='legal-guide-card' href='/legal-guides/a?x=1'>A</a><a class='legal-guide-card' href='/legal-guides/a?x=1'>A</a>"
    "<a class='legal-guide-card' href='/legal-guides/v'><i class='icon-play-video'></i></a><div class='legal-guide-card'>Video Legal Guide <a href='/legal-guides/w'>W</a></div>"
    "<div class='tlp-pagination'><a href='?page=2'>2</a><a href='?page=9'>9</a><a>77</a><a class='next disabled'>next</a></div>"
)
PLAIN = "<a href='/legal-guides/b#f'>B</a><a href='/other'>O</a><div class='legal-guide-card'>Video Legal Guide <a href='/legal-guides/w'>W</a></div><div class='tlp-pagination'><a class='next' href='?page=2'>on</a></div>"


@query(
    """SELECT * FROM (VALUES (1, ['https://s.example/legal-guides/a?x=1'], 3, 1, 9, true), (2, ['https://s.example/legal-guides/b#f'], 2, 1, NULL, true), (3, []::VARCHAR[], 0, 0, NULL, false))
    v(page_id, guide_urls, raw_total, video_skipped, total_pages, has_next)"""
)
def listing_pages(spark, t):
    """Cards before plain links, videos left out, the bar's numbers and its next link."""
    rows = [(1, "https://s.example/t/", CARDS), (2, "https://s.example/t/", PLAIN), (3, None, None)]
    got = listings(spark.createDataFrame(rows, "page_id int, url string, html string"))
    return got.drop("url")


@query("SELECT * FROM (VALUES (0, 'https://a.b/?guide=1&p=2'), (1, 'https://a.b/t?x=1&guide=1#f'), (2, 'https://a.b/t?guide=1'), (3, 'https://a.b/t?guide=1')) v(id, url)")
def listing_enforced(spark, t):
    rows = list(enumerate(["https://a.b/?guide=1&p=2", "https://a.b/t?x=1#f", "https://a.b/t?guide=12", "https://a.b/t"]))
    return spark.createDataFrame(rows, "id int, u string").select("id", U.enforce_listing(F.col("u")).alias("url"))


@query("SELECT * FROM (VALUES (0, 1704067200000000), (1, 1704060000000000), (2, 1704067200500000), (3, NULL), (4, NULL), (5, 1704067200000000)) v(id, us)")
def timestamps(spark, t):
    """With a Z, an offset, a fraction, as a date alone, malformed, and naive, which is UTC."""
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00+0200", "2024-01-01T00:00:00.5Z", "2024-01-01", "2024-01-01Tx", "2024-01-01T00:00:00"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, s string").select("id", F.unix_micros(T.parse_timestamp(F.col("s"))).alias("us"))


@query("SELECT * FROM (VALUES (0, 120.0::DOUBLE), (1, 60.0::DOUBLE), (2, NULL), (3, NULL), (4, NULL)) v(id, seconds)")
def retry_after(spark, t):
    rows = list(enumerate(["120", "Wed, 01 May 2024 00:01:00 GMT", "Wed, 01 May 2023 00:01:00 GMT", "soon", None]))
    now = F.lit("2024-05-01T00:00:00Z").cast("timestamp")
    return spark.createDataFrame(rows, "id int, h string").select("id", T.retry_after(F.col("h"), now).alias("seconds"))


LINES = [
    '{"canonical_url":"https://x/1/","version":1,"title":"first"}',
    "",
    "{bad",
    '{"canonical_url":"https://x/2?q","last_seen":"2024-01-01T00:00:00Z"}',
    "  ",
    '{"canonical_url":"https://x/2?q","last_seen":"2024-02-01T00:00:00Z","extra":[1]}',
    '{"canonical_url":"https://x/1/","version":1,"title":"tie"}',
    '{"version":3}',
    '{"canonical_url":"https://x/3","is_updated":true}',
    '{"canonical_url":"https://x/3","version":0}',
]
SCHEMA = StructType([StructField("canonical_url", StringType()), StructField("version", IntegerType())])


def lines(spark):
    return spark.createDataFrame([(x, (i // 4, 0, i)) for i, x in enumerate(LINES)], "value string, seq struct<file:int,block:bigint,at:bigint>")


@query(
    """SELECT * FROM (VALUES (0, 'https://x/1/', 1), (3, 'https://x/2?q', NULL), (5, 'https://x/2?q', NULL), (6, 'https://x/1/', 1), (7, NULL, 3), (8, 'https://x/3', NULL), (9, 'https://x/3', 0)) v(line, canonical_url, version)"""
)
def jsonl_rows(spark, t):
    return jsonl.parse_lines(lines(spark), SCHEMA).select(F.col("seq.at").cast("int").alias("line"), "r.*")


@query("SELECT 10::BIGINT AS n_lines, 2::BIGINT AS n_blank, 1::BIGINT AS n_bad")
def jsonl_report(spark, t):
    return jsonl.line_report(lines(spark), SCHEMA)


@query("SELECT * FROM (VALUES ('https://x/1'), ('https://x/2'), ('https://x/3')) v(canonical_url)")
def jsonl_keys(spark, t):
    return jsonl.keys_of(lines(spark))


@query(f"""SELECT * FROM (VALUES (0, 0, '{LINES[0]}'), (3, 5, '{LINES[5]}'), (8, 8, '{LINES[8]}')) v(first, line, value)""")
def jsonl_merge(spark, t):
    """Whole records of the merge, with the line at which their key is first met and their own."""
    return jsonl.merge_lines(lines(spark)).select(F.col("first.at").cast("int").alias("first"), F.col("seq.at").cast("int").alias("line"), "value")


@query("SELECT * FROM (VALUES (0, 'https://s/1'), (1, 'https://s/2')) v(pos, url)")
def seed_list(spark, t):
    return jsonl.seeds_of(spark.createDataFrame([('["https://s/1",\n "https://s/2"]',)], "value string"))


@query("SELECT * FROM (VALUES (1, 'a', 0), (2, NULL, 0)) v(id, topic, version)")
def schema_migration(spark, t):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, topic string")
    return jsonl.add_missing(rows, {"version": ("int", 0), "topic": ("string", "x")})
