"""Web/API payloads as tables: XML pay API, RSS feeds, JSON news search.

A payload is one response document stored as a string column (one row per
response page, as a crawler or a landing folder would hold them).  Parsing is
``from_xml`` / ``from_json`` with an explicit schema plus ``inline``; nothing
leaves the JVM.  Every page holds a bounded number of items (the APIs' page
size), so no task ever parses an unbounded document.

The test tables hold no payloads; ``*_payloads`` functions derive them from the
given tables (FIXTURES B) by grouping rows into pages of at most ``page_size``
items — Spark builds them, so they grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import money_text_to_long, non_empty, xml_escape

XML_OPTS = {"ignoreSurroundingSpaces": "false"}

# Result codes the pay API reports as success, and its messages.
API_OK_CODES = ("00", "0")
API_OK_MSG = "NORMAL SERVICE."
API_NODATA = ("03", "NODATA_ERROR")

PAY_PAYLOAD_SCHEMA = ("header STRUCT<resultCode STRING, resultMsg STRING>, "
                      "body STRUCT<items STRUCT<item ARRAY<STRUCT<ENT_NAME STRING, N_SUM STRING>>>, "
                      "numOfRows STRING, pageNo STRING, totalCount STRING>")
RSS_SCHEMA = "channel STRUCT<item ARRAY<STRUCT<title STRING, link STRING, pubDate STRING>>>"
NEWS_JSON_SCHEMA = ("STRUCT<items: ARRAY<STRUCT<title: STRING, originallink: STRING, link: STRING, "
                    "description: STRING, pubDate: STRING>>>")


def _element(tag: str, c: Column) -> Column:
    """The element, or nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"<{tag}>"), xml_escape(c), F.lit(f"</{tag}>")), F.lit(""))


def _el(tag: str, c: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), F.coalesce(xml_escape(c), F.lit("")), F.lit(f"</{tag}>"))


def hash_bucket(c: Column, n: Column | int) -> Column:
    """Stable bucket in [0, n) from the md5 of the text (same number in any engine)."""
    h = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, n if isinstance(n, Column) else F.lit(n))


# pay API (XML) ------------------------------------------------------------------
def pay_api_payloads(items: DataFrame, page_size: int = 500) -> DataFrame:
    """(pay_year, page_no, payload) from (org_name, pay_year, avg_pay_text) rows.

    Items of a year are spread over ceil(n/page_size) pages by a hash of the
    name; a requested year without items (the year after the last one) gets
    the API's no-data response.
    """
    per_year = items.groupBy("pay_year").agg(F.count(F.lit(1)).alias("n_year"))
    pages = F.greatest(F.ceil(F.col("n_year") / F.lit(page_size)), F.lit(1)).cast("bigint")
    # one row per calendar year: bounded by the calendar, not the data
    paged = (items.join(F.broadcast(per_year), "pay_year")
                  .withColumn("page_no", hash_bucket(F.col("org_name"), pages) + 1))
    item_xml = F.concat(F.lit("<item>"), _el("ENT_NAME", F.col("org_name")),
                        _el("N_SUM", F.col("avg_pay_text")), F.lit("</item>"))
    body = (paged.groupBy("pay_year", "page_no")
                 .agg(F.concat_ws("", F.collect_list(item_xml)).alias("items_xml"),
                      F.max("n_year").alias("total")))
    ok = body.select(
        "pay_year", "page_no",
        F.concat(F.lit(f"<response><header><resultCode>{API_OK_CODES[0]}</resultCode><resultMsg>"
                       f"{API_OK_MSG}</resultMsg></header><body><items>"), F.col("items_xml"),
                 F.lit(f"</items><numOfRows>{page_size}</numOfRows><pageNo>"), F.col("page_no").cast("string"),
                 F.lit("</pageNo><totalCount>"), F.col("total").cast("string"),
                 F.lit("</totalCount></body></response>")).alias("payload"))
    nxt = (per_year.agg((F.max("pay_year") + 1).alias("pay_year"))
                   .where(F.col("pay_year").isNotNull())
                   .select("pay_year", F.lit(1).cast("bigint").alias("page_no"),
                           F.lit(f"<response><header><resultCode>{API_NODATA[0]}</resultCode><resultMsg>"
                                 f"{API_NODATA[1]}</resultMsg></header><body><items></items>"
                                 f"<numOfRows>{page_size}</numOfRows><pageNo>1</pageNo><totalCount>0"
                                 f"</totalCount></body></response>").alias("payload")))
    return ok.unionByName(nxt)


def parsed_pay_payloads(payloads: DataFrame) -> DataFrame:
    """Each response parsed once: the payload columns plus ``x`` (header and items)."""
    return payloads.select("*", F.from_xml("payload", PAY_PAYLOAD_SCHEMA, XML_OPTS).alias("x"))


def api_status(payloads: DataFrame) -> DataFrame:
    """Result code and message per payload, and whether it is accepted.

    Read from the one parse of the response (``response/header``); the item
    count comes from the same parse.
    """
    p = parsed_pay_payloads(payloads)
    code = F.col("x.header.resultCode")
    return p.select(*payloads.columns, "x", code.alias("result_code"),
                    F.col("x.header.resultMsg").alias("result_msg"),
                    F.coalesce(code.isin(*API_OK_CODES), F.lit(False)).alias("accepted"))


def parse_pay_payloads(payloads: DataFrame) -> DataFrame:
    """S6 + F7 + F8: accepted payloads → (pay_year, org_name, amount) rows.

    One XML parse per response: rejected responses contribute an empty item
    list inside the same projection (a Filter on the parsed status would be
    pushed below it and parse the document a second time).  Items with an
    empty name/amount or an amount that does not parse are skipped, as the
    analysis does.
    """
    st = api_status(payloads)
    empty = F.array().cast("array<struct<ENT_NAME:string,N_SUM:string>>")
    gated = F.when(F.col("accepted"), F.col("x.body.items.item"))
    items = st.select("pay_year", F.inline(F.coalesce(gated, empty)))
    return (items.where(non_empty("ENT_NAME") & non_empty("N_SUM"))
                 .select("pay_year", F.col("ENT_NAME").alias("org_name"),
                         money_text_to_long("N_SUM").alias("amount"))
                 .where(F.col("amount").isNotNull()))


# news feeds (RSS XML, JSON search) -------------------------------------------
TITLE_PATTERN = "<title>([^<]*)</title>"


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, TITLE_PATTERN, 1)


def stand_in_date(page_id: Column) -> Column:
    """The date text a feed would give a page: Korean time or GMT, and some pages without a date or with none to read."""
    at = F.timestamp_seconds(F.lit(1704067200) + page_id * 5407)
    korean = F.concat(F.date_format(at + F.expr("INTERVAL 9 HOURS"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))
    gmt = F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return (F.when(page_id % 10 == 7, F.lit(None).cast("string")).when(page_id % 10 == 9, "yesterday")
            .when(page_id % 2 == 0, korean).otherwise(gmt))


def rss_payloads(pages: DataFrame, items_per_feed: int = 100) -> DataFrame:
    """(feed_no, payload): RSS documents of at most ``items_per_feed`` items."""
    item = F.concat(F.lit("<item>"), _el("title", page_title(F.col("html"))), _el("link", F.col("url")),
                    _element("pubDate", stand_in_date(F.col("page_id"))), F.lit("</item>"))
    return (pages.groupBy(F.floor(F.col("page_id") / items_per_feed).alias("feed_no"))
                 .agg(F.concat(F.lit('<rss version="2.0"><channel><title>feed</title>'),
                               F.concat_ws("", F.collect_list(item)),
                               F.lit("</channel></rss>")).alias("payload")))


def parse_rss(payloads: DataFrame) -> DataFrame:
    """Feed entries → (title, link, published)."""
    x = payloads.select(F.from_xml("payload", RSS_SCHEMA, XML_OPTS).alias("x"))
    return x.select(F.inline("x.channel.item")).select(
        "title", "link", F.col("pubDate").alias("published"))


def news_json_payloads(pages: DataFrame, display: int = 30) -> DataFrame:
    """(block_no, payload): JSON search responses of at most ``display`` items."""
    item = F.struct(page_title(F.col("html")).alias("title"), F.col("url").alias("originallink"),
                    F.col("url").alias("link"), F.col("html").alias("description"),
                    stand_in_date(F.col("page_id")).alias("pubDate"))
    return (pages.groupBy(F.floor(F.col("page_id") / display).alias("block_no"))
                 .agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload")))


def parse_news_json(payloads: DataFrame) -> DataFrame:
    """``items[]`` of a search response → rows."""
    x = payloads.select(F.from_json("payload", NEWS_JSON_SCHEMA).alias("x"))
    return x.select(F.inline("x.items"))
