"""The rules of op7 are learned from labels of the documents that the pages show."""

from pyspark.sql import functions as F

from clearlot.llm import html_extract, url_filter
from clearlot.llm.queries import QUERIES, URL_RULES, labelled_pages
from tests.llm import brute


def runs(text):
    words = brute.WORD.findall(text)
    return {tuple(words[at : at + 6]) for at in range(len(words) - 5)}


def test_labelled_page_and_document_share_their_text(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shown = {row.page_id: row.doc_id for row in labelled_pages(pages, labels).collect()}
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    shares = []
    for row in pages.collect():
        found = runs(" ".join(html_extract.main_lines(row.html or "")))
        if row.page_id in shown and len(found) >= 20:
            shares.append(len(found & runs(texts[shown[row.page_id]])) / len(found))
    assert len(shares) >= 20 and min(shares) > 0.8


def test_numbers_of_paths(spark):
    urls = ["http://a.b/en/7", "http://a.b/en/7/", "http://a.b/en/7.html?page=3&ref=x", "http://a.b/en/7#top", None, "",
            "http://a.b/en/7/x", "http://a.b/en/x7", "http://a.b/7", "http://a.b/en/?id=7", "http://a.b/en/" + "7" * 40]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(7, "block"), (0, "allow"), (None, "allow")], "doc_id long, verdict string")
    made = labelled_pages(pages, labels).collect()
    assert sorted((row.page_id, row.doc_id, row.verdict) for row in made) == [(n, 7, "block") for n in range(4)]


def test_query_learns_from_the_documents_shown(spark, folder):
    number = r"^/[^/]+/([0-9]+)"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    taught = pages.withColumn("doc_id", F.regexp_extract(url_filter.path_of(pages.url), number, 1).cast("long"))
    taught = taught.join(labels, "doc_id").selectExpr(
        "page_id AS id", "CASE WHEN quality = 0 OR toxic = 1 THEN 'block' ELSE 'allow' END AS verdict"
    )
    want = url_filter.judge_urls(pages, taught, URL_RULES)
    assert sorted(map(tuple, QUERIES["op7_url_filter"](spark, folder).collect())) == sorted(map(tuple, want.collect()))
