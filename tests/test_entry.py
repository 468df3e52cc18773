import subprocess
import sys

import duckdb
import pytest
from helpers import ROOT, SF

import __spark_entry__ as entry
from quillmesh.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = [
    "norm_text", "tag_confidence", "fact_document", "source_code_ids", "entity_cascade", "relevance_score", "html_paragraphs", "html_title",
    "stream_dedup_available_now", "stream_windowed", "star_grouping_sets", "upsert_by_key", "sentiment_overlay", "mention_count",
    "tag_definitions", "known_companies", "article_entities", "vocab_indexes", "feed_fields", "feed_collect", "feed_scrape", "sitemap_collect",
    "source_links", "link_hash", "company_fuzzy", "company_enrich", "market_articles", "csv_star_fact", "csv_star_entities",
    "consolidate_text", "first_index_substring", "literal_keywords", "lemmatised_text", "vader_like_sentiment", "source_bodies", "dim_tag", "keyword_variations", "individual_tag_split",
    "table_upsert", "star_load_facts", "star_load_rollup", "stream_upsert_latest", "stream_status", "sitemap_walk", "csv_rejects", "paged_orders", "queue_drain", "hybrid_feed",
]


def canonical(rows):
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"select {', '.join(columns)} from ({catalog.ORACLES[name]})").fetchall()
    assert canonical(map(tuple, df.select(*columns).collect())) == canonical(want)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_optional_part():
    """The rest imports and lists its queries when the llm folder and the pipeline are gone."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("quillmesh.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "norm_text" in e.queries() and not any(n.startswith("op") for n in e.queries()), e.queries()
"""
    subprocess.run([sys.executable, "-c", code], check=True)
