"""A star schema that grows by loads: stable keys, new facts only, roll-ups from the delta.

Every table is a snapshot table, and each load has a number. A load that fails
midway can be run again, and one that was done changes nothing:

- Members get keys once. New ones are found by anti-join and numbered after the
  greatest stored key, in sorted order.
- Facts are known by link. Stored ones stay as they are; new ones get numbers
  after the greatest stored one and carry the number of their load.
- Roll-ups are partial aggregates that can be added up (counts, sums, least and
  greatest). A load adds the partials of its own facts, and the roll-up's
  manifest remembers the load, so none is added twice.

Facts are never read for a roll-up but those of the load, and the registry of a
dimension is read for its new members only, so a load costs what it brings, and
an anti-join against the stored links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.dates import parse_date
from quillmesh.operators import star
from quillmesh.operators.incremental import first_seen, link_key
from quillmesh.session import durable
from quillmesh.sources.snapshots import Table

ROLLUP_BY = ["Year", "Quarter", "Source_Key"]


def assign_keys(table: Table, members: DataFrame, columns: list[str], name: str, first: int, batch: tuple[str, int] | None = None) -> DataFrame:
    """The registry with a key for every member; those stored keep theirs."""
    new = members.select(*columns).distinct()
    if table.exists():
        stored = table.read()
        same = [new[c].eqNullSafe(stored[c]) for c in columns]
        new = new.join(stored, same, "left_anti")
        first = (stored.agg(F.max(name)).first()[0] or first - 1) + 1
    table.append(star.numbered(new, name, columns, first).select(name, *columns), batch)
    return table.read()


class GrowingStar:
    """Sources, facts and roll-ups under one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.sources, self.facts, self.rollup = (Table(spark, f"{path}/{n}") for n in ("Dim_Source", "Fact_Document", "Rollup"))

    def load(self, articles: DataFrame, number: int) -> None:
        """Articles (date, source, headline, body, link, sentiment); of those with one link the first by date and headline counts."""
        batch = ("load", number)
        if self.sources.exists() and self.rollup.exists() and self.rollup.manifest()["batches"].get("load", -1) >= number:
            return
        names = articles.select(F.trim("source").alias("Source_Name")).where(star.valid_source(F.col("Source_Name")))
        registry = assign_keys(self.sources, names, ["Source_Name"], "Source_Key", 1)
        sources = registry.select(F.col("Source_Key").cast("int").alias("Source_Key"), "Source_Name", star.source_type(F.col("Source_Name")).alias("Source_Type"))

        fresh = first_seen(articles.withColumn("link", link_key(F.col("link"))).where("link != ''"), F.col("link"), ["date", "headline"])
        start = star.FIRST_FACT
        if self.facts.exists():
            stored = self.facts.read()
            fresh = fresh.join(stored.select(F.col("News_Link").alias("link")), "link", "left_anti")
            start = (stored.agg(F.max("Fact_ID")).first()[0] or start - 1) + 1
        fresh = durable(fresh.withColumn("_day", parse_date(F.col("date"))))
        keys = star.numbered(fresh.select("_day", "link"), "Fact_ID", ["_day", "link"], start)
        rows = star.fact_columns(fresh.drop("_day").join(keys.select("Fact_ID", "link"), "link"), sources)
        self.facts.append(rows.withColumn("Load_Number", F.lit(number).cast("long")), batch)

        delta = self._partials(self.facts.read().where(F.col("Load_Number") == number))
        if self.rollup.exists():
            delta = self._added(self.rollup.read().unionByName(delta))
        self.rollup.replace(delta, batch)

    @staticmethod
    def _partials(facts: DataFrame) -> DataFrame:
        value = F.col("Sentiment_Score")
        return facts.groupBy(*ROLLUP_BY).agg(F.count("*").alias("documents"), F.count(value).alias("scored"), F.coalesce(F.sum(value), F.lit(0.0)).alias("score_sum"), F.min("Date_Key").alias("first_day"), F.max("Date_Key").alias("last_day"))

    @staticmethod
    def _added(partials: DataFrame) -> DataFrame:
        return partials.groupBy(*ROLLUP_BY).agg(*[F.sum(c).alias(c) for c in ("documents", "scored", "score_sum")], F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))

    def totals(self, by: list[str]) -> DataFrame:
        """Roll-ups by fewer columns, from the stored partials alone."""
        p = self.rollup.read()
        return p.groupBy(*by).agg(F.sum("documents").alias("documents"), F.round(F.try_divide(F.sum("score_sum"), F.sum("scored")), 6).alias("mean_score"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
