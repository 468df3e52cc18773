"""Entity resolution: dedup, canonical names, registry validation, bridge cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.entities import bridge_name, normalize_entity, registry_name


def best_entities(found: DataFrame, key: str) -> DataFrame:
    """Of one document's names with one normal form: highest confidence, then longest, then first by name.

    Mentions are the most that any of them had.
    """
    n = found.withColumn("norm", normalize_entity(F.col("name"))).where("norm != ''")
    best = F.min_by(F.struct("name", "confidence"), F.struct(-F.col("confidence"), -F.length("name"), F.col("name")))
    return n.groupBy(key, "norm").agg(best.alias("b"), F.max("mentions").alias("mentions")).select(key, "norm", "b.name", "b.confidence", "mentions")


def canonical_names(names: DataFrame, column: str) -> DataFrame:
    """norm, canonical: the longest name of each normal form, one with a space first, then by name."""
    n = names.select(F.trim(column).alias("name")).distinct().withColumn("norm", normalize_entity(F.col("name"))).where("norm != ''")
    return n.groupBy("norm").agg(F.min_by("name", F.struct(-F.length("name"), ~F.contains("name", F.lit(" ")), "name")).alias("canonical"))


def with_override(found: DataFrame, overrides: DataFrame, name: str = "name") -> DataFrame:
    """Manual canonical names (variant, canonical) win with confidence 1.0."""
    o = overrides.select(F.lower("variant").alias("_v"), F.col("canonical").alias("_c"))
    return found.join(o, F.lower(F.trim(name)) == F.col("_v"), "left").withColumn("confidence", F.when(F.col("_c").isNotNull(), 1.0).otherwise(F.col("confidence"))).withColumn(name, F.coalesce("_c", name)).drop("_v", "_c")


def resolve(names: DataFrame, dim: DataFrame, column: str = "name") -> DataFrame:
    """names with Entity_Key: exact name, else without endings, else by first word.

    Normal forms keep the last key; of several names with one first word a
    one-word name takes the shortest, another the first key.
    """
    d = dim.select("Entity_Key", F.trim("Entity_Name").alias("_name")).withColumn("_norm", bridge_name(F.col("_name"))).withColumn("_core", F.split("_norm", r"\s+")[0])
    exact = d.groupBy(F.col("_name").alias("_n1")).agg(F.max("Entity_Key").alias("_k1"))
    norm = d.groupBy(F.col("_norm").alias("_n2")).agg(F.max("Entity_Key").alias("_k2"))
    core = d.where("_core != ''").groupBy(F.col("_core").alias("_n3")).agg(F.min_by("Entity_Key", F.struct(F.length("_name"), "Entity_Key")).alias("_shortest"), F.min("Entity_Key").alias("_first"))
    low = F.rtrim(F.lower(F.trim(column)), F.lit("'\".,;: "))
    words = F.split(low, r"\s+")
    n = names.withColumn("_b", bridge_name(F.col(column))).withColumn("_c", words[0]).withColumn("_w", F.size(words))
    out = n.join(exact, n[column] == F.col("_n1"), "left").join(norm, F.col("_b") == F.col("_n2"), "left").join(core, F.col("_c") == F.col("_n3"), "left")
    key = F.coalesce("_k1", "_k2", F.when(F.col("_w") == 1, F.col("_shortest")).otherwise(F.col("_first")))
    return out.withColumn("Entity_Key", key).select(*names.columns, "Entity_Key")


def rejected(names: DataFrame, column: str, reason: str = "Not in company list") -> DataFrame:
    """Rejected names with their number of occurrences."""
    return names.groupBy(F.col(column).alias("Rejected_Entity")).agg(F.count("*").alias("Occurrence_Count")).withColumn("Reason", F.lit(reason))


def registry_keys(registry: DataFrame) -> DataFrame:
    """norm and the first registry row of each normal form; registry: name, ticker, source and maybe cik."""
    r = _with_cik(registry).withColumn("_norm", registry_name(F.col("name"))).where("_norm != ''")
    return r.groupBy("_norm").agg(F.min_by(F.struct("name", "ticker", "source", "cik"), F.struct("source", "name", "ticker")).alias("hit"))


def _with_cik(registry: DataFrame) -> DataFrame:
    return registry if "cik" in registry.columns else registry.withColumn("cik", F.lit(None).cast("string"))


def enrich(names: DataFrame, registry: DataFrame, column: str = "name") -> DataFrame:
    """input, validated, canonical_name, ticker, source, cik by normal form, else by ticker."""
    registry = _with_cik(registry)
    by_name = registry_keys(registry)
    by_ticker = registry.where("ticker is not null").groupBy(F.upper("ticker").alias("_t")).agg(F.min_by(F.struct("name", "ticker", "source", "cik"), F.struct("source", "name", "ticker")).alias("hit2"))
    out = names.select(F.col(column).alias("input")).withColumn("_n", registry_name(F.col("input")))
    out = out.join(by_name, F.col("_n") == F.col("_norm"), "left").join(by_ticker, F.upper(F.trim("input")) == F.col("_t"), "left")
    hit = F.coalesce("hit", "hit2")
    return out.select("input", hit.isNotNull().alias("validated"), hit["name"].alias("canonical_name"), hit["ticker"].alias("ticker"), hit["source"].alias("source"), hit["cik"].alias("cik"))


def _substrings(c: Column) -> Column:
    """All substrings of a short string, each once."""
    n = F.length(c)
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substring(c, i, k)))
    return F.array_distinct(F.flatten(parts))


def fuzzy_valid(names: DataFrame, registry: DataFrame, column: str = "name") -> DataFrame:
    """names with valid: the normal form or ticker is registered, or one of two normal forms holds the other.

    Names are short, so the substrings of each different form are joined by
    equality; no name is tried against every other. Blank forms match nothing.
    """
    forms = registry.select(registry_name(F.col("name")).alias("_k")).where("_k != ''").distinct()
    tickers = registry.select(F.lower("ticker").alias("_k")).where("_k is not null and _k != ''")
    n = names.withColumn("_n", registry_name(F.col(column)))
    mine = n.select("_n").where("_n != ''").distinct()
    inside = mine.select("_n", F.explode(_substrings(F.col("_n"))).alias("_k")).join(forms, "_k", "left_semi").select("_n")
    around = forms.select(F.explode(_substrings(F.col("_k"))).alias("_n")).join(mine, "_n", "left_semi")
    listed = mine.join(tickers, mine["_n"] == tickers["_k"], "left_semi")
    good = inside.union(around).union(listed).distinct().withColumn("_v", F.lit(True))
    return n.join(good, "_n", "left").select(*names.columns, F.coalesce("_v", F.lit(False)).alias("valid"))


def split_valid(names: DataFrame, registry: DataFrame, column: str = "name") -> tuple[DataFrame, DataFrame]:
    """Names whose normal form or ticker is registered, and the others."""
    known = registry.select(registry_name(F.col("name")).alias("_k")).union(registry.select(F.lower("ticker"))).where("_k is not null and _k != ''").distinct()
    n = names.withColumn("_k", registry_name(F.col(column)))
    return n.join(known, "_k", "left_semi").drop("_k"), n.join(known, "_k", "left_anti").drop("_k")
