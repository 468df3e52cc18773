"""Secret scans with SQL functions only: fixed patterns, then two character models.

Base patterns (assignments, access keys, hex runs) are located in code points by
cutting the text at the pattern and adding up the lengths of what lies between.
Two first-order character Markov models, one of random strings and one of
ordinary identifiers, are trained from labelled samples: values that the base
patterns caught in any text, against short tokens (2 to 15 characters, outside
assignments) of the whole texts of about `sample_docs` documents, which a hash
chooses from all of them, together with `seeds` generated samples of each label (digests in base 64; common words in camel case, joined by a
mark or nothing, in capitals, with versions and dates, as paths, some with a
number at the end, some numbers and rulers). Long
tokens, which are what is judged, train neither model. The corpus weighs at most
SHARES times as much as the generated samples, so that it can't drown them.
Every long token outside base spans is scored, whatever characters it holds, and
is a secret of kind `model` if its log-likelihood ratio is at least `min_llr`.

The models are tables over a fixed alphabet (at most 68 x 68 counts a label), so
what reaches the driver doesn't grow with the corpus. Everything else is
row-local, and only bigram counts are shuffled, after partial aggregation.

Edge cases: a null text is empty; texts without matches have empty lists; matches
that are too short use up their characters and are dropped; repeated and null
doc_ids give a row each; an empty table gives no rows (the generated samples
alone train the models); extra columns don't matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.common import keep

#: fixed patterns, in the order in which kinds are listed; the group is the value, with its least length
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24)]
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
#: tokens too short to be judged, if the character after them is known
SHORT = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{2,15}(?=[^A-Za-z0-9+/_=-])"
SAMPLE_DOCS = 20_000
#: most weight of the corpus against the generated samples, by label (0 ordinary, 1 random)
SHARES = (10.0, 1.0)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1
#: fixed word list for generated ordinary identifiers
WORDS = "get set user account name list index value count total order item price date time file path read write open close start stop load save data table row column key map filter sort merge split join send receive message queue event handler config option default server client request response header body parse format print update delete insert select create find search match result error status state level size width height".split()


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches as array<struct<start,end,value>> in code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value"))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("spans"))

    return F.when(F.size(hits) > 0, F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda done: done["spans"])).otherwise(none)


def _named(kind: int, least: int, column: str) -> Column:
    long = F.filter(column, lambda s: F.length(s["value"]) >= least)
    return F.transform(long, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))


def base_spans(docs: DataFrame, share: float = 1.0) -> DataFrame:
    """doc_id, base, tokens (those that overlap no base span) and short (ordinary samples, of a share of the rows) per row."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))
    found = found.select("doc_id", *[located(F.col("text"), pattern, group).alias(f"k{i}") for i, (_, pattern, group, _) in enumerate(KINDS)], located(F.col("text"), TOKEN).alias("tokens"), F.when(chosen, F.regexp_extract_all(F.regexp_replace("text", ASSIGN, " "), F.lit(SHORT), F.lit(0))).alias("short"))
    found = found.select("doc_id", F.array_sort(F.concat(*[_named(i, least, f"k{i}") for i, (_, _, _, least) in enumerate(KINDS)])).alias("base"), "tokens", "short")
    apart = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return found.select("doc_id", "base", apart.alias("tokens"), "short")


def seed_samples(spark: SparkSession, seeds: int) -> DataFrame:
    """Generated samples: value and label (1 random, 0 ordinary)."""
    ids = spark.range(seeds)
    words = F.array(*[F.lit(w) for w in WORDS])

    def word(n: int) -> Column:
        return F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(n)), F.lit(len(WORDS))) + 1).cast("int"))

    digest = F.substring(F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))), 1, 32)
    camel = F.concat(word(1), F.initcap(word(2)), F.initcap(word(3)), F.initcap(word(4)))
    marks = F.array(*[F.lit(m) for m in "_-/=+"])
    joined = F.replace(F.concat_ws("_", word(1), word(2), word(3), word(4)), F.lit("_"), F.element_at(marks, (F.col("id") / 2).cast("int") % 5 + 1))
    day = F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") * 7 % 5000).cast("int")), "yyyy-MM-dd")
    dashed = F.concat_ws("-", word(1), word(2), F.when(F.col("id") % 4 < 2, F.concat(F.lit("v"), (F.col("id") % 10).cast("string"), F.lit("-"), (F.col("id") % 30).cast("string"))).otherwise(day))
    shapes = [camel, joined, F.upper(joined), dashed, F.concat(F.lit("/"), F.concat_ws("/", word(1), word(2), word(3))), F.concat(word(1), word(2), word(3), word(4))]
    plain = F.concat(F.element_at(F.array(*shapes), (F.col("id") % 6 + 1).cast("int")), F.when(F.col("id") % 9 == 0, (F.col("id") % 100).cast("string")).otherwise(""))
    ruler = F.repeat(F.element_at(marks, (F.col("id") / 20).cast("int") % 5 + 1), 20)
    number = F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**16)).cast("string"), 16, "0")
    plain = F.when(F.col("id") % 20 == 19, ruler).when(F.col("id") % 20 == 9, number).otherwise(plain)
    return ids.select(digest.alias("value"), F.lit(1).alias("label")).union(ids.select(plain, F.lit(0)))


def train(samples: DataFrame) -> list[float]:
    """Log ratios of transition probabilities by SIZE * before + after, from (value, label) rows.

    Rows may tell generated samples by a column `made`; the others then weigh at most SHARES times as much.
    """
    if "made" not in samples.columns:
        samples = samples.withColumn("made", F.lit(True))
    pairs = F.expr(f"transform(sequence(1, length(value)), i -> {SIZE} * if(i = 1, 0, locate(substring(value, i - 1, 1), '{ALPHABET}')) + locate(substring(value, i, 1), '{ALPHABET}'))")
    counts = samples.where("length(value) > 0").select("label", "made", F.explode(pairs).alias("pair")).groupBy("label", "made", "pair").count()
    rows, total = counts.collect(), {}  # at most 4 * SIZE * SIZE rows
    for label, made, _, n in rows:
        total[label, made] = total.get((label, made), 0) + n
    seen: list[dict[int, float]] = [{}, {}]
    for label, made, pair, n in rows:
        weight = 1.0 if made or (label, True) not in total else min(1.0, SHARES[label] * total[label, True] / total[label, False])
        seen[label][pair] = seen[label].get(pair, 0.0) + weight * n
    out = [0.0] * (SIZE * SIZE)
    for before in range(SIZE):
        rows = [[s.get(SIZE * before + after, 0) + 0.5 for after in range(SIZE)] for s in seen]
        totals = [sum(r) for r in rows]
        for after in range(SIZE):
            out[SIZE * before + after] = math.log(rows[1][after] / totals[1]) - math.log(rows[0][after] / totals[0])
    return out


def log_ratio(table: list[float], value: str) -> str:
    """SQL for the log-likelihood ratio of a token, random against ordinary."""
    array = f"cast(split('{','.join(f'{x:.6f}' for x in table)}', ',') as array<double>)"
    code = f"{SIZE} * if(i = 1, 0, locate(substring({value}, i - 1, 1), '{ALPHABET}')) + locate(substring({value}, i, 1), '{ALPHABET}')"
    return f"aggregate(sequence(1, length({value})), 0D, (sum, i) -> sum + element_at({array}, 1 + {code}))"


def _is(kind: int):
    return lambda span: span["kind"] == kind


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS], F.lit("model"))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, min_llr: float = 12.0, seeds: int = 2000, samples: DataFrame | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_model, base_sha256, spans, and found (array of start, kind, end, value).

    samples: labelled (value, label) rows to train from instead of the corpus and the seeds.
    sample_docs: about how many documents give ordinary samples, the bound of the training sample.
    """
    spark = docs.sparkSession
    share = 0.0 if samples is not None else min(1.0, sample_docs / max(1, docs.count()))
    rows = keep(base_spans(docs, share), "secrets")
    if samples is None:
        caught = rows.select(F.explode("base.value").alias("value")).select(F.regexp_extract("value", "^[A-Za-z0-9+/_=-]+", 0).alias("value"), F.lit(1).alias("label"))
        others = rows.select(F.explode("short").alias("value")).select("value", F.lit(0).alias("label"))
        samples = caught.union(others).withColumn("made", F.lit(False)).union(seed_samples(spark, seeds).withColumn("made", F.lit(True)))
    table = train(samples)
    scored = rows.select("doc_id", "base", "tokens")
    values = F.expr(f"transform(tokens, t -> named_struct('t', t, 'llr', {log_ratio(table, 't.value')}))")
    scored = scored.select("doc_id", "base", F.when(F.size("tokens") > 0, values).alias("scored"))
    kind = len(KINDS)
    extra = F.transform(F.filter("scored", lambda s: s["llr"] >= min_llr), lambda s: F.struct(s["t"]["start"].alias("start"), F.lit(kind).alias("kind"), s["t"]["end"].alias("end"), s["t"]["value"].alias("value")))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,value:string>>)")
    scored = scored.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce(extra, none))).alias("found"))
    counts = [F.size(F.filter("found", _is(i))).cast("long").alias(f"n_{name}") for i, name in enumerate([k[0] for k in KINDS] + ["model"])]
    return scored.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("found").alias("spans"), "found")


def op2(spark, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
