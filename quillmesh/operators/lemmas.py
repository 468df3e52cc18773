"""Lemmas by detachment rules, an exception table and a dictionary.

A word that has exceptions takes its lemma from them; another is itself, if the
dictionary has it, or what the rules of its part of speech make of it, detached
again and again until the dictionary has something. Of several lemmas the
shortest counts, of equally short ones the first by rule. A word without lemma
stays as it is.

Only different words are looked up, by joins with the dictionary, so texts are
not shuffled for it. Back in the texts, words are replaced in place from a
constant table while the words that change are at most MAX_WORDS, and by a join
of words with places beyond that.

Edge cases: null texts are empty; white space between words becomes one space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.fixed import DETACHMENT
from quillmesh.functions.lookup import MAX_WORDS, Words
from quillmesh.session import durable


def _split(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def detached(forms: Column, pos: str) -> Column:
    """What the rules of a part of speech make of an array of forms, in order, each once."""

    def one(form: Column) -> Column:
        made = [F.when(F.endswith(form, F.lit(old)), F.concat(F.left(form, F.length(form) - len(old)), F.lit(new))) for old, new in DETACHMENT[pos]]
        return F.array_compact(F.array(*made))

    return F.array_distinct(F.filter(F.flatten(F.transform(forms, one)), lambda f: f != ""))


def lemma_table(words: DataFrame, dictionary: DataFrame, exceptions: DataFrame | None = None, pos: str = "n") -> DataFrame:
    """word, lemma of the different words (column word) that have a lemma. dictionary: word, pos; exceptions: form, pos, lemma."""
    known = durable(dictionary.where(F.col("pos") == pos).select(F.col("word").alias("form")).distinct())
    rest = words.select("word").where("word != ''").distinct()
    found = []

    def settle(candidates: DataFrame) -> DataFrame:
        rows = candidates.select("word", F.posexplode("forms").alias("place", "form")).join(known, "form")
        return rows.groupBy("word").agg(F.min_by("form", F.struct(F.length("form"), "place")).alias("lemma"))

    if exceptions is not None:
        own = exceptions.where(F.col("pos") == pos).groupBy(F.col("form").alias("word")).agg(F.array_sort(F.collect_set("lemma")).alias("lemmas"))
        found.append(settle(words.select("word").distinct().join(own, "word").where("word != ''").select("word", F.concat(F.array("word"), "lemmas").alias("forms"))))
        rest = rest.join(own, "word", "left_anti")
    made = detached(F.array("word"), pos)
    # most words end in nothing that a rule detaches: they are their own lemma or have none
    found.append(rest.where(F.size(made) == 0).join(known, F.col("word") == F.col("form")).select("word", F.col("form").alias("lemma")))
    rest = rest.where(F.size(made) > 0).select("word", F.concat(F.array("word"), made).alias("forms"))
    while True:
        rest = durable(rest)
        done = durable(settle(rest))
        found.append(done)
        rest = rest.join(done, "word", "left_anti").select("word", detached(F.col("forms"), pos).alias("forms")).where(F.size("forms") > 0)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, found)


def lemmatise(docs: DataFrame, lemmas: DataFrame, key: str = "doc_id", text: str = "text", most: int = MAX_WORDS) -> DataFrame:
    """key, text with each word between white space replaced by its lemma; key must tell rows apart."""
    changed = durable(lemmas.where("word != lemma"))
    if changed.count() <= most:
        table = Words({r.word: r.lemma for r in changed.collect()}, "string")
        return docs.select(key, F.array_join(F.transform(_split(F.col(text)), lambda w: F.coalesce(table[w], w)), " ").alias(text))
    words = docs.select(key, F.posexplode_outer(_split(F.col(text))).alias("_place", "word")).join(changed, "word", "left")
    back = words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_place", F.coalesce("lemma", "word").alias("_word")))).alias("_words"))
    return back.select(key, F.coalesce(F.array_join("_words._word", " "), F.lit("")).alias(text))
