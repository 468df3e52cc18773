"""Sentiment of text by the published rules of a valence lexicon, as one expression.

A word's valence comes from the lexicon (an input; the industry overlay is part
of the fixed values and wins). What stands around it changes it:

- capitals, where a text is not all capitals, add 0.733;
- boosters and dampers up to three words before add or take 0.293, weaker with
  distance (0.95, 0.9);
- negations up to three words before turn it by -0.74; 'never so' and 'never
  this' strengthen by 1.25, 'without doubt' leaves it;
- 'no' before a word of the lexicon turns that word and has no valence itself;
- 'least' turns it unless 'at' or 'very' stands before;
- fixed idioms have valences of their own.

Then words before the first 'but' count half and those after it one and a half
times; up to four exclamation marks add 0.292 each, two or three question marks
0.18 each and more 0.96; the sum s becomes s / sqrt(s * s + 15), in four digits.
Signs for faces are words like others; pictographs are not spelled out.

Edge cases: null and blank texts score 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.lookup import Words, let, numbers

CAPITALS, TURN = 0.733, -0.74
DISTANCE = (1.0, 0.95, 0.9)
#: string.punctuation of the published tokenizer
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: first words of all idioms and boosters of several words
OPENINGS = tuple(sorted({p.split(" ")[0] for p in [*fixed.IDIOMS, *fixed.BOOSTERS] if " " in p}))


def _words(text: Column, table: Words) -> Column:
    """Array of (raw, low, of): the word, lower case, its (valence, boost) or null."""

    def word(token: Column) -> Column:
        marked = F.substring(token, 1, 1).isin(*PUNCTUATION) | F.substring(token, -1, 1).isin(*PUNCTUATION)
        bare = F.trim(token, F.lit(PUNCTUATION))
        return F.when(marked & (F.length(bare) > 2), bare).otherwise(token)

    tokens = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    low = F.transform(F.transform(tokens, word), lambda w: F.struct(w.alias("raw"), F.lower(w).alias("low")))
    return F.transform(low, lambda w: F.struct(w["raw"].alias("raw"), w["low"].alias("low"), table[w["low"]].alias("of")))


def _loud(word: Column) -> Column:
    """Whether a word is in capitals."""
    return (word["low"] != word["raw"]) & (F.upper(word["raw"]) == word["raw"])


def _known(word: Column) -> Column:
    return word["of"]["valence"]


def _any(word: Column, values) -> Column:
    return F.coalesce(word.isin(*values), F.lit(False))


def _valence(words: Column, w: Column, i: Column, mixed: Column, weight: Column, boosts: Words, idioms: Words) -> Column:
    """The valence of word i of words, times its weight."""

    def place(k: int) -> Column:
        return F.get(words, i + k) if k >= 0 else F.when(i + k >= 0, F.get(words, F.greatest(i + k, F.lit(0))))

    around = F.struct(*[place(k).alias(f"w{k + 3}") for k in range(-3, 3)])
    return F.when(_known(w).isNull() | w["of"]["boost"].isNotNull(), 0.0).otherwise(let(around, lambda words: _among(words, i, mixed, boosts, idioms) * weight))


def _among(words: Column, i: Column, mixed: Column, boosts: Words, idioms: Words) -> Column:
    """The valence of word i, a word of the lexicon, among those from i - 3 to i + 2."""

    def at(k: int) -> Column:
        return words[f"w{k + 3}"]

    def low(k: int) -> Column:
        return at(k)["low"]

    def negative(k: int) -> Column:
        return _any(low(k), fixed.NEGATIONS) | F.coalesce(F.contains(low(k), F.lit("n't")), F.lit(False))

    def sign(v: Column, x: Column) -> Column:
        return F.when(v > 0, x).otherwise(-x)

    no, known, loud = low(0) == "no", _known(at(0)), _loud(at(0))
    after_no = (low(-1) == "no") | (low(-2) == "no") | ((low(-3) == "no") & low(-1).isin("or", "nor"))
    value = F.when(no & _known(at(1)).isNotNull(), 0.0).when(F.coalesce(after_no, F.lit(False)), known * TURN).otherwise(known)
    value = let(value, lambda v: F.when(loud & mixed, v + sign(v, F.lit(CAPITALS))).otherwise(v))

    def near(v: Column, k: int) -> Column:
        """What the word k before does; it does nothing if the lexicon has it."""
        before = at(-k)
        boost = before["of"]["boost"]
        scaled = F.when(v < 0, -boost).otherwise(boost)
        scaled = F.when(_loud(before) & mixed, scaled + sign(v, F.lit(CAPITALS))).otherwise(scaled)
        v2 = F.when(boost.isNull(), v).otherwise(v + scaled * DISTANCE[k - 1])
        if k == 1:
            turned = F.when(negative(-1), TURN).otherwise(1.0)
        elif k == 2:
            never = (low(-2) == "never") & low(-1).isin("so", "this")
            turned = F.when(never, 1.25).when((low(-2) == "without") & (low(-1) == "doubt"), 1.0).when(negative(-2), TURN).otherwise(1.0)
        else:
            never = ((low(-3) == "never") & low(-2).isin("so", "this")) | low(-1).isin("so", "this")
            turned = F.when(never, 1.25).when((low(-3) == "without") & ((low(-2) == "doubt") | (low(-1) == "doubt")), 1.0).when(negative(-3), TURN).otherwise(1.0)
        v3 = v2 * turned
        if k == 3:
            v3 = let(v3, lambda v: F.when(reduce(lambda a, b: a | b, [_any(low(p), OPENINGS) for p in range(-3, 1)]), idiom(v)).otherwise(v))
        return F.when(before.isNotNull() & _known(before).isNull(), v3).otherwise(v)

    def phrase(*places: int) -> Column:
        return F.concat(*[x for k in places for x in (F.lit(" "), low(k))][1:])

    def idiom(v: Column) -> Column:
        back = F.coalesce(*[idioms[phrase(*p)] for p in ((-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2))], v)
        ahead = F.coalesce(idioms[phrase(0, 1, 2)], idioms[phrase(0, 1)], back)
        return reduce(lambda a, p: a + F.coalesce(boosts[phrase(*p)], F.lit(0.0)), [(-3, -2, -1), (-3, -2), (-2, -1)], ahead)

    value = let(let(let(value, lambda v: near(v, 1)), lambda v: near(v, 2)), lambda v: near(v, 3))
    least = (low(-1) == "least") & _known(at(-1)).isNull() & ((i == 1) | ~low(-2).isin("at", "very"))
    value = let(value, lambda v: F.when(F.coalesce(least, F.lit(False)), v * TURN).otherwise(v))
    return F.when((low(0) == "kind") & F.coalesce(low(1) == "of", F.lit(False)), 0.0).otherwise(value)


def compound(text: Column, lexicon: dict[str, float] | None = None) -> Column:
    """Score from -1 to 1 of a text; the overlay wins over the lexicon."""
    known = {w.lower(): float(v) for w, v in (dict(lexicon or {}) | fixed.VALENCES).items()}
    table = Words({w: {"valence": known.get(w), "boost": fixed.BOOSTERS.get(w)} for w in known | fixed.BOOSTERS}, "struct<valence:double,boost:double>")
    boosts, idioms = numbers(fixed.BOOSTERS), numbers(fixed.IDIOMS)

    def score(words: Column) -> Column:
        mixed = F.exists(words, lambda w: ~_loud(w))  # asked of words in capitals only
        but = F.array_position(F.transform(words, lambda w: w["low"]), "but") - 1  # -1: none

        def total(mixed: Column, but: Column) -> Column:
            weight = lambda i: F.when((but < 0) | (i == but), 1.0).when(i < but, 0.5).otherwise(1.5)
            return F.aggregate(F.transform(words, lambda w, i: _valence(words, w, i, mixed, weight(i), boosts, idioms)), F.lit(0.0), lambda a, b: a + b)

        return let(F.struct(mixed.alias("mixed"), but.alias("but")), lambda c: total(c["mixed"], c["but"]))

    def whole(t: Column) -> Column:
        marks, questions = (F.length(t) - F.length(F.replace(t, F.lit(c))) for c in "!?")
        asked = let(questions, lambda q: F.when(q <= 1, 0.0).when(q <= 3, q * 0.18).otherwise(0.96))
        emphasis = F.least(marks, F.lit(4)) * 0.292 + asked
        return let(let(_words(t, table), score), lambda s: F.when(s == 0, 0.0).otherwise(let(s + F.signum(s) * emphasis, lambda x: F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x / F.sqrt(x * x + 15))), 4))))

    return let(F.coalesce(text, F.lit("")), whole)


def overlay_sum(tokens: Column, lexicon: dict[str, float] | None = None) -> Column:
    """Plain sum of valences over an array of lower-case words, without the rules."""
    table = F.create_map(*[F.lit(x) for pair in (lexicon or fixed.VALENCES).items() for x in pair])
    return F.aggregate(tokens, F.lit(0.0), lambda s, w: s + F.coalesce(F.try_element_at(table, w), F.lit(0.0)))
