"""Word tables inside expressions: a look-up costs one hash, whatever the number of words."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_WORDS = 200_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), 0)


class Words:
    """Words with a value each, as a constant of buckets by crc32; at most MAX_WORDS."""

    def __init__(self, words: dict[str, object], kind: str) -> None:
        if len(words) > MAX_WORDS:
            raise ValueError(f"{len(words)} words; tables of more than {MAX_WORDS} are joined")
        self.size = 1 << max(0, len(words) - 1).bit_length()
        buckets: list[list] = [[] for _ in range(self.size)]
        for word, value in words.items():
            buckets[zlib.crc32(word.encode()) % self.size].append({"w": word, "v": value})
        self.table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<w:string,v:{kind}>>>")

    def __getitem__(self, word: Column) -> Column:
        """The word's value, null if it has none."""
        found = F.filter(F.get(self.table, (F.crc32(word.cast("binary")) % self.size).cast("int")), lambda x: x["w"] == word)
        return F.get(found, 0)["v"]


def numbers(words: dict[str, float]) -> Words:
    return Words({w: float(v) for w, v in words.items()}, "double")
