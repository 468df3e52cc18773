"""Token counts by a linear longest-match automaton.

The vocabulary becomes one trie with two roots: pieces that begin a word and
pieces that continue one. Each node has a failure link and the number of pieces
that are final when the link is taken, so the greedy longest-match-first length
of a word is found in one pass over its characters and no piece is ever built
(Song et al., "Fast WordPiece Tokenization", 2021). Word-initial pieces are
those that begin with the model's space mark.

Words are the runs of `[^\\x20\\x09-\\x0D]`. A word that cannot be matched to its end
counts as one unknown token. The counts are those of greedy matching; a merge
(BPE) encoder over the same vocabulary, such as sentencepiece_fst, cuts some words
otherwise and encodes unknown ones as bytes, so its counts differ a little.

Edge cases: null and empty texts have no words and no tokens; repeated and null
doc_ids give a row each; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillmesh.llm.common import Memo, scan, state, texts
from quillmesh.llm.pieces import MODEL, NORMAL, SPACE, Pieces, read_model

MEMO_BYTES = 48_000_000


class LongestMatch:
    """Trie with failure links; `length(word)` is 0 for a word that has no segmentation."""

    def __init__(self, first: list[str], later: list[str]) -> None:
        self.kids: list[dict[str, int]] = [{}, {}]  # node 0 begins a word, node 1 continues one
        ends: set[int] = set()
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.kids[node]:
                        self.kids[node][c] = len(self.kids)
                        self.kids.append({})
                    node = self.kids[node][c]
                if piece:
                    ends.add(node)
        self.link: list[int] = [-1] * len(self.kids)
        self.pops: list[int] = [0] * len(self.kids)
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for c, kid in self.kids[node].items():
                    below.append(kid)
                    if kid in ends:
                        self.link[kid], self.pops[kid] = 1, 1
                        continue
                    z, popped = self.link[node], self.pops[node]
                    while z >= 0 and c not in self.kids[z]:
                        popped += self.pops[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[kid], self.pops[kid] = self.kids[z][c], popped
            level = below

    def length(self, word: str) -> int:
        kids, link, pops = self.kids, self.link, self.pops
        node = count = 0
        for c in word:
            while (kid := kids[node].get(c)) is None:
                if link[node] < 0:
                    return 0
                count += pops[node]
                node = link[node]
            node = kid
        while node > 1:
            if link[node] < 0:
                return 0
            count += pops[node]
            node = link[node]
        return count


def split_vocabulary(model: Pieces) -> tuple[list[str], list[str]]:
    """Pieces that begin a word (without the mark) and pieces that continue one."""
    normal = [p for p, _, kind in model.pieces if kind == NORMAL]
    return [p[1:] for p in normal if p[0] == SPACE and p[1:] and SPACE not in p[1:]], [p for p in normal if SPACE not in p]


def token_counts(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown per row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(split_vocabulary(read_model(model_path)))

    def build() -> Memo:
        automaton = LongestMatch(*shared.value)
        return Memo(lambda w: automaton.length(w.decode("utf-8", "replace")), MEMO_BYTES)

    def make():
        length = state(("token_counts", model_path), build).__getitem__

        def work(c: dict[str, list]) -> dict[str, list]:
            words, tokens, unknown = [], [], []
            for text in c["text"]:
                got = list(map(length, (text or b"").split()))
                lost = got.count(0)
                words.append(len(got))
                tokens.append(sum(got) + lost)
                unknown.append(lost)
            return {"doc_id": c["doc_id"], "n_words": words, "n_tokens": tokens, "n_unknown": unknown}

        return work

    return scan(texts(docs), make, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op5(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
