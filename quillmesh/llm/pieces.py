"""Reading a SentencePiece model file into plain lists.

The file is read on the driver (its path is a parameter) and sent as a
broadcast of at most MAX_MODEL_BYTES; executors need no file.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import numpy as np

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64_000_000
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@dataclass
class Pieces:
    """pieces: (string, score, kind) by id; merges: whether scores are ranks of merges (BPE) and not log probabilities.

    Normaliser: rules from strings to strings (leftmost, longest first), prefix
    (a space is put first), squeeze (runs of spaces become one, outer ones go).
    """

    pieces: list[tuple[str, float, int]]
    prefix: bool
    merges: bool = True
    squeeze: bool = False
    rules: dict[str, str] = field(default_factory=dict)


def read_rules(blob: bytes) -> dict[str, str]:
    """The replacement rules of a compiled character map: a double-array trie, then its strings.

    A unit of the trie holds a label in bits 0-7 (and 31), a leaf flag in bit 8
    and the offset of its children in bits 10-30, shifted by 8 if bit 9 is set.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, strings = np.frombuffer(blob[4 : 4 + size], "<u4"), blob[4 + size :]
    labels = units & np.uint32(0x800000FF)
    every = np.arange(1, 256)

    def below(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    rules, waiting = {}, [(b"", below(int(units[0])))]
    while waiting:
        key, base = waiting.pop()
        places = base ^ every
        inside = np.flatnonzero(places < len(units))
        for i in inside[labels[places[inside]] == every[inside]].tolist():
            unit = int(units[places[i]])
            kids, longer = int(places[i]) ^ below(unit), key + bytes([i + 1])
            if unit >> 8 & 1:
                at = int(units[kids]) & 0x7FFFFFFF
                rules[longer.decode()] = strings[at : strings.index(b"\0", at)].decode()
            waiting.append((longer, kids))
    return rules


def read_bytes(path: str = MODEL) -> bytes:
    if (size := os.path.getsize(path)) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_MODEL_BYTES} are broadcast")
    with open(path, "rb") as f:
        return f.read()


def read_model(path: str = MODEL) -> Pieces:
    return parse_model(read_bytes(path))


def parse_model(data: bytes) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(data)
    norm, kind = model.normalizer_spec, model.trainer_spec.model_type
    if kind not in (1, 2):
        raise ValueError("only merge (BPE) and unigram models are compiled")
    if not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("spaces must be escaped and stand before words")
    if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces):
        raise ValueError("user-defined and unused pieces are not compiled")
    return Pieces([(p.piece, p.score, p.type) for p in model.pieces], norm.add_dummy_prefix, kind == 2, norm.remove_extra_whitespaces, read_rules(norm.precompiled_charsmap))
