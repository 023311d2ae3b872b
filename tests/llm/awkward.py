"""Rows that every operator has to bear."""

from __future__ import annotations

import random

WORDS = "stone river lamp quiet morning copper window ladder garden winter paper candle signal harbor".split()


def prose(seed: int, words: int) -> str:
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + chance.choice(["", "", "s", "ing", "ed"]) for _ in range(words))


def awkward_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty, blank, long, repeated, equal ids with different texts."""
    base = [prose(9000, 60) + "\n" + prose(9001, 40), prose(9002, 80)]
    edited = base[0].replace("stone", "STONE").rsplit(" ", 1)[0] + " other"
    rows = [(n, prose(n, 5 + n * 3)) for n in range(20)]
    rows += [(100, base[0]), (101, base[0]), (102, edited), (103, base[1]), (103, base[1])]
    rows += [(104, None), (105, ""), (106, " \n\t "), (107, "one"), (108, "One"), (109, "é à 漢字 ñ")]
    rows += [(110, prose(77, 9000)), (None, base[1]), (None, None), (None, prose(5, 12))]
    rows += [(111, "x"), (111, "y"), (112, "\u0000 \r\n a"), (113, "ſ İ ß Σς"), (114, "tab\tsep\x0bwords here")]
    return rows


#: Names that the operators use for columns of their own.
CLASHING = ["score", "key", "hash", "line", "items", "spans", "n_words", "text_key", "bands", "hub", "kept"]
