"""Words of Thai text, which is written without blanks, as one pattern for all operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamra.functions.text import Rules

MOST_WORDS = 100_000  # larger than the usual word lists, whose size hangs on the language and not on the corpus
# Ranges of the Thai block.
LETTERS = r"\x{0E01}-\x{0E3A}\x{0E40}-\x{0E4E}"  # consonants, vowels and marks
DIGITS = r"\x{0E50}-\x{0E59}"
LEADING, CONSONANT, FOLLOWING = r"\x{0E40}-\x{0E44}", r"\x{0E01}-\x{0E2E}", r"\x{0E30}-\x{0E3A}\x{0E45}\x{0E47}-\x{0E4E}"
# What no dictionary word covers goes on by a cluster, which has seven characters at most.
CLUSTER = f"[{LEADING}]?[{CONSONANT}][{FOLLOWING}]{{0,5}}|[{LETTERS}]"


def word_pattern(dictionary: Sequence[str]) -> str:
    """A pattern that matches the longest dictionary word at a place: one branch per next character."""
    tree: dict = {}
    for word in dictionary:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def spell(node: dict) -> str:
        branches = [re.escape(char) + spell(node[char]) for char in sorted(node) if char]
        if not branches:
            return ""
        return f"(?:{'|'.join(branches)})" + ("?" if "" in node else "")

    return spell(tree)


def rules(dictionary: DataFrame, most: int = MOST_WORDS) -> Rules:
    """Rules that cut Thai by the words of ``dictionary`` (column ``word``) and other text as ever.

    At each place the longest dictionary word is taken, else a run of Thai digits, else one cluster
    of a consonant with its vowels and marks, so no token grows with the text. The words become one
    prefix-tree pattern: every document is cut in its own row, by native expressions, and offsets
    stay those of the text. Words with other than Thai letters are left out, an empty dictionary
    cuts by clusters. A dictionary of more than ``most`` words raises: give a larger bound.
    """
    thai = dictionary.select("word").filter(F.regexp_like("word", F.lit(f"^[{LETTERS}]+$"))).distinct()
    known = [r["word"] for r in thai.limit(most + 1).collect()]  # bounded by ``most``
    if len(known) > most:
        raise ValueError(f"the dictionary has more than {most} Thai words")
    plain = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{LETTERS}{DIGITS}]]++"
    word = "|".join([*([word_pattern(known)] if known else []), f"[{DIGITS}]++", CLUSTER, plain])
    return Rules(word, rf"{word}|[^\s\p{{L}}\p{{M}}\p{{N}}]")
