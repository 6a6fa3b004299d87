"""Licence scans: phrases and identifier tags found by Aho-Corasick, licence expressions by a shunting-yard parser.

A text is lower-cased (A-Z) and read as words, runs of characters other than ASCII blanks, punctuation and controls. An
Aho-Corasick automaton finds every place where a notice phrase's words stand consecutively, overlaps included. Where it finds
the words of an identifier tag, the expression behind the tag is read from the text itself: and/or/with and
parentheses are put in order by a shunting-yard parser and evaluated, to the licences named and to what is demanded of a user: all of
those joined by ``and``, a choice of those joined by ``or``.

A text of any length takes time in proportion to it, however many phrases it holds and however long or deep its expressions are.

Null and empty texts have no words, no labels and score 0. Repeated rows are scanned each for itself. Other
columns stay; columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from llm.common import with_arrow

# The phrases of the contract and their labels (fixed values).
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices of well-known licences, as words, and the share of certainty that each gives.
MORE_PHRASES = {
    "apache license 2 0": ("apache-2", 0.9),
    "apache 2 0 license": ("apache-2", 0.9),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "bsd license": ("bsd", 0.7),
    "gnu general public license": ("gpl", 0.8),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by 4 0": ("cc-by", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "creative commons attribution": ("cc-by", 0.7),
    "all rights reserved": ("all-rights-reserved", 0.6),
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(r"spdx-license-identifier\s*:\s*([^\n\r]*)")
TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+:-]*")
BINDS = {"or": 1, "and": 2, "with": 3}
# Identifiers that stand for a contract label (fixed values); others keep their own name.
SAME_AS = {"apache-2.0": "apache-2"}

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_TO_WORDS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in bytes(range(256)).translate(_LOWER))


@dataclass(frozen=True)
class Tree:
    """A licence, or an operator over two expressions."""

    name: str
    left: "Tree | None" = None
    right: "Tree | None" = None


def parse(expression: str) -> Tree | None:
    """Read the longest well-formed licence expression at the start of a text; None if there is none.

    ``with`` binds tighter than ``and``, ``and`` tighter than ``or``; equal operators bind to the left. Reading stops at the first word that
    cannot continue the expression, so prose behind a tag does no harm.
    """
    output: list[Tree] = []
    operators: list[str] = []
    operand_next = True
    end = 0

    def reduce() -> None:
        right, left = output.pop(), output.pop()
        output.append(Tree(operators.pop(), left, right))

    for found in TOKEN.finditer(expression):
        if expression[end : found.start()].strip(" \t"):
            break
        token = found[0]
        if operand_next and token == "(":
            operators.append(token)
        elif operand_next and token not in BINDS and token != ")":
            output.append(Tree(token.rstrip(".:-") or token))
            operand_next = False
        elif not operand_next and token in BINDS:
            while operators and operators[-1] != "(" and BINDS[operators[-1]] >= BINDS[token]:
                reduce()
            operators.append(token)
            operand_next = True
        elif not operand_next and token == ")" and "(" in operators:
            while operators[-1] != "(":
                reduce()
            operators.pop()
        else:
            break
        end = found.end()
    if operand_next and operators and operators[-1] != "(":
        operators.pop()  # an operator without a right side
    while operators:
        if operators[-1] == "(":
            operators.pop()
        elif len(output) >= 2:
            reduce()
        else:
            operators.pop()
    return output[-1] if output else None


def _fold(tree: Tree, leaf: Callable, joined: Callable):
    """Evaluate a tree from its leaves up, however deep it is."""
    values, open_nodes = [], [(tree, False)]
    while open_nodes:
        node, ready = open_nodes.pop()
        if node.left is None:
            values.append(leaf(node.name))
        elif ready:
            right, left = values.pop(), values.pop()
            values.append(joined(node.name, left, right))
        else:
            open_nodes += [(node, True), (node.right, False), (node.left, False)]
    return values[0]


def licences(tree: Tree | None) -> set[str]:
    """The licences that an expression names; an exception after ``with`` is joined to its licence."""

    def joined(name: str, left: set[str], right: set[str]) -> set[str]:
        if name == "with":
            return {f"{licence}-with-{'-'.join(sorted(right))}" for licence in left}
        left |= right
        return left

    return set() if tree is None else _fold(tree, lambda name: {SAME_AS.get(name, name)}, joined)


def demands(tree: Tree | None) -> str:
    """What an expression asks of a user, in one form: ``or`` offers a choice, ``and`` demands all. Operands are sorted and stand once."""

    def text(value: tuple[str, set[str]]) -> str:
        return f" {value[0]} ".join(sorted(value[1]))

    def within(value: tuple[str, set[str]], operator: str) -> set[str]:
        """The operands of the same operator, else the whole value as one."""
        if len(value[1]) == 1 or value[0] == operator:
            return value[1]
        return {f"({text(value)})"}

    def joined(name: str, left: tuple[str, set[str]], right: tuple[str, set[str]]) -> tuple[str, set[str]]:
        if name == "with":
            return "", {f"{'-'.join(sorted(left[1]))}-with-{'-'.join(sorted(right[1]))}"}
        operands = within(left, name)
        operands |= within(right, name)
        return name, operands

    return "" if tree is None else text(_fold(tree, lambda name: ("", {SAME_AS.get(name, name)}), joined))


def automaton(base: Mapping[str, str], more: Mapping[str, tuple[str, float]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, (label, sure) in more.items():
        found.add_word(f" {phrase} ", (len(phrase.split()), label, sure, False))
    for phrase, label in base.items():
        found.add_word(f" {phrase} ", (len(phrase.split()), label, 1.0, True))
    found.add_word(f" {TAG_WORDS} ", (len(TAG_WORDS.split()), "", 0.0, False))
    found.make_automaton()
    return found


def scan_text(text: str | None, machine: ahocorasick.Automaton) -> tuple:
    raw = (text or "").encode()
    tokens = raw.translate(_TO_WORDS).split()
    if not tokens:
        return 0, 0, None, None, "", "", 0.0, ""
    # Latin-1 keeps one character a byte, so that the automaton's places are byte places.
    line = f" {b' '.join(tokens).decode('latin-1')} "
    base, first, last, marked, sure, tagged = 0, None, None, set(), 0.0, False
    labels, asked = set(), set()
    gaps, counted = 0, 0  # blanks before a place of the line
    for end, (size, label, certainty, in_base) in machine.iter(line):
        if not label:
            tagged = True
            continue
        sure = max(sure, certainty)
        labels.add(label)
        if in_base:
            gaps, counted = gaps + line.count(" ", counted, end + 1), end + 1
            at = gaps - size - 1
            base, first, last = base + 1, at if first is None else min(first, at), at if last is None else max(last, at)
            marked.add(label)
    if tagged:
        for found in TAG.finditer(raw.translate(_LOWER).decode()):
            tree = parse(found[1])
            if tree is not None:
                labels |= licences(tree)
                asked.add(demands(tree))
                sure = 1.0
    return len(tokens), base, first, last, ",".join(sorted(marked)), ",".join(sorted(labels)), sure, "; ".join(sorted(asked))


def scan(docs: DataFrame, text: str = "text", base: Mapping[str, str] = BASE_PHRASES, more: Mapping[str, tuple[str, float]] = MORE_PHRASES) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels, score (the certainty of the surest find) and demands (of each tagged expression)."""
    kinds = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType())]
    kinds += [("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("demands", T.StringType())]
    machines: list[ahocorasick.Automaton] = []

    def run(part: pa.RecordBatch) -> list[pa.Array]:
        if not machines:  # once in each Python worker
            machines.append(automaton(base, more))
        found = [scan_text(x, machines[0]) for x in part.column(text).to_pylist()]
        to = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.DoubleType(): pa.float64()}
        return [pa.array([row[i] for row in found], to[kind]) for i, (_, kind) in enumerate(kinds)]

    return with_arrow(docs, text, [T.StructField(name, kind) for name, kind in kinds], run)
