"""Runs: stretches of words that repeat with a period, and texts without the repetition.

A run is a longest stretch of words with smallest period q (words q apart are the same) of at least
``LEAST`` words and ``TIMES`` periods.

Method. Words are appended one by one to a suffix automaton, whose states a link-cut tree keeps
as paths: the states on one path have the same last occurrence. After each word, the
access from the new prefix's state to the root meets the paths of its suffixes from long to short. A path
says that the longest of its suffixes, ``length`` words long, ended ``distance`` words
before. If the distance is not above the length, the two occurrences touch or overlap: a square of that
period ends here, and it starts where the earlier occurrence does. Then all states met become one
path of the new end. A square's start and period name its run; the last word that continues it is kept, and
runs are extended to words outside the block.

Blocks. In a run of at least three more periods than one, each word but the first q has the
same word at most q before it, so it lies in a stretch of words whose last occurrences all are within
a third of the stretch's length. Stretches for which this holds are found for a whole batch of texts by sorting;
only they, with a third of their length before them, go through the automaton. No run is lost by that.

Defined cases: a null or empty text has no words and no run, and its collapsed text is empty. Words
are ``[^\\x20\\x09-\\x0D]+``. A word that several runs drop is dropped once. Repeated rows are judged each. A text of any length is one
text. Further columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import WORD, fresh
from cartwright.llm.subwords import stretches

LEAST, TIMES = 6, 4
BATCH_BYTES = 4_000_000
#: Rounds of narrowing the blocks; each leaves every run in its block.
ROUNDS = 8


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) of everything that repeats at least twice in a row, and its last word's place."""
    # The automaton: state 0 is the empty word.
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    # The tree: children in the splay tree of a path, parent there or of the path, last occurrence at its root.
    left, right, parent, last = [-1], [-1], [-1], [-1]

    def rotate(x: int) -> None:
        p = parent[x]
        g = parent[p]
        if g >= 0 and left[g] == p:
            left[g] = x
        elif g >= 0 and right[g] == p:
            right[g] = x
        else:
            last[x] = last[p]
        parent[x] = g
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            parent[inner] = p
        parent[p] = x

    def splay(x: int) -> None:
        while True:
            p = parent[x]
            if p < 0 or left[p] != x and right[p] != x:
                return
            g = parent[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    def new_state(size: int, steps: dict[int, int]) -> int:
        step.append(steps)
        length.append(size)
        for table in (link, left, right, parent, last):
            table.append(-1)
        return len(step) - 1

    found: dict[tuple[int, int], int] = {}
    tip = 0
    for i, word in enumerate(words):
        state = new_state(length[tip] + 1, {})
        at = tip
        while at >= 0 and word not in step[at]:
            step[at][word] = state
            at = link[at]
        target = 0
        if at >= 0:
            target = step[at][word]
            if length[target] != length[at] + 1:
                # A shorter state takes its place above the target, on the target's path.
                clone = new_state(length[at] + 1, dict(step[target]))
                link[clone], link[target] = link[target], clone
                splay(target)
                above = left[target]
                left[clone], left[target], parent[clone] = above, clone, target
                if above >= 0:
                    parent[above] = clone
                old = target
                target = clone
                while at >= 0 and step[at].get(word) == old:
                    step[at][word] = clone
                    at = link[at]
        link[state] = parent[state] = target
        tip = state
        # The access: each path met is a segment of suffixes with one last occurrence.
        x, below = state, -1
        while x >= 0:
            splay(x)
            before, size = last[x], length[x]
            if right[x] >= 0:
                last[right[x]] = before
            right[x] = below
            if before >= 0 and i - before <= size:
                found[before - size + 1, i - before] = i
            below, x = x, parent[x]
        last[below] = i
    return found


def blocks(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[from, to) of the stretches that runs can lie in; ``first``: where each text starts."""
    n = len(codes)
    text = np.zeros(n, np.int64)
    text[first[1:][first[1:] < n]] = 1
    # Texts without words share a start; that changes nothing.
    key = np.cumsum(text) * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    distance = np.full(n, n + 1)
    distance[order[1:][same]] = (order[1:] - order[:-1])[same]
    keep = distance <= n
    start = stop = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        edge = np.diff(keep.astype(np.int8), prepend=0, append=0)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = np.repeat(stop - start, stop - start)
        inside = np.flatnonzero(keep)
        lost = (size < LEAST - 1) | (distance[inside] * (TIMES - 1) > size)
        if not lost.any():
            break
        keep[inside[lost]] = False
    own = first[np.searchsorted(first, start, side="right") - 1] if len(start) else start
    return np.stack([np.maximum(own, start - (stop - start) // (TIMES - 1)), stop], axis=1)


def runs_in(words: list[int], spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text, by start and period."""
    runs = set()
    for begin, end in spans:
        for (start, period), stop in squares(words[begin:end]).items():
            start, stop = start + begin, stop + begin
            while start > 0 and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while stop + 1 < len(words) and words[stop + 1] == words[stop + 1 - period]:
                stop += 1
            if stop + 1 - start >= max(LEAST, TIMES * period):
                runs.add((start, stop + 1 - start, period))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def runs_of(texts: list[bytes | None]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Each text's runs, and the text without what repeats."""
    split = [(t or b"").split() for t in texts]
    first = np.cumsum([0, *map(len, split)])
    codes, _ = pd.factorize(np.array([w for words in split for w in words], dtype=object))
    found = blocks(codes, first[:-1])
    at = np.searchsorted(found[:, 1], first, side="right").tolist()
    for k, words in enumerate(split):
        spans = [(int(a - first[k]), int(b - first[k])) for a, b in found[at[k] : at[k + 1]]]
        runs = runs_in(codes[first[k] : first[k + 1]].tolist(), spans) if spans else []
        if runs:
            stays = np.ones(len(words), bool)
            for start, size, period in runs:
                stays[start + period : start + size] = False
            words = [words[i] for i in np.flatnonzero(stays)]
        yield runs, b" ".join(words)


def with_runs(documents: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``documents`` with the runs of each whole text and the text without their repetitions."""

    @F.pandas_udf("runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, rows = list(batch), []
            for begin, end in stretches([len(t or b"") for t in texts], BATCH_BYTES):
                for own, rest in runs_of(texts[begin:end]):
                    rows.append(([dict(zip(("start", "length", "period"), r)) for r in own], rest.decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["runs", "collapsed"])

    done = fresh(documents, "_periodic")
    out = documents.withColumn(done, find(F.col(text).cast("binary")))
    return out.withColumn(runs, F.col(done)["runs"]).withColumn(collapsed, F.col(done)["collapsed"]).drop(done)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def repeated_from(text: Column, start: Column, period: Column) -> Column:
    """The text's words, those from ``start`` on replaced by its first ``period`` ones over and over."""
    words = words_of(text)
    tail = F.size(words) - start
    copies = F.array_repeat(F.slice(words, start + 1, period), F.ceil(tail / period).cast("int"))
    return F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(F.flatten(copies), F.lit(1), tail)), " ")
