"""Numbers of greedy word pieces, by one automaton step per byte.

A word is a run of ``[^\\x20\\x09-\\x0D]`` with the vocabulary's word-start mark in front. It is cut
greedily: the longest piece of the vocabulary that fits, then on from there. The cut is not
made; the vocabulary's trie has a failure link at each node, to the node that the text's end
stands at after the pieces that can't grow any more are cut off, and the number of those
pieces. A word's count is the sum over the links followed (Song et al., "Fast WordPiece").

The trie is a table of numbers built on the driver and broadcast (its size is the
vocabulary's, a fixed file). Counts of words are kept per task up to a bounded number of words,
and texts are mapped without a shuffle.

Defined cases: a null or empty text has no words and no tokens. Bytes that no piece covers (only if
the vocabulary lacks single bytes) count as one unknown token a word. Repeated rows count each;
further columns stay.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import fresh

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
WORD_START = b" "
CACHED_WORDS = 200_000


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a rank file: a base64 piece and its rank on each line."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


class Automaton:
    """Trie, failure links and numbers of popped pieces."""

    def __init__(self, pieces: list[bytes]):
        # next[node << 8 | byte] is the child; node 0 is the root.
        self.next: dict[int, int] = {}
        ends = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                node = self.next.get(key, -1)
                if node < 0:
                    node = self.next[key] = len(ends)
                    ends.append(False)
            ends[node] = bool(piece)
        # link[node] is -1 where the cut is stuck: the node's text can't be covered.
        self.link, self.popped = [-1] * len(ends), [0] * len(ends)
        children: list[list[tuple[int, int]]] = [[] for _ in ends]
        for key, child in self.next.items():
            children[key >> 8].append((key & 255, child))
        level = [0]
        while level:
            below = []
            for node in level:
                for byte, child in children[node]:
                    below.append(child)
                    if ends[child]:
                        self.link[child], self.popped[child] = 0, 1
                        continue
                    at, count = self.link[node], self.popped[node]
                    while at >= 0 and (at << 8 | byte) not in self.next:
                        count += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[child], self.popped[child] = self.next[at << 8 | byte], count
            level = below

    def count(self, word: bytes) -> int:
        """Greedy pieces of ``word``; 1 (unknown) if they can't cover it."""
        step, link, popped = self.next, self.link, self.popped
        node = total = 0
        for byte in word:
            child = step.get(node << 8 | byte, -1)
            while child < 0:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
                child = step.get(node << 8 | byte, -1)
            node = child
        while node > 0:
            total += popped[node]
            node = link[node]
        return total if node == 0 else 1


def with_token_counts(
    documents: DataFrame, vocabulary: list[bytes], n_words: str = "n_words", n_tokens: str = "n_tokens"
) -> DataFrame:
    """``documents`` with the numbers of words and greedy pieces of each whole text."""
    pieces = documents.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n_words long, n_tokens long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(pieces.value)
        known: dict[bytes, int] = {}
        for part in parts:
            rows = []
            for raw in part:
                words = (raw or b"").split()
                total = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        n = automaton.count(WORD_START + word)
                        if len(known) >= CACHED_WORDS:
                            known.clear()
                        known[word] = n
                    total += n
                rows.append((len(words), total))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    counted = fresh(documents, "_counted")
    out = documents.withColumn(counted, count(F.col("text").cast("binary")))
    return (
        out.withColumn(n_words, F.col(counted)["n_words"]).withColumn(n_tokens, F.col(counted)["n_tokens"]).drop(counted)
    )
