"""Ids of a byte-pair tokenizer file, one distinct chunk of text at a time.

Such a tokenizer first cuts a text by a pattern and never merges across a cut. A text is
therefore split where every such pattern cuts (before blanks), each distinct chunk is encoded once,
and a text's ids are its chunks' ids in a row. Most words of a text are known by then, so
most of the tokenizer's work is saved; the ids are the tokenizer's own.

Chunks are kept from batch to batch up to ``KEPT`` chunks of at most ``LONGEST`` bytes,
so a worker's memory has a bound; longer chunks are encoded for their batch only.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable

KEPT = 800_000
LONGEST = 48
SIGNS = tuple(".,;:!?")
#: Latin letters with accents end here.
LATIN_END = 0x250

#: Unicode's white space.
WHITE = "\t-\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
_RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_BEYOND_LATIN = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")
_BLANKS = re.compile(r" *[^ ]+(?: +\Z)?| +")


def blank_and_word(text: str) -> list[str]:
    """Chunks of white space and the word after it; together they are the text."""
    return _RUNS.findall(text)


def blank_and_rest(text: str) -> list[str]:
    """The same with blanks for white space; blanks at the end stay with the last word."""
    return _BLANKS.findall(text)


def folded_words(text: str) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased where that settles nothing else: for tokenizers that drop white space and case."""
    raw = text.encode()
    # A mark that combines with the letter before it could tell cases apart; Latin letters have none.
    if raw.isascii() or not _BEYOND_LATIN.search(text):
        return raw.lower().split()
    return [w.lower() if w.isascii() else w for w in raw.split()]


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids; for a chunk's few ids an array costs less than numpy's."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Encodes batches of texts as little-endian unsigned 32-bit ids.

    ``encode_all`` encodes a list of chunks, ``whole`` says which texts may not be split.
    """

    def __init__(self, encode_all: Callable[[list], list], chunks: Callable[[str], list], whole: Callable[[str], bool]):
        self.encode_all, self.chunks, self.whole = encode_all, chunks, whole
        self.known: dict[str | bytes, bytes] = {}

    def _ids(self, texts: list) -> list[bytes]:
        return list(map(id_bytes, self.encode_all(texts))) if texts else []

    def encode(self, texts: list[str]) -> list[bytes]:
        rows: list[list[bytes | None]] = []
        holes: list[tuple[int, list, list[int]]] = []
        apart = []
        for i, text in enumerate(texts):
            if self.whole(text):
                apart.append(i)
                rows.append([])
                continue
            chunks = self.chunks(text)
            found = list(map(self.known.get, chunks))
            if None in found:
                holes.append((i, chunks, [k for k, ids in enumerate(found) if ids is None]))
            rows.append(found)
        missing = list({chunks[k] for _, chunks, places in holes for k in places})
        new = dict(zip(missing, self._ids(missing)))
        for i, chunks, places in holes:
            for k in places:
                rows[i][k] = new[chunks[k]]
        if len(self.known) + len(new) > KEPT:
            # What this batch has used goes on, and with it what is frequent.
            used = {c for text in texts for c in self.chunks(text)}
            self.known = {c: self.known[c] for c in used if c in self.known}
        self.known.update((c, ids) for c, ids in new.items() if len(c) <= LONGEST)
        out = list(map(b"".join, rows))
        for i, ids in zip(apart, self._ids([texts[i] for i in apart])):
            out[i] = ids
        return out


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_word(text: str) -> tuple[str, str] | None:
    """A word of Latin letters, and the one sign behind it; None for all else.

    Every pattern cuts between the two and nowhere else.
    """
    word, sign = (text[:-1], text[-1]) if text[-1:] in SIGNS else (text, "")
    return (word, sign) if word.isalpha() and ord(max(word)) < LATIN_END else None


def bpe_encoder(spec: str, chunks: Callable[[str], list], specials_are_text: bool) -> Encoder:
    """From the text of a tokenizer file; a special token's string in a text is that token, or plain text.

    Plain words go to the file's merges at once, past its normalizer and pattern, which would leave
    them as they are; all other chunks take the whole way.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.encode_special_tokens = specials_are_text
    specials = [] if specials_are_text else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    merges = tokenizer.model
    letter_of = {b: c for c, b in byte_alphabet().items()}
    # What a vocabulary's signs are, once and not behind every word.
    sign_ids: dict[str, list[int]] = {"": []}

    def merged(raw: bytes) -> list[int]:
        return [t.id for t in merges.tokenize("".join(map(letter_of.__getitem__, raw)))] if raw else []

    for sign in SIGNS:
        sign_ids[sign] = merged(sign.encode())

    def quick(chunk: str | bytes) -> list[int] | None:
        if isinstance(chunk, bytes):
            text, blank = chunk.decode(), b""
            if text.isascii():
                word = text[:-1] if text[-1] in sign_ids else text
                # Letters and signs of ASCII stand for themselves in the vocabulary.
                if word.isalpha() and word.islower():
                    return [t.id for t in merges.tokenize(word)] + sign_ids[text[len(word) :]]
                return None
            # Case and composition are the normalizer's: here they have to be settled already.
            if text.lower() != text or not unicodedata.is_normalized("NFC", text):
                return None
        else:
            text, blank = (chunk[1:], b" ") if chunk[0] == " " else (chunk, b"")
        parts = plain_word(text)
        return None if parts is None else merged(blank + parts[0].encode()) + sign_ids[parts[1]]

    def encode_all(chunks: list[str | bytes]) -> list[list[int]]:
        found = [quick(c) for c in chunks]
        rest = [k for k, ids in enumerate(found) if ids is None]
        texts = [c if isinstance(c, str) else c.decode() for c in (chunks[k] for k in rest)]
        for k, e in zip(rest, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found[k] = e.ids
        return found

    return Encoder(encode_all, chunks, lambda text: any(s in text for s in specials))


def piece_encoder(pieces) -> Encoder:
    """From a sentence-piece processor that puts a blank in front; takes texts with that blank.

    If no piece has a blank behind another character, no merge crosses the place before a blank, and
    texts are split there. With a vocabulary of another kind they are encoded as a whole, and so is a text with the
    blank's own mark, which would be read as a blank.
    """
    vocabulary = (pieces.id_to_piece(i) for i in range(pieces.get_piece_size()))
    inner = any("▁" in p.lstrip("▁") for p in vocabulary)

    def encode_all(chunks: list[str]) -> list[list[int]]:
        return pieces.encode([c[1:] for c in chunks], num_threads=1)

    return Encoder(encode_all, blank_and_rest, lambda text: inner or "▁" in text)


def stretches(sizes: list[int | None], bound: int) -> list[tuple[int, int]]:
    """Stretches [from, to) of about ``bound`` in size, at least one text each."""
    cuts, start, total = [], 0, 0
    for i, size in enumerate(sizes):
        total += size or 0
        if total >= bound:
            cuts.append((start, i + 1))
            start, total = i + 1, 0
    return cuts + [(start, len(sizes))] * (start < len(sizes))
