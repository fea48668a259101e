"""Byte-pair encoding and decoding with a given vocabulary of words.

Each short word is held as a list of its parts, one for each boundary, and a second list of
the ranks of adjacent parts. The smallest rank is looked for again and again; its boundary
goes, and only the two neighbouring ranks are looked up anew. Both lists are contiguous and
a word has a dozen letters, so the scan beats a heap. Very long words take a heap over the
same ranks, which merges in the same order.

Null texts count as empty. Empty texts have no ids and decode to the empty text. Equal rows
give equal rows.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from functools import lru_cache
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame

from tillroll.llm.common import Kept, map_rows

#: Words longer than this are merged through a heap.
LONG_WORD = 512
#: Encoded chunks, and pieces of them, of one of two generations that a task keeps, and the
#: letters of the longest that it keeps.
WORDS_KEPT = 100_000
LETTERS_KEPT = 48
_NONE = 1 << 60

_SEPARATORS = regex.compile(r"[\x1c-\x1f]")
_SPACES = regex.compile(
    r"[\t-\r\x20\x85\xa0  -     　]+"
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """A vocabulary file of the kind that marks word ends, ready to encode."""

    def __init__(self, data: bytes) -> None:
        spec = json.loads(data)
        model, letters, end = spec["model"], byte_letters(), spec["model"]["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (ids | self.special).items()}
        self.inner, self.last = [ids[c] for c in letters], [ids[c + end] for c in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks.setdefault(ids[left] << 20 | ids[right], rank)
            self.merged.append(ids[left + right])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        self.specials = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.known, self.known_pieces = Kept(WORDS_KEPT), Kept(WORDS_KEPT)

    def parts(self, word: bytes) -> list[int]:
        """Merge the bytes of one word into tokens.

        Each entry of `parts` begins at a boundary; deleting one deletes its boundary.
        """
        parts = [self.inner[b] for b in word[:-1]]
        parts.append(self.last[word[-1]])
        if len(parts) > LONG_WORD:
            return self._merged_by_heap(parts)
        get = self.ranks.get
        ranks = [get(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != _NONE:
            i = ranks.index(least)
            parts[i] = self.merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 20 | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 20 | parts[i + 1], _NONE)
        return parts

    def _merged_by_heap(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, for words too long to scan again and again."""
        n, gone = len(parts), -1
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                pair = parts[i] << 20 | parts[after[i]]
                if (rank := self.ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, i, pair))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] == gone or parts[i] << 20 | parts[j] != pair:
                continue
            parts[i], parts[j] = self.merged[rank], gone
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p != gone]

    def _piece(self, piece: str) -> bytes:
        found = self.known_pieces.get(piece)
        if found is None:
            parts = self.parts(piece.encode("utf-8", "surrogatepass"))
            found = struct.pack(f"<{len(parts)}I", *parts)
            if len(piece) <= LETTERS_KEPT:
                self.known_pieces.put(piece, found)
        return found

    def chunk(self, chunk: str) -> bytes:
        """Ids, as bytes, of what stands between white space."""
        if chunk.isalpha():
            return self._piece(chunk)  # one piece, and kept as such
        if (found := self.known.get(chunk)) is None:
            found = b"".join(map(self._piece, self.pieces.findall(chunk)))
            if len(chunk) <= LETTERS_KEPT:
                self.known.put(chunk, found)
        return found

    def _plain(self, text: str) -> list[bytes]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()
        chunks = filter(None, _SPACES.split(text)) if _SEPARATORS.search(text) else text.split()
        known, pieces, slow = self.known.young.get, self.known_pieces.young.get, self.chunk
        return [pieces(c) or known(c) or slow(c) for c in chunks]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for piece in self.specials.split(text):
            if piece in self.special:
                out.append(self.special[piece].to_bytes(4, "little"))
            elif piece:
                out += self._plain(piece)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: the vocabulary's tokens, a space between."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _loaded(data: bytes) -> WordBpe:
    return WordBpe(data)


def _data(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ids (array of int) and the decoded text.

    The driver reads the vocabulary file, a few MB at any size of the input, and sends it
    to the executors.
    """
    held = docs.sparkSession.sparkContext.broadcast(_data(path))

    def make():
        bpe = _loaded(held.value)

        def work(keys, texts):
            ids = [bpe.encode(t or "") for t in texts]
            return keys, [np.frombuffer(i, "<i4") for i in ids], [bpe.decode(i) for i in ids]

        return work

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string"
    return map_rows(docs, [key, text], schema, make)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, and digests of the ids and of the text decoded from them."""
    held = docs.sparkSession.sparkContext.broadcast(_data(path))

    def make():
        bpe = _loaded(held.value)

        def work(keys, texts):
            ids = [bpe.encode(t or "") for t in texts]
            decoded = (sha256(bpe.decode(i).encode()).hexdigest() for i in ids)
            return (
                keys,
                [len(i) // 4 for i in ids],
                [sha256(i).hexdigest() for i in ids],
                list(decoded),
            )

        return work

    schema = (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, "
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
    return map_rows(docs, [key, text], schema, make)
