"""Encoding and decoding with a sentence-piece model of the merge type, by backtracking.

Merging pairs of neighbours by rank, leftmost first, has one outcome, and it can be recognised
without merging the whole text: every two tokens side by side must be what merging gives for
the two alone. So the encoder walks from left to right. One pass of an Aho-Corasick automaton
finds the longest token at every place. The walk takes it if it is compatible with the token
before, which re-merging the two decides, else the next shorter token that starts there. Where
none is left, the place is marked in a bitfield as failed, as no encoding can pass through it,
and the walk goes back by one token.

A text is cut into chunks where no token can reach across: in front of a run of spaces, and
around letters that are in no longer token. This is derived from the vocabulary. Chunks that
are short are kept with their ids, in two generations of bounded size.

Null texts count as empty; the ids of an empty text are the end id alone. Long texts are
encoded whole, in time proportional to their length. Equal rows give equal rows, an empty table
an empty one. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from tillroll.llm.common import Kept, map_rows

SPACE = "▁"
#: Longer chunks are not kept.
CHUNK_KEPT = 48
#: Letters of a text that are cut into chunks at once.
BLOCK = 1 << 20
#: Entries of one generation of what a task keeps.
KEPT = 200_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


class PieceBpe:
    """A model file, ready to encode and decode. Only merge models that leave the text as it
    is, without user-defined or unused pieces, are taken."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        self.rank: dict[str, float] = {}  # lower merges first
        self.id: dict[str, int] = {}
        kinds: list[int] = []
        prefix, model, charsmap, extra = True, 1, b"", True
        for number, value in _fields(data):
            if number == 1:
                part = dict(_fields(value))
                piece, kind = part[1].decode(), part.get(3, _NORMAL)
                if kind in (_USER, _UNUSED):
                    raise ValueError(f"user-defined or unused piece: {piece}")
                if kind == _NORMAL:
                    self.rank[piece] = -struct.unpack("<f", part.get(2, bytes(4)))[0]
                    self.id[piece] = len(self.pieces)
                self.pieces.append(piece)
                kinds.append(kind)
            elif number == 2:
                model = dict(_fields(value)).get(3, 1)
            elif number == 3:
                spec = dict(_fields(value))
                charsmap, prefix = spec.get(2, b""), bool(spec.get(3, 1))
                extra = bool(spec.get(4, 1))
        if model != 2 or charsmap or extra or not prefix:
            raise ValueError("not a merge model that leaves the text as it is")
        self.unknown = kinds.index(_UNKNOWN)
        self.end = self.pieces.index("</s>")
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == _BYTE}
        self.said = [
            bytes([int(p[3:5], 16)]) if k == _BYTE else b"" if k == _CONTROL else p.encode()
            for p, k in zip(self.pieces, kinds)
        ]
        inside = {c for p in self.id for c in p}
        if not inside <= set(self.id):
            raise ValueError("a letter of a piece is no piece of its own")
        # a piece that merging does not give for its own text is never in an outcome
        tokens = {p: i for p, i in self.id.items() if self.merged(p) == [p]}
        self.other = len(self.pieces)  # stands for any letter that is no piece and never merges
        self.letter = {p: i for p, i in tokens.items() if len(p) == 1}
        self.size = [1] * (self.other + 1)
        self.shorter: list[int | None] = [None] * (self.other + 1)
        self.automaton = ahocorasick.Automaton()
        for p, i in tokens.items():
            self.size[i] = len(p)
            self.shorter[i] = next((tokens[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in tokens), None)
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.cut: re.Pattern | None = None
        self.chunks = self._chunk_pattern()
        self.known, self.pairs = Kept(KEPT), Kept(KEPT)

    def merged(self, text: str) -> list[str]:
        """The outcome of merging a short text, straight from the definition."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _chunk_pattern(self) -> re.Pattern:
        """Chunks that no token reaches across."""
        inside = {c for p in self.id if len(p) > 1 for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            return re.compile("(?s).+")
        self.cut = re.compile(f"[^{SPACE}](?={SPACE})")
        letters = "".join(map(re.escape, sorted(inside - {SPACE})))
        return re.compile(rf"(?s){SPACE}*[{letters}]+|{SPACE}+|." if letters else "(?s).")

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two together leaves them as they are."""
        pair = left * len(self.size) + right
        found = self.pairs.get(pair)
        if found is None:
            found = self.other in (left, right)
            if not found:
                one, other = self.pieces[left], self.pieces[right]
                found = self.merged(one + other) == [one, other]
            self.pairs.put(pair, found)
        return found

    def split(self, chunk: str) -> list[int]:
        """The tokens of a chunk, letters that are no piece as `other`."""
        n, letter, other = len(chunk), self.letter, self.other
        longest = [letter.get(c, other) for c in chunk]
        for end, (token, length) in self.automaton.iter(chunk):
            longest[end + 1 - length] = token  # ends ascend, so the last of a start is the longest
        failed, any_failed = bytearray(n // 8 + 1), False
        tokens: list[int] = []
        at, last, token = 0, other, longest[0]
        size, shorter, fits, width = self.size, self.shorter, self.pairs.young.get, other + 1
        while True:
            end = at + size[token]
            fit = fits(last * width + token)
            if fit is None:
                fit = self.compatible(last, token)
            if fit and not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                tokens.append(token)
                if end == n:
                    return tokens
                at, last, token = end, token, longest[end]
                continue
            token = shorter[token]
            if token is None:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                token = tokens.pop()  # its end has failed, so a shorter one comes next
                at -= size[token]
                last = tokens[-1] if tokens else other

    def _ids(self, chunk: str) -> bytes:
        tokens = self.split(chunk)
        if self.other not in tokens:
            return struct.pack(f"<{len(tokens)}i", *tokens)
        out, at = [], 0
        for token in tokens:
            if token != self.other:
                out.append(token)
            elif self.bytes:
                out += [self.bytes[b] for b in chunk[at].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
            at += self.size[token]
        return struct.pack(f"<{len(out)}i", *out)

    def _chunk(self, chunk: str) -> bytes:
        if len(chunk) > CHUNK_KEPT:
            return self._ids(chunk)
        found = self.known.get(chunk)
        if found is None:
            found = self._ids(chunk)
            self.known.put(chunk, found)
        return found

    def _blocks(self, whole: str) -> Iterator[list[str]]:
        """The chunks of a text, a block at a time, so that a long one is no long list."""
        start = 0
        while start < len(whole):
            cut = self.cut and self.cut.search(whole, start + BLOCK)
            end = cut.end() if cut else len(whole)
            yield self.chunks.findall(whole, start, end)
            start = end

    def encode(self, text: str) -> np.ndarray:
        """Ids, the end id last."""
        out: list[bytes] = []
        if text:
            whole = SPACE + text.replace(" ", SPACE)
            get, slow = self.known.young.get, self._chunk
            for chunks in self._blocks(whole):
                out.append(b"".join([get(c) or slow(c) for c in chunks]))
                get = self.known.young.get
        out.append(struct.pack("<i", self.end))
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes put together, marks as spaces, the one put in front gone."""
        data = b"".join(map(self.said.__getitem__, ids.tolist()))
        text = data.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if data.startswith(SPACE.encode()) else text


@lru_cache(maxsize=2)
def _loaded(data: bytes) -> PieceBpe:
    return PieceBpe(data)


def _data(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ids (array of int, the end id last) and the decoded text.

    The driver reads the model file, under a MB at any size of the input, and sends it to the
    executors.
    """
    held = docs.sparkSession.sparkContext.broadcast(_data(path))

    def make():
        bpe = _loaded(held.value)

        def work(keys, texts):
            ids = [bpe.encode(t or "") for t in texts]
            return keys, ids, [bpe.decode(i) for i in ids]

        return work

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string"
    return map_rows(docs, [key, text], schema, make)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, and digests of the ids and of the text decoded from them."""
    held = docs.sparkSession.sparkContext.broadcast(_data(path))

    def make():
        bpe = _loaded(held.value)

        def work(keys, texts):
            sizes, names, decoded = [], [], []
            for t in texts:
                ids = bpe.encode(t or "")
                sizes.append(len(ids))
                names.append(sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest())
                decoded.append(sha256(bpe.decode(ids).encode()).hexdigest())
            return keys, sizes, names, decoded

        return work

    schema = (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, "
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
    return map_rows(docs, [key, text], schema, make)
