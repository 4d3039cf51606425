"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Encoding.  A sequence of tokens is what byte-pair merging makes of their bytes exactly if merging
keeps every single token and every two neighbours apart.  That turns the merges into a
nondeterministic transducer: read a byte, extend the open token, or close it if it may follow the
token before.  :class:`Transducer` determinises it while it runs.  A state is the set of open
readings, each with the tokens that it has not yet emitted; as soon as all readings agree on a first
token, it is emitted.  A reading ends at the longest token at the latest, so the lookahead is bounded.
Transitions are kept in a table of bounded size.

Decoding.  :class:`Utf8Stream` takes bytes in any pieces and hands out whole characters; a state
machine carries the bytes of a character that is cut at the end of a piece.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .text import map_texts, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chars long, valid_utf8 boolean"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Transducer:
    """Byte-pair encoding of one piece of text at a time, by table lookups."""

    MOST_TRANSITIONS = 1_000_000
    MOST_PIECES = 400_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self._grow_trie()
        self.follows: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.made_of: dict[int, tuple[bytes, bytes] | None] = {}
        self._forget()
        self.pieces: dict[str, list[int]] = {}
        self.spaced: dict[str, list[int]] = {}

    def _grow_trie(self) -> None:
        """Numbered prefixes of all tokens: the next prefix by ``number * 256 + byte``, and the token each one is."""
        self.next: dict[int, int] = {}
        self.token_at, self.grows = [-1], [True]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                self.grows[node] = True
                key = node << 8 | byte
                if key not in self.next:
                    self.next[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.grows.append(False)
                node = self.next[key]
            self.token_at[node] = rank

    def _forget(self) -> None:
        # State 0: nothing read, nothing open.  A reading: tokens not yet emitted, the last token, the open prefix.
        self.states = [(((), -1, 0),)]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.last: list[tuple[int, ...]] = [()]
        self.n_moves = 0

    def merge(self, piece: bytes, stop: int = 1) -> list[bytes]:
        """Plain byte-pair merging of one token's bytes, lowest rank first, down to ``stop`` parts."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            found = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def may_follow(self, before: int, token: int) -> bool:
        """Whether merging leaves ``token`` whole and apart from the token ``before`` it (-1: the start)."""
        if token not in self.whole:
            self.whole[token] = len(self.merge(self.bytes[token])) == 1
        if before < 0 or not self.whole[token]:
            return self.whole[token]
        pair = before << 32 | token
        found = self.follows.get(pair)
        if found is None:
            if len(self.follows) > self.MOST_TRANSITIONS:
                self.follows.clear()
            found = self.follows[pair] = self._stay_apart(before, token)
        return found

    def _halves(self, token: int) -> tuple[bytes, bytes] | None:
        """The two parts whose merge makes a token; None for a single byte."""
        if token not in self.made_of:
            piece = self.bytes[token]
            self.made_of[token] = tuple(self.merge(piece, 2)) if len(piece) > 1 else None
        return self.made_of[token]

    def _edge(self, token: int, side: int) -> list[int]:
        """The tokens that touch one side (0 left, 1 right) while merging builds ``token``, last first."""
        edge = [token]
        while (halves := self._halves(edge[-1])) is not None:
            edge.append(self.ranks[halves[side]])
        return edge

    def _stay_apart(self, left: int, right: int) -> bool:
        """Follow both edges of the border through time; a merge across it needs a lower rank than what comes next."""
        lefts, rights = self._edge(left, 1), self._edge(right, 0)
        while True:
            a, b = lefts.pop(), rights.pop()
            next_left = lefts[-1] if lefts else len(self.ranks)
            next_right = rights[-1] if rights else len(self.ranks)
            across = self.ranks.get(self.bytes[a] + self.bytes[b])
            # Of equal ranks, merging takes the leftmost pair first.
            if across is not None and across < next_left and across <= next_right:
                return False
            if not lefts and not rights:
                return True
            if next_left <= next_right:
                rights.append(b)
            else:
                lefts.append(a)

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        readings, closed = [], None
        for waiting, before, node in self.states[state]:
            node = self.next.get(node << 8 | byte)
            if node is None:
                continue
            if self.grows[node]:
                readings.append((waiting, before, node))
            token = self.token_at[node]
            if closed is None and token >= 0 and self.may_follow(before, token):
                closed = (waiting + (token,), token, 0)
        # Every string has one way to be merged, so one reading closes here; it opened last.
        readings.append(closed)
        # What all readings agree on is certain by now.
        first = readings[0][0]
        agreed = 0
        if first:
            for column in zip(*[w for w, _, _ in readings]):
                if len(set(column)) > 1:
                    break
                agreed += 1
        reached = tuple([(w[agreed:], b, p) for w, b, p in readings]) if agreed else tuple(readings)
        number = self.number.get(reached)
        if number is None:
            number = self.number[reached] = len(self.states)
            self.states.append(reached)
            self.moves.append({})
            self.last.append(reached[-1][0])
        result = number, first[:agreed]
        self.moves[state][byte] = result
        self.n_moves += 1
        return result

    def encode_piece(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        if self.n_moves > self.MOST_TRANSITIONS:
            self._forget()
        state, out, moves = 0, [], self.moves
        for byte in piece:
            move = moves[state].get(byte) or self._move(state, byte)
            state, emitted = move
            if emitted:
                out += emitted
        out += self.last[state]
        return out

    def known(self, piece: str) -> list[int]:
        """The ids of one piece, looked up if it was met before."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.encode_piece(piece.encode())
            if len(piece) <= 64:
                if len(self.pieces) > self.MOST_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def encode(self, pieces: Iterable[str]) -> list[int]:
        """The ids of all pieces end to end; repeated pieces are looked up."""
        out: list[int] = []
        for piece in pieces:
            out += self.known(piece)
        return out


#: A blank that does not stand alone before other text; then pieces depend on more than one word.
LOOSE_BLANK = regex.compile(r" (?:\s|\Z)")


def encode_text(coder: Transducer, split, text: str) -> list[int]:
    """The ids of a whole text.

    With the public pattern a single blank always begins a new piece with what follows, so the text
    can be cut before every such blank, and words met before are looked up as a whole.
    """
    if split.pattern != public_tokenizers.PATTERN or LOOSE_BLANK.search(text):
        return coder.encode(split.findall(text))
    words = text.split(" ")
    out = coder.encode(split.findall(words[0]))
    known = coder.spaced
    if len(known) > coder.MOST_PIECES:
        known.clear()
    for word in words[1:]:
        ids = known.get(word)
        if ids is None:
            # Letters are one piece, and so is a mark after them.
            if word.isalpha():
                # Held here under the word; no need to hold the piece, too.
                ids = coder.pieces.get(" " + word) or coder.encode_piece((" " + word).encode())
            elif word[-1] in ".,;:" and word[:-1].isalpha():
                ids = coder.known(" " + word[:-1]) + coder.known(word[-1])
            else:
                ids = coder.encode(split.findall(" " + word))
            if len(word) <= 64:
                known[word] = ids
        out += ids
    return out


class Utf8Stream:
    """Incremental UTF-8: bytes in any pieces in, whole characters out."""

    def __init__(self) -> None:
        self.open = b""
        self.valid = True

    @staticmethod
    def missing(tail: bytes) -> int:
        """Bytes that the last character of ``tail`` still lacks."""
        for back in range(1, min(4, len(tail)) + 1):
            byte = tail[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                size = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return max(0, size - back)
        return 0

    def push(self, piece: bytes) -> str:
        piece = self.open + piece
        cut = len(piece)
        if self.missing(piece):
            cut -= next(b for b in range(1, 5) if piece[-b] >= 0xC0)
        self.open = piece[cut:]
        try:
            return piece[:cut].decode("utf-8")
        except UnicodeDecodeError:
            self.valid = False
            return piece[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        self.valid &= not self.open
        rest, self.open = self.open.decode("utf-8", "replace"), b""
        return rest


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per worker process."""
    return Transducer(read_ranks(path))


@lru_cache(maxsize=4)
def splitter(pattern: str):
    return regex.compile(pattern)


def decode(ids: list[int], coder: Transducer, piece: int = 8192) -> Iterator[tuple[bytes, str]]:
    """Bytes and whole characters of the ids, ``piece`` tokens at a time; the last pair closes the stream."""
    stream, table = Utf8Stream(), coder.bytes
    for start in range(0, len(ids), piece):
        part = b"".join(map(table.__getitem__, ids[start : start + piece]))
        yield part, stream.push(part)
    rest = stream.close()
    if rest:
        yield b"", rest


def bpe_round_trip(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode every whole text, decode the ids again, and report counts and digests of both.

    ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit numbers),
    ``decoded_sha256`` (decoded bytes), ``n_chars`` and ``valid_utf8`` of the streamed characters.
    A null or empty text has no tokens and the digests of nothing.  Rows are independent: repeated
    ids or texts give a row each, an empty table gives no row, other columns are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        coder, split = transducer(path), splitter(pattern)
        for batch, texts in slices(batches):
            out = []
            for text in texts:
                ids = encode_text(coder, split, text.decode("utf-8", "replace"))
                digest, n_chars = hashlib.sha256(), 0
                valid = True
                for part, chars in decode(ids, coder):
                    digest.update(part)
                    n_chars += len(chars)
                    valid &= "�" not in chars or b"\xef\xbf\xbd" in text
                out.append((len(ids), hashlib.sha256(np.array(array("I", ids), "<u4").tobytes()).hexdigest(), digest.hexdigest(), n_chars, valid))
            counts, encoded, decoded, chars, valid = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded), pa.array(chars, pa.int64()), pa.array(valid)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_chars", "valid_utf8"],
            )

    return map_texts(docs, run, SCHEMA)


def encoded(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and the ids of every whole text; null texts have an empty list."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        coder, split = transducer(path), splitter(pattern)
        for batch, texts in slices(batches):
            ids = [encode_text(coder, split, t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_texts(docs, run, "doc_id long, ids array<int>")
