"""Public byte-level vocabularies: reading, pre-tokens, and two encoders that share them.

`piece_model` serialises a sentencepiece BPE model directly from a vocabulary of byte strings and ranks: every token
becomes a piece of byte-mapped characters with the score -rank, the normaliser is the identity. Pre-tokens are encoded
by it one by one; a bounded memory of frequent ones spares most calls. `count_symbols` counts the tokens of a pre-token
without a library: a linked list of symbols and a priority queue of merges.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import struct
from functools import cache
from itertools import chain

DEFAULT_DIR = "/opt/tokenizers"
#: Pre-tokens remembered by a worker, and the longest one that is; beyond, they are encoded each time.
MEMORY, LONGEST = 400_000, 64


@cache
def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the next one from 256 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(rest)) for b in range(256)]


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a `.tiktoken` file, or of the `.json` file of a byte-level BPE."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    back = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"] for t in data.get("added_tokens", [])}
    return {bytes(back[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in special}


def vocabulary_path(name: str, folder: str | None = None) -> str:
    folder = folder or os.environ.get("TOKENIZER_DIR", DEFAULT_DIR)
    for ending in ("", ".tiktoken", ".json"):
        if os.path.isfile(path := os.path.join(folder, name + ending)):
            return path
    raise FileNotFoundError(f"no vocabulary {name} in {folder}")


#: The public pre-token pattern: contractions, letters, numbers, other marks, white space. A fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def pre_token_pattern(pattern: str = PATTERN):
    import regex

    return regex.compile(pattern)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol-buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def piece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose piece ids are the ranks; the unknown piece comes last.

    Gaps in the ranks are filled with pieces of type UNUSED, which are never produced.
    """
    letters = byte_letters()
    size = max(ranks.values()) + 1
    pieces: list[bytes] = [_field(1, f"<unused_{i}>".encode()) + _field(2, 0.0) + _field(3, 5) for i in range(size)]
    for token, rank in ranks.items():
        text = "".join([letters[b] for b in token]).encode()
        pieces[rank] = _field(1, text) + _field(2, -float(rank)) + _field(3, 1)
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(pieces))  # model_type BPE, vocab_size
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, no space handling
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Encoder:
    """Text <-> ids of a byte-level vocabulary; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        import sentencepiece

        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(piece_model(self.ranks))
        self.split = pre_token_pattern().findall
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.latin = str.maketrans(dict(enumerate(byte_letters())))
        self.memory: dict[str, list[int]] = {}

    def mapped(self, piece: str) -> str:
        return piece.encode("utf-8", "replace").decode("latin-1").translate(self.latin)

    def learn(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of pre-tokens that the memory lacks; remembers the shorter ones."""
        ids = dict(zip(pieces, self.model.encode([self.mapped(p) for p in pieces], num_threads=1)))
        self.memory.update((p, i) for p, i in ids.items() if len(p) <= LONGEST)
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null and empty give an empty list."""
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        if len(self.memory) > MEMORY:
            self.memory.clear()
        pieces = [self.split(t) if t else [] for t in texts]
        memory = self.memory
        if new := set().union(*pieces).difference(memory.keys()):
            learnt = self.learn(list(new))
            if any(len(p) > LONGEST for p in new):
                memory = _Both(learnt, self)
        at = memory.__getitem__
        return [list(chain.from_iterable(map(at, ps))) for ps in pieces]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, by the inverse of the byte mapping; broken sequences give replacement characters."""
        back = {c: b for b, c in enumerate(byte_letters())}
        return bytes(back[c] for i in ids for c in self.model.id_to_piece(int(i))).decode("utf-8", "replace")


class _Both(dict):
    """A batch's own ids, then the memory, then the model."""

    def __init__(self, own: dict, encoder: Encoder):
        super().__init__(own)
        self.encoder = encoder

    def __missing__(self, piece: str) -> list[int]:
        ids = self.encoder.memory.get(piece)
        if ids is None:
            ids = self.encoder.learn([piece])[piece]
        self[piece] = ids
        return ids


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def count_symbols(piece: bytes, ranks: dict[bytes, int]) -> int:
    """How many tokens a pre-token has: merges from a priority queue over a linked list of symbols, until none applies."""
    n = len(piece)
    if n < 2 or piece in ranks:
        return min(n, 1)
    start, after, before = list(range(n)), [*range(1, n), -1], [-1, *range(n - 1)]
    end, alive = list(range(1, n + 1)), n
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        j = after[i] if end[i] > 0 else -1
        if j < 0 or end[j] != stop:
            continue  # one of the two has been merged since
        end[i], end[j] = stop, 0
        after[i] = k = after[j]
        alive -= 1
        if k >= 0:
            before[k] = i
            if (r := ranks.get(piece[start[i] : end[k]])) is not None:
                heapq.heappush(queue, (r, i, end[k]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[start[h] : stop])) is not None:
            heapq.heappush(queue, (r, h, stop))
    return alive
