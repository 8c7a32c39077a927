"""Encoding whole texts with a public tokenizer inside an Arrow function.

The tokenizer file is read where the job is planned and its content shipped,
so executors need no local copy.  Long texts are cut at safe boundaries (a
space that follows a non-blank: both pre-tokenisers start a new piece there),
and a piece goes one of two ways with equal results:

* plain pieces (ASCII and Latin-1 letters, digits and punctuation, no
  special-token opener) are encoded here: for a byte-level vocabulary whose ids
  are its merge ranks by ``tiktoken`` from those ranks; for one with word ends
  a piece falls apart at spaces, and then into letter runs and what lies between
  them, which the pre-tokeniser never joins (pieces with a contraction or a run
  of blanks before a letter excepted); the library encodes a part when it is
  first met, later ones are looked up;
* all other pieces are encoded whole by the library.

What is remembered is emptied when full, so it is bounded; it lives as long as
the Python worker, across its tasks.
"""

from __future__ import annotations

import json
import re
from array import array

from tablesync.llm.common import remembered

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN_BYTES = bytes([9, 10, 13, *range(32, 127), *(b for b in range(0xC0, 0x100) if b not in (0xD7, 0xF7))])
CONTRACTION = re.compile(rf"'[{LETTERS}]")
# two or more blanks, the last not a space, before a letter
BLANK_RUN = re.compile(rf"[\t\n\r ][\t\n\r](?=[{LETTERS}])")
SAFE_CUT = re.compile(r"(?<=\S) ")
PIECE_CHARS = 1 << 16
MAX_PARTS = 400_000
MAX_CHUNKS = 150_000


# the byte-level pre-tokeniser's pattern (fixed value)
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def merge_ranks(tokenizer_json: str) -> dict[bytes, int] | None:
    """Ranks of a byte-level vocabulary whose ids follow its merges, else None."""
    spec = json.loads(tokenizer_json)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
            or not before.get("use_regex", True) or model.get("type", "BPE") != "BPE"
            or model.get("end_of_word_suffix") or model.get("ignore_merges") or model.get("dropout")):
        return None
    # printable bytes stand for themselves, the others for characters from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocab = model["vocab"]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    return ranks if len(ranks) == 256 + len(pairs) else None


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cut a long text before spaces that follow a non-blank; a stretch without
    such a space stays whole."""
    out, start = [], 0
    while len(text) - start > size:
        m = SAFE_CUT.search(text, start + size)
        if m is None:
            break
        out.append(text[start:m.start()])
        start = m.start()
    out.append(text[start:])
    return out


class _Memory(dict):
    """A dict that works out what it lacks and forgets all when full."""

    def __init__(self, work, limit: int):
        super().__init__()
        self.work, self.limit = work, limit

    def __missing__(self, key: str):
        value = self.work(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Token ids (or only their number) of whole texts, as the library's
    ``encode(text, add_special_tokens=False)`` gives them.  Ids come as
    little-endian uint32 bytes."""

    def __init__(self, tokenizer_json: str, lengths_only: bool,
                 max_parts: int = MAX_PARTS, max_chunks: int = MAX_CHUNKS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.lengths_only = lengths_only
        self.join = sum if lengths_only else b"".join
        # a normaliser that lower-cases and drops blanks, or none at all
        self.folds = self.tok.normalizer is not None
        self.find = re.compile(rf"[{LETTERS}]+|[^{LETTERS}]+" if self.folds
                               else rf" ?[{LETTERS}]+|[^{LETTERS}]+?(?= ?[{LETTERS}]|\Z)").findall
        self.is_word = re.compile(rf" ?[{LETTERS}]+").fullmatch
        # the byte-level alphabet, as the library itself maps a character
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.alphabet = {c: mapped(chr(c))[0][0] for c in PLAIN_BYTES}
        self.direct = None
        if ranks := merge_ranks(tokenizer_json):
            import tiktoken

            self.direct = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks,
                                            special_tokens={}).encode_ordinary
        self.parts = _Memory(self._part, max_parts)
        self.chunks = _Memory(self._chunk if self.folds else lambda c: self._chunk(" " + c), max_chunks)

    def _plain(self, piece: str) -> bool:
        try:
            raw = piece.encode("latin-1")
        except UnicodeEncodeError:
            return False
        if raw.translate(None, PLAIN_BYTES) or "<|" in piece:
            return False
        if self.direct:
            return True
        if "'" in piece and CONTRACTION.search(piece):
            return False
        return self.folds or not BLANK_RUN.search(piece)

    def _value(self, ids: list[int]) -> int | bytes:
        return len(ids) if self.lengths_only else array("I", ids).tobytes()

    def _part(self, part: str) -> int | bytes:
        if not self.is_word(part):
            return self._value(self.tok.encode(part, add_special_tokens=False).ids)
        # a word is one pre-token: straight to the library's model
        tokens = self.model.tokenize(part.translate(self.alphabet))
        return len(tokens) if self.lengths_only else self._value([t.id for t in tokens])

    def _chunk(self, chunk: str) -> int | bytes:
        return self.join(map(self.parts.__getitem__, self.find(chunk)))

    def _piece(self, piece: str) -> int | bytes:
        if self.direct:
            return self._value(self.direct(piece))
        if self.folds:
            return self.join(map(self.chunks.__getitem__, piece.lower().split()))
        if "  " in piece:
            return self._chunk(piece)
        first, *rest = piece.split(" ")
        return self.join([self._chunk(first), self.join(map(self.chunks.__getitem__, rest))])

    def batch(self, texts: list[str]) -> list[int | bytes]:
        """Per text its number of tokens, or its ids."""
        cut = [[(p, self._plain(p)) for p in pieces(t)] for t in texts]
        hard = [p for own in cut for p, plain in own if not plain]
        whole = iter(self.tok.encode_batch_fast(hard, add_special_tokens=False) if hard else ())
        return [self.join([self._piece(p) if plain else self._value(next(whole).ids) for p, plain in own])
                for own in cut]


def encoder(tokenizer_json: str, lengths_only: bool) -> Encoder:
    """This worker's encoder, kept with what it remembers from task to task."""
    return remembered(("encoder", hash(tokenizer_json), lengths_only),
                      lambda: Encoder(tokenizer_json, lengths_only))
