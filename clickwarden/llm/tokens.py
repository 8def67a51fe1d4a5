"""Token ids of whole texts with a public tokenizer file, with a bounded memo of text chunks.

The tokenizer drops white space and no token reaches over it, so the ids of a text are the
ids of its space-separated chunks one after the other. Chunks repeat, so each worker keeps
the ids of the chunks it has seen, up to a bound: when half of it is full, chunks that are not
met again while the other half fills are forgotten. Texts with unusual white space go to the
tokenizer whole.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array

import numpy as np

from clickwarden.llm.common import memo_of

# The mark between chunks, and white space on which str.split and the tokenizer might differ.
_UNUSUAL = re.compile("[\x01\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
# Letters whose lower case might differ between libraries.
_WIDE = re.compile("[^\x00-\u012f]")
MARK = "\x01"
# Two halves, each as large as a dict gets before its table of 2^20 places doubles.
MOST_CHUNKS = 1_390_000
_encoders: dict[tuple[str, int], ChunkEncoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ends_in_letter(word: str) -> bool:
    """Whether the word as the tokenizer sees it ends in a letter: some letters become one and a mark."""
    last = word[-1:]
    return last.isalpha() and (last.isascii() or unicodedata.normalize("NFC", last).lower()[-1].isalpha())


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, max_chunks: int = MOST_CHUNKS, max_chunk_chars: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_chunks, self.max_chunk_chars = max_chunks, max_chunk_chars
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the half that was filled before
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.letters = self.plain_letters()
        self.tails: dict[str, bytes] = {"": b""}

    def plain_letters(self) -> dict[int, str]:
        """Lower-case letters below U+0130 as the model sees them; empty if it sees words otherwise."""
        splitter, model, out = self.tokenizer.pre_tokenizer, self.tokenizer.model, {}
        for number in range(0x130):
            letter = chr(number)
            if letter.isalpha() and letter.lower() == letter:
                seen = splitter.pre_tokenize_str(letter) if splitter else [(letter, None)]
                if len(seen) != 1 or [t.id for t in model.tokenize(seen[0][0])] != list(memoryview(self.whole(letter)).cast("I")):
                    return {}
                out[number] = seen[0][0]
        every = "".join(map(chr, out))
        same = [t.id for t in model.tokenize(every.translate(out))] == list(memoryview(self.whole(every)).cast("I"))
        return out if same and all(out[n] == chr(n) for n in range(97, 123)) else {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def forget(self) -> None:
        self.memo, self.older, self.tails = {}, {}, {"": b""}

    def tail(self, end: str) -> bytes:
        """Ids of the ASCII punctuation after a letter, a unit of its own for the tokenizer."""
        ids = self.whole(end)
        if len(self.tails) < 10_000 and len(end) <= self.max_chunk_chars:
            self.tails[end] = ids
        return ids

    def new_chunks(self, chunks: list[str], plain: bool) -> dict[str, bytes]:
        """Ids of chunks that are not known yet; their words are known from now on.

        Closing punctuation after a letter is encoded for itself, and in ``plain`` texts
        case does not matter, so a chunk is looked up once more without them before it is encoded.
        """
        tails, memo, older, cores, ends = self.tails, self.memo, self.older, [], []
        for chunk in chunks:
            end = ""
            if not chunk[-1].isalnum():
                core = chunk.rstrip(string.punctuation)
                if ends_in_letter(core) and "<|" not in chunk:
                    chunk, end = core, chunk[len(core):]
            ends.append(tails[end] if end in tails else self.tail(end))
            cores.append(chunk)
        if plain:
            cores = [core.lower() for core in cores]
        parts = [memo.get(core) or older.get(core) for core in cores]
        wanted = list({core for core, part in zip(cores, parts) if part is None})
        fresh: dict[str, bytes] = {}
        if plain and self.letters:
            fresh.update(self.encode_words([w for w in wanted if w.isalpha()]))
            wanted = [w for w in wanted if w not in fresh]
        if wanted:
            fresh.update(self.encode_each(wanted))
        # a chunk is remembered when its word has been met before, else the word is
        found = {chunk: part + end for chunk, part, end in zip(chunks, parts, ends, strict=True) if part is not None}
        self.remember(found)
        self.remember(fresh)
        found.update((chunk, fresh[core] + end) for chunk, core, part, end in zip(chunks, cores, parts, ends) if part is None)
        return found

    def remember(self, ids: dict[str, bytes]) -> None:
        if len(self.memo) + len(ids) > self.max_chunks // 2:
            self.memo, self.older = {}, self.memo
        memo = self.memo
        memo.update(ids)
        for chunk in [c for c in ids if len(c) > self.max_chunk_chars]:  # these would fill the memo
            del memo[chunk]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Lower-case words of plain letters are one unit for the model, which can be asked directly."""
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        return {w: array("I", [t.id for t in tokenize(w if w.isascii() else w.translate(letters))]).tobytes() for w in words}

    def encode_each(self, chunks: list[str]) -> dict[str, bytes]:
        """Encoded as one text with marks between."""
        if self.mark is not None and len(chunks) > 1:
            ids = np.array(self.tokenizer.encode_batch_fast(
                [f" {MARK} ".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
            stops = [*(4 * np.flatnonzero(ids == self.mark)).tolist(), 4 * len(ids)]
            if len(stops) == len(chunks):
                data = ids.tobytes()
                return {c: data[a:b] for c, a, b in zip(chunks, [0, *(a + 4 for a in stops)], stops, strict=False)}
        return {c: self.whole(c) for c in chunks}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not (text.isascii() and text.isprintable()) and _UNUSUAL.search(text):
            return self.whole(text)
        chunks, memo = text.split(), self.memo
        parts = list(map(memo.get, chunks))
        if None in parts:
            places = [i for i, part in enumerate(parts) if part is None]
            missing, older = list({chunks[i] for i in places}), self.older
            new = {chunk: older[chunk] for chunk in missing if chunk in older}
            if new:
                self.remember(new)
                missing = [chunk for chunk in missing if chunk not in new]
            if missing:
                plain = "<|" not in text and (text.isascii() or not _WIDE.search(text))
                new.update(self.new_chunks(missing, plain))
            for i in places:
                parts[i] = new[chunks[i]]
        return b"".join(parts)


def _forget() -> None:
    for one in _encoders.values():
        one.forget()


def encoder(path: str, max_chunks: int = MOST_CHUNKS) -> ChunkEncoder:
    """This process's encoder for a tokenizer file."""
    memo_of("tokens", _forget)
    key = (path, max_chunks)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, max_chunks)
    return _encoders[key]
