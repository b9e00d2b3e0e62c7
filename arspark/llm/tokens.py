"""Token ids of whole texts from public vocabulary files, fast enough for a corpus.

``WordEncoder`` gives the ids that ``tokenizers`` gives for a vocabulary whose
pre-tokenizer never joins across white space, but calls it only for pieces of
words that it hasn't met. ``ByteEncoder`` wraps a byte-level vocabulary of ``tiktoken`` and
gives every token's byte length, so offsets are a running sum.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache
from itertools import chain

import numpy as np

from arspark.llm.text import LOWER, NOT_SPACE, hash_slices

#: Pieces kept in a worker's store; a full store is emptied.
STORE_PIECES = 300_000


def byte_chars() -> dict[int, int]:
    """Code point that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    table, n = {}, 256
    for b in range(256):
        table[b] = b if b in shown else n
        n += b not in shown
    return table


class WordEncoder:
    """Ids of texts, each distinct piece of a word encoded once.

    Valid for a tokenizer that treats ASCII white space as a separator to drop,
    splits letters from other characters (but for contractions), lower-cases,
    and then applies byte-pair merges inside each piece. Pieces are runs of
    letters (ASCII, and those of U+00C0-U+00FF) and runs of other characters;
    a word that holds an apostrophe, ``<|`` or any other character beyond ASCII
    is one piece, and ``tokenizers`` gets it as it stands. Checked against
    whole-text encoding in the tests.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.chars = byte_chars()
        self.empty()

    def empty(self) -> None:
        """Forget all pieces; a worker that waits for other work holds no store."""
        self.entry: dict[int, int] = {}
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.used = 0
        self.at = np.zeros(1 << 16, dtype=np.int64)
        self.size = np.zeros(1 << 16, dtype=np.int64)

    def _add(self, keys: list[int], ids: list[list[int]]) -> None:
        k, size = len(self.entry), np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(size.sum())
        while k + len(ids) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.at, self.size))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.at[k:k + len(ids)] = self.used + np.cumsum(size) - size
        self.size[k:k + len(ids)] = size
        self.used += total
        self.entry.update(zip(keys, range(k, k + len(ids))))

    def _pieces(self, raw: np.ndarray, off: np.ndarray):
        """Bytes with letters lower-cased, and each piece's class (1 letters), start, end and row bounds."""
        n = len(raw)
        data = np.zeros(n + 8, dtype=np.uint8)
        data[:n] = LOWER[raw]
        word = NOT_SPACE[raw]
        letter = (data[:n] >= 97) & (data[:n] <= 122)
        odd_byte = raw >= 128
        lead = np.flatnonzero(raw[:-1] == 0xC3) if n > 1 else np.zeros(0, np.int64)
        if len(lead):
            tail = raw[lead + 1]
            upper = lead[(tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)] + 1
            data[upper] += 0x20
            lead = lead[(tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)]
            letter[lead] = letter[lead + 1] = True
            odd_byte[lead] = odd_byte[lead + 1] = False
        odd_byte |= raw == 39
        odd_byte[:-1] |= (raw[:-1] == 60) & (raw[1:] == 124)
        full = off[:-1] < off[1:]
        heads = off[:-1][full]
        edge = np.zeros(n + 1, dtype=bool)
        edge[heads] = True
        edge[n] = True
        kind = np.where(letter, 1, 2).astype(np.int8)
        kind[~word] = 0
        at = np.flatnonzero(odd_byte & word)
        if len(at):
            starts = word.copy()
            starts[1:] &= ~word[:-1]
            starts[heads] = word[heads]
            ends = word.copy()
            ends[:-1] &= ~word[1:]
            tails = off[1:][full] - 1
            ends[tails] = word[tails]
            starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
            w = np.unique(np.searchsorted(starts, at, "right") - 1)
            paint = np.zeros(n + 1, dtype=np.int8)
            paint[starts[w]] += 1
            paint[ends[w]] -= 1
            whole = np.cumsum(paint[:-1], dtype=np.int8) > 0
            kind[whole] = 3
            data[:n][whole] = raw[whole]
        edge[1:n] |= kind[1:] != kind[:-1]
        cut = np.flatnonzero(edge)
        k = kind[cut[:-1]]
        some = k > 0
        starts, ends, k = cut[:-1][some], cut[1:][some], k[some]
        return data, k, starts, ends, np.searchsorted(starts, off)

    def encode_block(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts raw[off[i]:off[i + 1]] one after another, and the n + 1 bounds of each text's ids."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        data, kind, starts, ends, first = self._pieces(raw, off)
        keys = hash_slices(data, starts, ends) ^ (kind == 3).astype(np.uint64)
        keys, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.entry) > STORE_PIECES:
            self.empty()
        get, listed = self.entry.get, keys.tolist()
        entry = np.array([get(k, -1) for k in listed], dtype=np.int64)
        new = np.flatnonzero(entry < 0)
        if len(new):
            buf = data.tobytes()
            tokenize, chars, full = self.model.tokenize, self.chars, self.full
            i, found = where[new], []
            for a, b, k in zip(starts[i].tolist(), ends[i].tolist(), kind[i].tolist()):
                if k == 1:
                    found.append([t.id for t in tokenize(buf[a:b].decode("latin-1").translate(chars))])
                else:
                    found.append(full.encode(buf[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids)
            entry[new] = len(self.entry) + np.arange(len(new))
            self._add([listed[u] for u in new.tolist()], found)
        e = entry[back]
        size = self.size[e]
        bound = np.zeros(len(e) + 1, dtype=np.int64)
        np.cumsum(size, out=bound[1:])
        ids = self.ids[np.repeat(self.at[e] - bound[:-1], size) + np.arange(bound[-1])]
        return ids, bound[first]


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class ByteEncoder:
    """Ids and byte lengths of a byte-level vocabulary file of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for b, i in ranks.items():
            self.size[i] = len(b)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the byte position where each token starts, with the total at the end."""
        ids = np.array(self.enc.encode_ordinary(text), dtype=np.int64)
        at = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(self.size[ids], out=at[1:])
        return ids, at


@lru_cache(maxsize=4)
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)
