"""Token ids of whole texts with a file of the ``tokenizers`` library, as packed little-endian bytes."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: Encoded chunks that a task keeps; the cache starts anew when it is full.
CACHE_CHUNKS = 400_000

#: New chunks that are merged in one call.
JOINED_CHUNKS = 20_000

#: Where a text cannot be cut at its blanks: a blank before another blank or at
#: the end, or the start of a special token's string.
_WHOLE = re.compile(r" \s| \Z|<\|")
#: Chunks whose characters every Unicode version classes alike.
_PLAIN = re.compile(r"[\n !-~\u00a1-\u024f]+")
#: Plain chunks that start with their only blank: in a row they have the ids that each has alone.
_IN_A_ROW = re.compile(r" [!-~\u00a1-\u024f][\n!-~\u00a1-\u024f]*")
#: Fixed value: the pieces of the byte-level pre-tokenizer.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TokenEncoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does, with a cache of chunks.

    The byte-level pre-tokenizer always starts a new piece at a blank followed
    by a non-blank, so such chunks have the same ids alone as in their text.
    Texts with any other blank are encoded whole.  Chunks of plain characters
    are merged by tiktoken with the file's own vocabulary, which gives the same
    ids several times faster; anything else, and any file of another kind, goes
    through the tokenizer itself.  New chunks are merged many at a time, as one
    text, and its ids are cut where the bytes of a chunk end.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._chunks: dict[str, bytes] = {}
        spec = json.loads(self._tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self._by_blank = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                          and pre.get("use_regex", True) and not spec.get("normalizer"))
        self._merge, self._id_bytes = self._merger(spec) if self._by_blank else (None, None)

    @staticmethod
    def _merger(spec: dict):
        """tiktoken's encoder and the bytes of each id if the file's ids are the ranks of its merges, else None twice."""
        import tiktoken

        model, symbols = spec["model"], _bytes_of_symbols()
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or []]
        if (model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix")
                or model.get("end_of_word_suffix") or model.get("ignore_merges")
                or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges))):
            return None, None
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(symbols[c] for c in k): v for k, v in vocabulary.items() if k not in special}
        id_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        id_bytes[list(ranks.values())] = [len(k) for k in ranks]
        return tiktoken.Encoding("file", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, id_bytes

    def _cut(self, text: str) -> list[str]:
        if not self._by_blank or "\0" in text or _WHOLE.search(text):
            return [text]
        return text.replace(" ", "\0 ").split("\0")

    def _add(self, chunks: list[str]) -> None:
        """Put the ids of new chunks into the cache."""
        merge, plain, in_a_row, rows, rest = self._merge, _PLAIN.fullmatch, _IN_A_ROW.fullmatch, [], []
        for c in chunks:
            if merge and in_a_row(c) and "<|" not in c:
                rows.append(c)
            elif merge and plain(c) and not _WHOLE.search(c):
                self._chunks[c] = array("I", merge(c)).tobytes()
            else:
                rest.append(c)
        for at in range(0, len(rows), JOINED_CHUNKS):
            self._add_joined(rows[at:at + JOINED_CHUNKS])
        for at in range(0, len(rest), 1024):
            part = rest[at:at + 1024]
            for c, e in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self._chunks[c] = array("I", e.ids).tobytes()

    def _add_joined(self, chunks: list[str]) -> None:
        ids = np.array(self._merge("".join(chunks)), "<u4")
        ends = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        stops = (4 * np.searchsorted(np.cumsum(self._id_bytes[ids]), ends) + 4).tolist()
        packed = ids.tobytes()
        self._chunks.update(zip(chunks, map(packed.__getitem__, map(slice, [0, *stops], stops))))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit little-endian bytes; a null text has none."""
        cut = [self._cut(t) if t else [] for t in texts]
        found = set().union(*cut)
        missing = list(found.difference(self._chunks))
        if len(self._chunks) + len(missing) > CACHE_CHUNKS:
            self._chunks = {}
            missing = list(found)
        self._add(missing)
        look = self._chunks.__getitem__
        out = [b"".join(map(look, chunks)) for chunks in cut]
        for chunks in cut:
            if len(chunks) == 1:  # a whole text: not worth keeping
                self._chunks.pop(chunks[0], None)
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> TokenEncoder:
    """The worker's encoder: loaded once, its cache kept from task to task."""
    return TokenEncoder(path)
