"""Token ids of whole texts, as the `tokenizers` library gives them for a byte-level vocabulary.

Texts of plain Latin script are cut into words on the bytes of many texts at once, and a word's ids
come from a bounded table of words seen before, or from the same vocabulary as ranks. Every other
text goes through the library itself, so that the ids are the same either way.
"""

from __future__ import annotations

import base64

import numpy as np

from landgrid.llm import common

WORDS = 300_000          # words whose ids a Python worker remembers

_BYTES = np.arange(256)
LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
_KIND = np.full(256, OTHER, np.uint8)
_KIND[(_BYTES >= 128) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128)] = LETTER
_KIND[48:58] = DIGIT
_KIND[[9, 10, 13, 32]] = SPACE
#: lead bytes C3 to C9 are letters but for the two signs below; any other long character is not plain
_FOREIGN = ((_BYTES >= 128) & ~((_BYTES >= 0x80) & (_BYTES <= 0xBF)) & ~((_BYTES >= 0xC3) & (_BYTES <= 0xC9))) \
    | (_BYTES < 32) & ~np.isin(_BYTES, [9, 10, 13]) | (_BYTES == 127)
_SHORT = np.zeros(256, bool)
_SHORT[[ord(c) for c in "strvmld"]] = True       # letters that may follow an apostrophe in a contraction
_SPECIAL = b"<|endoftext|>"

_open: dict = {}


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of texts under a vocabulary file and, for speed, the same vocabulary as ranks."""

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.pieces = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.pieces = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[bytes, bytes] = {}      # a word's ids as little-endian 32-bit numbers

    @classmethod
    def of(cls, vocabulary: str, ranks: str | None) -> Encoder:
        """One encoder for each Python worker."""
        if (vocabulary, ranks) not in _open:
            _open[vocabulary, ranks] = cls(vocabulary, ranks)
        return _open[vocabulary, ranks]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """For each text its ids, an array of unsigned 32-bit integers."""
        for first, last in common.blocks(offsets):
            low, end = int(offsets[first]), int(offsets[last])
            block, edges = data[low:end], offsets[first:last + 1] - low
            if self.pieces is None:
                plain, words, cuts = np.zeros(last - first, bool), [], np.zeros(last - first + 1, np.int64)
            else:
                plain, words, cuts = self._words(block, edges)
            if not plain.all():                     # words of other texts are not to be looked up
                kept = [words[cuts[k]:cuts[k + 1]] if plain[k] else [] for k in range(last - first)]
                cuts, words = np.cumsum([0, *map(len, kept)]), [w for text in kept for w in text]
            found = self._ids(words)
            for k in range(last - first):
                if plain[k]:
                    yield np.frombuffer(b"".join(found[cuts[k]:cuts[k + 1]]), "<u4")
                else:
                    text = block[edges[k]:edges[k + 1]].tobytes().decode()
                    yield np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _words(self, block: np.ndarray, edges: np.ndarray):
        """Which texts are plain, all words of the block, and where each text's words begin."""
        after = np.r_[block[1:], np.uint8(0)]
        odd = _FOREIGN[block] | (block == 39) & _SHORT[after] | (block == 0xC3) & ((after == 0x97) | (after == 0xB7))
        plain = np.diff(np.r_[0, np.cumsum(odd)][edges]) == 0
        if _SPECIAL in block.tobytes():
            for k in range(len(plain)):
                plain[k] &= _SPECIAL not in block[edges[k]:edges[k + 1]].tobytes()
        kind = _KIND[block]
        space = kind == SPACE
        head, tail = np.zeros(len(block) + 1, bool), np.zeros(len(block) + 1, bool)
        head[edges], tail[edges] = True, True
        head, tail = head[:-1], tail[1:]                       # first and last byte of a text
        before = np.r_[np.uint8(OTHER), kind[:-1]]
        blank_before = np.r_[False, block[:-1] == 32]
        word_after = np.r_[~space[1:], False] & ~tail
        start = head | ~space & (kind != before) & ~blank_before | space & (before != SPACE) | space & word_after
        at = np.flatnonzero(start)
        words = np.insert(block, at, 0xFF).tobytes().split(b"\xff")[1:]
        return plain, words, np.searchsorted(at, edges)

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes."""
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > WORDS:
                self.known.clear()
            missing = {words[k] for k, ids in enumerate(found) if ids is None}
            for word in missing:
                self.known[word] = np.array(self.pieces.encode_ordinary(word.decode()), "<u4").tobytes()
            found = [self.known[w] if ids is None else ids for w, ids in zip(words, found)]
        return found
