"""Token ids of whole texts by the ``tokenizers`` library, with a bounded memo of word ids."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

MEMO_WORDS = 300_000
PIECE = 1 << 20

# The byte-level pre-tokenizer's pattern over the code points that _PLAIN admits.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")
_OTHER = re.compile(r"[^\t\n\r -~\xa1-ɏ]")

#: A place that no pre-token spans: the space between two letters begins the next one.
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")

_encoders: dict[str, Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it is printable Latin-1, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in set(shown)]
    return {x: chr(x) for x in shown} | {x: chr(0x100 + k) for k, x in enumerate(hidden)}


class _Memo(dict):
    """Numbers words in the order they come; ``new`` lists those not encoded yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k


class Encoder:
    """Ids of the library, word by word: pre-tokens never merge across their bounds, so their ids join.

    Each word is encoded by the library's model once while the memo holds it. The memo is bounded:
    when full, the half of it that was used most since the last time stays. Texts with code points
    beyond Latin, with rare white space or with the string of an added token go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.memo = _Memo()
        self.flat = np.empty(1 << 16, np.uint32)  # the ids of all words, one after the other
        self.used = 0
        self.start = np.empty(1 << 14, np.int64)
        self.size = np.empty(1 << 14, np.int64)
        self.hits = np.zeros(1 << 14, np.int64)

    def _learn(self) -> None:
        tokenize, letters, memo = self.model.tokenize, self.letters, self.memo
        ids = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(letters))] for w in memo.new]
        n, first = len(memo), len(memo) - len(ids)
        while n > len(self.start):
            self.start, self.size, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size, self.hits))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.size[first:n] = sizes
        self.start[first:n] = self.used + np.cumsum(sizes) - sizes
        self.hits[first:n] = 0
        self.used += total
        memo.new = []

    def _age(self) -> None:
        n = len(self.memo)
        kept = np.sort(np.argsort(self.hits[:n], kind="stable")[-(MEMO_WORDS // 2) :]) if MEMO_WORDS > 1 else np.empty(0, np.int64)
        words, memo = list(self.memo), _Memo()
        for k in kept.tolist():
            memo[words[k]] = len(memo)
        ids = self._gather(kept)
        self.memo = memo
        self.size[: len(kept)] = self.size[kept]
        self.start[: len(kept)] = np.cumsum(self.size[: len(kept)]) - self.size[: len(kept)]
        self.flat[: len(ids)] = ids
        self.used = len(ids)
        self.hits[: len(kept)] = 0

    def _gather(self, index: np.ndarray) -> np.ndarray:
        size = self.size[index]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[index] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]

    def _pieces(self, text: str) -> Iterator[list[str]]:
        at = 0
        while at < len(text):
            end = at + PIECE
            if end < len(text):
                cut = _CUT.search(text, end)
                end = cut.start() if cut else len(text)
            yield _WORDS.findall(text[at:end])
            at = end

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The memo's numbers of the words, taken while their strings are still in the CPU's cache."""
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def _encode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """The ids of each list of the words' numbers."""
        counts = [len(x) for x in runs]
        index = np.concatenate(runs)
        if self.memo.new:
            self._learn()
        n = len(self.memo)
        self.hits[:n] += np.bincount(index, minlength=n)
        bounds = np.cumsum(counts)[:-1]
        ids = self._gather(index)
        ends = np.concatenate([[0], np.cumsum(self.size[index])])
        if n > MEMO_WORDS:
            self._age()
        return np.split(ids, ends[bounds])

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint32 ids of whole texts; null and empty texts have none."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        runs, whose, held = [], [], 0
        for k, text in enumerate(texts):
            if not text:
                continue
            if _OTHER.search(text) or any(t in text for t in self.added):
                out[k].append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            for words in self._pieces(text):
                runs.append(self._numbers(words))
                whose.append(k)
                held += len(words)
                if held > 1 << 18:
                    for x, ids in zip(whose, self._encode(runs), strict=True):
                        out[x].append(ids)
                    runs, whose, held = [], [], 0
        if runs:
            for x, ids in zip(whose, self._encode(runs), strict=True):
                out[x].append(ids)
        none = np.empty(0, np.uint32)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else none for x in out]

    def ids(self, text: str | None) -> np.ndarray:
        return self.batch([text])[0]


def encoder(path: str) -> Encoder:
    """The worker's encoder for this vocabulary file; loaded once for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
