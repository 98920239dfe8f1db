"""Token ids of whole texts in Python workers, with a bounded cache of words."""

from __future__ import annotations

import os
import re
import string
import unicodedata
from functools import lru_cache

import numpy as np

from navrecon.llm.common import leave_room, trim

#: Every document ends with this id.
END = 1
#: The word that stands for this id behind a document.
STOP = "end of document"
#: Words that a worker keeps; beyond, it starts anew. About 100 MB.
CACHED = 450_000
#: Words that are encoded by one call.
CALL = 2000
#: Anything but characters that are in normal form C and have a simple lower case.
NOT_PLAIN = re.compile("[^\x00-\u012f\u0131-\u024f]")
#: What may end a word as one piece of its own; an apostrophe may begin a piece with letters.
TAIL = string.punctuation.replace("'", "")


def byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = (b for b in range(256) if b not in kept)
    return {**{b: b for b in kept}, **{b: 256 + i for i, b in enumerate(moved)}}


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer splits at white space before anything else, so a text's ids are
    those of its words in a row. Words new to the cache are encoded many at a time
    and told apart by their offsets. Words of plain letters, perhaps with
    punctuation behind, go to the model without its normaliser, which would change nothing
    in them; a word that is not in normal form C, whose offsets may move, is encoded by itself.
    """

    def __init__(self, path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # Added tokens are looked for in whole texts, before all else; a word that only looks like one is ordinary.
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = re.compile("|".join(f"({re.escape(a)})" for a in sorted(added, key=len, reverse=True)) or r"(?!)")
        # No word holds a space, so these keys are free.
        self.marks = {f" {a}": np.array([i], "<u4").tobytes() for a, i in [*added.items(), (STOP, END)]}
        self.tokenizer.encode_special_tokens = True
        self.bare = Tokenizer(self.tokenizer.model)  # the same model, not a second copy of it
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {b: x for b, x in byte_letters().items() if b != 32}  # spaces go on parting words
        self.cached, self.known = cached, dict(self.marks)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _keep(self, words: list[str], ids: list[int], cuts: np.ndarray) -> None:
        data, cuts = np.array(ids, "<u4").tobytes(), (cuts * 4).tolist()
        for w, a, b in zip(words, cuts, cuts[1:]):
            self.known[w] = data[a:b]

    def _learn_whole(self, words: list[str]) -> None:
        """Any words: told apart by the offsets of their ids."""
        for i in range(0, len(words), CALL):
            part = words[i:i + CALL]
            begins = np.cumsum([0] + [len(w) + 1 for w in part])
            encoding = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 0]
            self._keep(part, encoding.ids, np.searchsorted(offsets, begins))

    def _learn_letters(self, words: list[str]) -> None:
        """Words of lower-case letters, each one piece to the model."""
        for i in range(0, len(words), CALL):
            part = words[i:i + CALL]
            letters = " ".join(part).encode().decode("latin-1").translate(self.letters)
            encoding = self.bare.encode(letters, add_special_tokens=False)
            numbers = np.array(encoding.word_ids, np.int64)
            self._keep(part, encoding.ids, np.searchsorted(numbers, np.arange(len(part) + 1)))

    def _learn_plain(self, words: set[str]) -> None:
        """Words of texts in plain lower-case characters: most are letters, perhaps with punctuation behind."""
        letters, ended, whole = [], [], []
        for w in words:
            if w.isalpha():
                letters.append(w)
            elif (core := w.rstrip(TAIL)).isalpha():
                ended.append((w, core, w[len(core):]))
            else:
                whole.append(w)
        new = {x for _, core, tail in ended for x in (core, tail)}.difference(self.known, letters)
        letters += [x for x in new if x.isalpha()]
        self._learn_whole(whole + [x for x in new if not x.isalpha()])
        self._learn_letters(letters)
        known = self.known
        for w, core, tail in ended:
            known[w] = known[core] + known[tail]

    def _learn_other(self, words: set[str]) -> None:
        normal = []
        for w in words:
            if w.isascii() or unicodedata.is_normalized("NFC", w):
                normal.append(w)
            else:
                self.known[w] = self._ids(w).tobytes()
        self._learn_whole(normal)

    def encode(self, texts: list[str], ended: bool = False) -> list[bytes]:
        """Ids of each text, with the end id if ended; None counts as empty."""
        split, plain, other = [], set(), set()

        def words_of(t: str) -> list[str]:
            if NOT_PLAIN.search(t):
                words = t.replace("\n", " ").split(" ")
                other.update(words)
            else:
                # Case does not matter to the ids; lowering here leaves fewer distinct words.
                words = t.lower().replace("\n", " ").split(" ")
                plain.update(words)
            return words

        for t in texts:
            t = t or ""
            if "<" not in t or not self.added.search(t):
                split.append(words_of(t))
                continue
            words, at = [], 0
            for hit in self.added.finditer(t):
                words += [*words_of(t[at:hit.start()]), " " + hit.group()]
                at = hit.end()
            split.append(words + words_of(t[at:]))
        if ended:
            for words in split:
                words.append(f" {STOP}")
        new = plain.difference(self.known)
        if len(self.known) + len(new) + len(other) > self.cached:
            self.known = dict(self.marks)
            new = plain
        self._learn_plain(new)
        self._learn_other(other.difference(self.known))
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in split]


@lru_cache(maxsize=2)
def encoder(path: str, cached: int = CACHED) -> WordEncoder:
    """One encoder for each worker process and vocabulary."""
    own = WordEncoder(path, cached)
    trim()  # what reading the file took
    return own


def encode_all(path: str, texts, step: int = 128, cached: int = CACHED):
    """The ids of each text with the end id, a few texts at a time; a worker keeps about `cached` words."""
    leave_room("tokens")
    own = encoder(path, cached)
    for i in range(0, len(texts), step):
        yield from own.encode(texts[i:i + step].to_pylist(), ended=True)
