"""Public tokenizers applied to distinct words.

A byte-level BPE never merges across the pieces its pattern splits, so a text's ids are the ids of
its words one after the other. A word here is a run of non-space characters with one space
before it, or white space that no such word takes: every cut lies on a cut of the pattern.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from shelfcast.llm import words as W

# Characters that the tokenizer's pattern counts as white space beyond ASCII (fixed values).
WIDE_SPACE = "\x85\xa0                　"
# First bytes of their UTF-8 forms: texts with one of these are split by the exact pattern.
_WIDE_FORMS = [c.encode() for c in WIDE_SPACE]
# Words are encoded in joint texts of so many.
JOINT = 512


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, without truncation and padding; one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def specials(path: str) -> tuple[bytes, ...]:
    return tuple(t.content.encode() for t in load(path).get_added_tokens_decoder().values())


@lru_cache(maxsize=4)
def _odd(path: str) -> re.Pattern[bytes]:
    """Finds what a plain word must not hold: white space of any kind and special tokens."""
    return re.compile(b"|".join([rb"[\x09-\x0D\x20]", *(re.escape(f) for f in (*_WIDE_FORMS, *specials(path)))]))


def split(data: np.ndarray, offsets: np.ndarray, path: str) -> W.Words:
    """Pieces that tile every text. A text with wide spaces or special tokens is one piece."""
    size = len(data)
    space = W.SPACE[data]
    mark = np.zeros(size + 1, bool)
    full = offsets[1:] > offsets[:-1]
    head = offsets[:-1][full]
    first = np.zeros(size + 1, bool)
    first[head] = True
    after_space = np.zeros(size, bool)
    if size:
        after_space[1:] = space[:-1]
    after_space &= ~first[:size]
    mark[:size] = space & ~after_space  # a run of spaces begins
    solid = np.flatnonzero(~space & after_space)  # a word after a space
    mark[solid - 1] = True
    mark[solid[data[solid - 1] != 32]] = True
    mark[head] = True
    mark[size] = False
    # Rare texts as a whole: found by their bytes.
    if size and bool((data >= 0xC2).any() or len(specials(path))):
        whole = data.tobytes()
        odd = {i for form in (*_WIDE_FORMS, *specials(path)) if form in whole for i in _texts_with(whole, form, offsets)}
        for i in odd:
            mark[offsets[i] + 1 : offsets[i + 1]] = False
    starts = np.flatnonzero(mark)
    nonempty_ends = np.append(starts[1:], size) if len(starts) else starts
    return W.Words(data, offsets, starts, nonempty_ends, np.searchsorted(starts, offsets))


def _texts_with(whole: bytes, form: bytes, offsets: np.ndarray) -> set[int]:
    found, at = set(), whole.find(form)
    while at >= 0:
        i = int(np.searchsorted(offsets, at, "right")) - 1
        found.add(i)
        at = whole.find(form, max(at + 1, int(offsets[i + 1])))
    return found


def encode_words(path: str, words: list[bytes]) -> list[np.ndarray]:
    """Ids of every word. Plain words share one call, with line ends between them."""
    tokenizer = load(path)
    end = tokenizer.encode("\n", add_special_tokens=False).ids
    out: list = [None] * len(words)
    odd = _odd(path).search
    plain, other = [], []
    for i, word in enumerate(words):
        body = word[1:] if word[:1] == b" " else word
        easy = len(body) and not odd(body)
        (plain if easy and len(end) == 1 else other).append(i)
    joint = ["\n".join(words[i].decode() for i in plain[k : k + JOINT]) for k in range(0, len(plain), JOINT)]
    for k, coded in enumerate(tokenizer.encode_batch_fast(joint, add_special_tokens=False)):
        ids = np.array(coded.ids, np.uint32)
        cut = np.flatnonzero(ids == end[0])
        begin, stop = np.concatenate([[0], cut + 1]), np.append(cut, len(ids))
        group = plain[k * JOINT : (k + 1) * JOINT]
        if len(begin) != len(group):
            raise RuntimeError("the tokenizer does not keep line ends apart")
        for i, a, b in zip(group, begin.tolist(), stop.tolist()):
            out[i] = ids[a:b]
    for i, coded in zip(other, tokenizer.encode_batch_fast([words[i].decode() for i in other], add_special_tokens=False)):
        out[i] = np.array(coded.ids, np.uint32)
    return out


class Generation:
    """Words with their ids: sorted hashes, and per word a range of the flat ids."""

    def __init__(self):
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bounds, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' slots, and whether they are here."""
        if not len(self.keys):
            return np.zeros(len(value), np.int64), np.zeros(len(value), bool)
        place = np.minimum(np.searchsorted(self.keys, value), len(self.keys) - 1)
        return self.at[place], self.keys[place] == value

    def ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in these slots, joined, and the number of each word."""
        begin, length = self.bounds[slots], self.bounds[slots + 1] - self.bounds[slots]
        stop = np.cumsum(length)
        return self.flat[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(begin - (stop - length), length)], length

    def add(self, value: np.ndarray, flat: np.ndarray, length: np.ndarray) -> None:
        """Take in words that are not here yet."""
        slots = np.arange(len(self.bounds) - 1, len(self.bounds) - 1 + len(value))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(length)])
        self.flat = np.concatenate([self.flat, flat])
        order = np.argsort(value)
        place = np.searchsorted(self.keys, value[order])
        self.keys, self.at = np.insert(self.keys, place, value[order]), np.insert(self.at, place, slots[order])


class WordCache:
    """Ids of words seen by this Python worker, about ``limit`` words in two generations.

    Words used again move on to the young generation; when it is full, it becomes the old one and the
    old one goes. So frequent words stay, and only those that did not come up for long are forgotten.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        self.path, self.limit = path, limit
        self.young, self.old = Generation(), Generation()

    def ids(self, block: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, joined, and the texts' bounds in them."""
        value, first, code = np.unique(block.hashes(), return_index=True, return_inverse=True)
        if len(self.young.keys) + len(value) > self.limit // 2:
            self.young, self.old = Generation(), self.young
        new = np.flatnonzero(~self.young.find(value)[1])
        if len(new):
            slots, known = self.old.find(value[new])
            flat, length = self.old.ids(slots[known])
            coded = encode_words(self.path, block.texts(first[new[~known]]))
            more = np.array([len(x) for x in coded], np.int64)
            order = np.concatenate([new[known], new[~known]])
            self.young.add(value[order], np.concatenate([flat, *coded]), np.concatenate([length, more]))
        flat, length = self.young.ids(self.young.find(value)[0][code])
        return flat, np.concatenate([[0], np.cumsum(length)])[block.bounds]


@lru_cache(maxsize=2)
def cache(path: str) -> WordCache:
    return WordCache(path)


def piece_bytes(path: str) -> list[bytes]:
    """Bytes that each id stands for; special tokens stand for their text."""
    tokenizer = load(path)
    # The usual printable stand-ins of byte-level vocabularies, built by their rule.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand = {chr(b): b for b in shown}
    stand |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = []
    for i in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(i)
        out.append(special[i] if i in special else bytes(stand[c] for c in token))
    return out
