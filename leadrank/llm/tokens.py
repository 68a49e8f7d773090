"""Whole texts to token ids with a public vocabulary file.

The byte-level pattern starts a new piece at every blank that follows a character other than white space, and no piece
depends on what comes before it. So a text without white space before a blank and without special tokens is the sum
of its blank-separated words. Arrow splits a group of texts and numbers its different words; each of those is looked up
or encoded once, and numpy deals out their ids. Other texts are encoded as they are.
"""
from __future__ import annotations

import functools
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
END = 0  # id that closes each document
#: Bytes of text that are taken at once, so that memory follows this and the longest text.
GROUP_BYTES = 6_000_000
#: Texts that callers give to `encode` at once: the more, the fewer words are looked up again.
TEXTS_AT_ONCE = 4000
#: Words that a Python worker remembers before it forgets half of them, and words that are encoded in one call.
WORDS_KEPT, WORDS_AT_ONCE = 800_000, 1000
#: Longer words are encoded by themselves and soon forgotten.
LONG_WORD = 100
_MARKS = ",.;:!?"
_ENDED = f"^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+[{_MARKS}]$"
_LETTERS_BELOW = "\u0250"  # letters that every version of Unicode calls so
#: White space before a blank, for Arrow's regular expressions.
_BOUND_BLANK = "[\\t-\\r\\x1c-\\x1f\\x{85}\\p{Z}] "


@functools.lru_cache(maxsize=4)
def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def _direct(tokenizer, texts: list[str]) -> list[bytes]:
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class _Memory:
    """Ids of words seen before, in arrays: Arrow finds words, numpy takes their ids."""

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.flat = np.zeros(0, "<u4")
        self.starts = self.many = self.used = np.zeros(0, np.int64)
        self.turn = 0

    def find(self, words: pa.StringArray) -> np.ndarray:
        """Places of the words, -1 for those not seen."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, ids: dict[str, bytes]) -> None:
        if not ids:
            return
        many = np.fromiter(map(len, ids.values()), np.int64, len(ids)) // 4
        self.words = pa.concat_arrays([self.words, pa.array(ids, pa.string())])
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(many) - many)
        self.flat = np.append(self.flat, np.frombuffer(b"".join(ids.values()), "<u4"))
        self.many = np.append(self.many, many)
        self.used = np.append(self.used, np.full(len(ids), self.turn))

    def trim(self) -> None:
        """Forget long words, and of too many words those that were not used for longest."""
        self.turn += 1
        keep = pc.binary_length(self.words).to_numpy(zero_copy_only=False) <= 4 * LONG_WORD
        if len(keep) > WORDS_KEPT:
            keep &= self.used >= np.partition(self.used, -WORDS_KEPT // 2)[-WORDS_KEPT // 2]
        if not keep.all():
            many = self.many[keep]
            ends = np.cumsum(many)
            self.flat = self.flat[np.repeat(self.starts[keep] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)]
            self.words, self.used, self.many, self.starts = self.words.filter(pa.array(keep)), self.used[keep], many, ends - many


@functools.lru_cache(maxsize=8)
def _memory(vocabulary: str, blank: str) -> _Memory:
    """Words with `blank` before them."""
    return _Memory()


@functools.lru_cache(maxsize=4)
def _letters_model(vocabulary: str):
    """Encodes words of plain letters, each a single piece, by the tokenizer's own model: no pieces need be looked for."""
    from tokenizers import pre_tokenizers

    model = _tokenizer(vocabulary).model
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def ids_of(words: list[str], blank: str) -> Iterator[bytes]:
        for at in range(0, len(words), WORDS_AT_ONCE):
            (mapped, _), = as_bytes.pre_tokenize_str("\n".join(blank + w for w in words[at:at + WORDS_AT_ONCE]))
            for piece in mapped.split(feed):
                yield array("I", [t.id for t in model.tokenize(piece)]).tobytes()

    (feed, _), = as_bytes.pre_tokenize_str("\n")
    return ids_of


def _learn(new: list[str], blank: str, vocabulary: str) -> dict[str, bytes]:
    """Ids of different new words: those of plain letters by the model, all others by the whole tokenizer."""
    letters, odd = [], []
    for w in new:
        plain = w.isalpha() and (w.isascii() or max(w) < _LETTERS_BELOW) and len(w) <= LONG_WORD
        (letters if plain else odd).append(w)
    out = dict(zip(letters, _letters_model(vocabulary)(letters, blank)))
    out.update(zip(odd, _direct(_tokenizer(vocabulary), [blank + w for w in odd])))
    return out


def _ids_of(words: pa.StringArray, blank: str, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, numbers): the ids of each of these different words, one after another, and how many each has.

    A mark that ends a word of plain letters is a piece of its own, so only the letters before it are looked up.
    """
    memory = _memory(vocabulary, blank)
    memory.trim()
    ended = pc.match_substring_regex(words, _ENDED)
    coded = pc.if_else(ended, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
    stems = coded.dictionary
    at = memory.find(stems)
    missing = np.flatnonzero(at < 0)
    if len(missing):
        at[missing] = len(memory.words) + np.arange(len(missing))
        new = stems.take(pa.array(missing)).to_pylist()
        fresh = _learn(new, blank, vocabulary)
        memory.add({w: fresh[w] for w in new})
    memory.used[at] = memory.turn
    at = at[coded.indices.to_numpy()]
    mark = ended.to_numpy(zero_copy_only=False)
    many = memory.many[at]
    number = many + mark
    own = np.ones(int(number.sum()), bool)
    own[np.cumsum(number)[mark] - 1] = False
    ids = np.empty(len(own), "<u4")
    ids[own] = memory.flat[np.repeat(memory.starts[at] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
    marks = np.array([np.frombuffer(x, "<u4")[0] for x in _direct(_tokenizer(vocabulary), list(_MARKS))], "<u4")
    ids[~own] = marks[pc.index_in(pc.utf8_slice_codeunits(words.filter(ended), -1), value_set=pa.array(list(_MARKS))).to_numpy()]
    return ids, number


def _group(texts: pa.StringArray, vocabulary: str, last: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts in one array, and where each text's begin and end: words are told apart and dealt out by Arrow."""
    tokenizer = _tokenizer(vocabulary)
    odd = pc.match_substring_regex(texts, _BOUND_BLANK)
    if "ByteLevel" not in str(tokenizer.pre_tokenizer):
        odd = pa.array([True] * len(texts))
    for token in tokenizer.get_added_tokens_decoder().values():
        odd = pc.or_(odd, pc.match_substring(texts, token.content))
    whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    units = [last, *_direct(tokenizer, texts.filter(odd).to_pylist())]
    split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
    starts = split.offsets.to_numpy()
    coded = split.values.dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    begin = np.unique(code[starts[:-1]])
    # one table of units: the end, whole texts, first words, later words
    tables = [(np.frombuffer(b"".join(units), "<u4"), np.fromiter(map(len, units), np.int64, len(units)) // 4),
              _ids_of(words.take(pa.array(begin)), "", vocabulary), _ids_of(words, " ", vocabulary)]
    ids, many = (np.concatenate([t[i] for t in tables]) for i in (0, 1))
    places = np.cumsum(many) - many
    first = len(units) + np.searchsorted(begin, code[starts[:-1]])
    first[whole] = 1 + np.arange(len(whole))
    code += len(units) + len(begin)
    code[starts[:-1]] = first
    code = np.insert(code, starts[1:], 0)
    lengths = many[code]
    ends = np.cumsum(lengths)
    at = np.repeat((places[code] - ends + lengths).astype(np.int32), lengths)
    at += np.arange(ends[-1], dtype=np.int32)
    return ids[at], np.append(0, ends[starts[1:] + np.arange(len(texts))])


def encode(texts: list[bytes] | pa.StringArray, vocabulary: str = VOCABULARY, end: int = END) -> list[np.ndarray]:
    """Ids of each text as little-endian uint32, closed by `end`. A null text is an empty one.

    They are those of the plain library call without added special tokens: where a special token's own string stands in
    a text, it is that token.
    """
    column = pc.fill_null(pa.array(texts, pa.binary()).cast(pa.string()) if isinstance(texts, list) else texts, "")
    size = np.append(0, np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))) if len(column) else np.zeros(1, np.int64)
    out, at, last = [], 0, np.array([end], "<u4").tobytes()
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(size, size[at] + GROUP_BYTES, side="right")) - 1)
        ids, bounds = _group(column.slice(at, stop - at), vocabulary, last)
        out += [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        at = stop
    return out
