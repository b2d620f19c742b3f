"""Token ids of texts, by a given tokenizer of the tokenizers library."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words an encoder remembers before it forgets those it did not meet again, so that its memory is bounded.
REMEMBERED = 400_000
#: Bytes of text that are encoded in one go, unless a single text is longer.
STEP = 2_000_000

#: Letters of the Latin blocks, and ASCII marks that stand after them.
LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x250)) if c not in (0xD7, 0xF7)]
MARKS = ".,!?|%*&$#"
_IS_MARK = np.isin(np.arange(256), list(MARKS.encode()))
_COMBINING = r"[\x{0300}-\x{036F}]"

_encoders: dict[tuple, Encoder] = {}


class Encoder:
    """Ids of whole texts.

    With `by_word`, texts are cut at blanks, at line feeds and between a letter and the punctuation after it,
    and each different piece is encoded once. That is exact for tokenizers whose pre-tokenizer drops white space
    and keeps letters apart from punctuation, as then no rule looks across such a place; if the tokenizer
    puts texts in lower case, so is done before. A text is cut only after those letters for which this tokenizer gives letter and
    mark the same ids together and apart, which is tried when the encoder is made: `İ` in lower case ends in a dot
    above that is no letter, and stays with the mark.
    """

    def __init__(self, path: str, by_word: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [token.content for token in added.values()]
        self.divider = next(
            (
                (token.content, number)
                for number, token in sorted(added.items())
                if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
            ),
            None,
        )
        rules = json.loads(self.tokenizer.to_str())
        self.lowers = '"Lowercase"' in json.dumps(rules["normalizer"])
        suffix = rules["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.closes[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.cut = set(filter(self._keeps_apart, LETTERS))
        # the same by the one or two bytes that such a letter ends in
        self.after = np.zeros(1 << 16, bool)
        for letter in map(str.encode, self.cut):
            self.after[int.from_bytes(letter, "big") if len(letter) > 1 else np.arange(256) * 256 + letter[0]] = True
        self._forget()

    def _keeps_apart(self, letter: str) -> bool:
        """Are all marks encoded alike with and without a blank between this letter and them?"""
        words = [f"{begin}{letter}{{}}{mark}{end}" for begin in ("", "a") for mark in MARKS for end in ("", "b")]
        together, apart = (self._line(" ".join(w.format(between) for w in words)) for between in ("", " "))
        return np.array_equal(together, apart)

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.met = np.zeros(0, bool)

    def _forget_unmet(self) -> None:
        """Keep the words met again since this was last done, the newest half of what can be remembered at most."""
        kept = np.flatnonzero(self.met)[-(REMEMBERED // 2) :]
        words, size, begin = list(self.place), self.size[kept], self.begin[kept]
        after = np.cumsum(size)
        self.flat = self.flat[np.repeat(begin - after + size, size) + np.arange(after[-1] if len(after) else 0)]
        self.place = {words[i]: place for place, i in enumerate(kept.tolist())}
        self.begin, self.size, self.met = after - size, size, np.zeros(len(kept), bool)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _line(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _divided(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word. Words are joined by an added token, which the library cuts at before all else."""
        if self.divider is None or any(self.divider[0] in w for w in words):
            return self._whole(words)
        token, number = self.divider
        ids = self._line(token.join(words))
        pieces = np.split(ids, np.flatnonzero(ids == number))
        return [pieces[0], *[p[1:] for p in pieces[1:]]]

    def _new_words(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of all words one after the other, in parts, and the count of each word."""
        parts, sizes = [], []
        for i in range(0, len(words), 5000):
            some = words[i : i + 5000]
            if all(map(str.isalpha, some)):
                # words of letters: each one's last id, and no other, closes a word
                ids = self._line(" ".join(some))
                ends = np.flatnonzero(self.closes[ids])
                if len(ends) == len(some):
                    parts.append(ids)
                    sizes.append(np.diff(ends, prepend=-1))
                    continue
            each = self._divided(some)
            parts.extend(each)
            sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        return parts, np.concatenate([np.zeros(0, np.int64), *sizes])

    def _places(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self._forget_unmet()
            new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self._forget()
            new = words
        known = len(self.begin)
        if new:
            new = sorted(new, key=str.isalpha)
            letters = next((i for i, w in enumerate(new) if w.isalpha()), len(new))
            found = [self._new_words(x) for x in (new[:letters], new[letters:])]
            sizes = np.concatenate([f[1] for f in found])
            begins = len(self.flat) + np.cumsum(sizes) - sizes
            self.place |= zip(new, range(len(self.begin), len(self.begin) + len(new)))
            self.flat = np.concatenate([self.flat, *found[0][0], *found[1][0]])
            self.begin = np.concatenate([self.begin, begins])
            self.size = np.concatenate([self.size, sizes])
            self.met = np.concatenate([self.met, np.zeros(len(sizes), bool)])
        places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        self.met[places[places < known]] = True
        return places

    def _cut(self, texts: pa.Array) -> pa.Array:
        lower = pc.ascii_lower(texts)
        # where an added token is spelled out, or would be in lower case, nothing but white space divides
        marks = not any(pc.any(pc.match_substring(lower, token)).as_py() for token in self.added)
        if marks and self.lowers:
            # some letters have a form with a combining mark in lower case alone, which normalising would then find
            texts = pc.if_else(pc.match_substring_regex(texts, _COMBINING), texts, lower)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        text = np.frombuffer(data or b"", np.uint8)[: offsets[-1]]
        at = np.flatnonzero(_IS_MARK[text]) if marks else np.zeros(0, np.int64)
        at = at[at > 0]
        before = (text[at - 2].astype(np.int32) << 8) | text[at - 1]
        opens = np.zeros(len(text) + 1, bool)
        opens[offsets] = True
        at = at[self.after[before] & ~opens[at]]
        text = np.insert(text, at, 32)
        text[text == 10] = 32
        ends = offsets + np.searchsorted(at, offsets)
        spaced = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(text))
        return pc.split_pattern(spaced, " ")

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, each text closed by `end`; and the count of each."""
        # a copy without offset: pyarrow's ascii_lower does not heed those of slices
        texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), ""), pa.array([], pa.large_string())])
        if not self.by_word:
            each = [np.append(ids, np.uint32(end)) for ids in self._whole(texts.to_pylist())]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            return np.concatenate([np.zeros(0, np.uint32), *each]).astype(np.uint32), counts
        lists = self._cut(texts)
        bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        place = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size, begin = self.size[place], self.begin[place]
        # the closing id is one more word, after the last of each text
        flat, close = np.append(self.flat, np.uint32(end)), len(place)
        size, begin = np.append(size, 1), np.append(begin, len(self.flat))
        code = np.insert(code, bounds[1:], close)
        length = size[code]
        after = np.cumsum(length)
        ids = flat[np.repeat(begin[code] - after + length, length) + np.arange(after[-1] if len(after) else 0)]
        ends = after[bounds[1:] + np.arange(len(bounds) - 1)] if len(bounds) > 1 else np.zeros(0, np.int64)
        return ids, np.diff(ends, prepend=0)


def encoder(path: str, by_word: bool) -> Encoder:
    """One encoder per tokenizer in a Python worker, kept from task to task."""
    if (path, by_word) not in _encoders:
        _encoders[path, by_word] = Encoder(path, by_word)
    return _encoders[path, by_word]


def steps(texts: pa.Array):
    """(first, end) of runs of texts of at most STEP bytes, or of one text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > STEP:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)
