"""Token ids of whole texts by a public vocabulary, column by column."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from ranklight.llm.common import SPACE

_KNOWN_WORDS = 700_000
#: Marks that are cut off the end of a word, so that the word is encoded once for all of them.
_MARKS = ".,!?:;*$%&#|"
_SLICE = 12 << 20
#: So many words of letters are encoded as one text, which takes less time than as many texts.
_RUN = 100
_SAMPLES = ["ab", "Zulu", "7", "42", "don't", "x.", "...", "$5", "ä", "Ωmega", "日本", "<|endoftext|>"]


class WordIds:
    """Ids of texts, by the ids of their different words.

    A vocabulary that joins text across white space, or makes ids of it, is refused, as texts are
    encoded word by word. Where it also looks at neither the case of letters nor across a letter
    and a mark after it, the stems of words stand for many forms.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(content)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.last[[i for w, i in vocabulary.items() if mark and w.endswith(mark)]] = True
        apart = [i for w in _SAMPLES for i in self._encoded([w])[0].tolist()]
        for space in SPACE:
            for joined in (space.join(_SAMPLES), space + (2 * space).join(_SAMPLES) + space):
                if self._encoded([joined])[0].tolist() != apart:
                    raise ValueError("the vocabulary does not keep words apart at white space")
        pairs = [(w, m) for w in ("ab", "Zulu", "Hä", "日本") for k in _MARKS for m in (k, 2 * k, "." + k)]
        whole = self._encoded([w + m for w, m in pairs] + [w.lower() + m for w, m in pairs])
        halves = [self._encoded([w, m]) for w, m in pairs]
        self.stems = all(
            np.concatenate(half).tolist() == one.tolist() for half, one in zip(2 * halves, whole)
        )

    def _encoded(self, words: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of words that are not known.

        Words of letters are encoded in runs where the vocabulary marks the last id of each word. Where
        a run has not one mark for each of its words, they are encoded apart.
        """
        letters = [w for w in words if w.isalpha()] if self.last.any() else []
        alone = [w for w in words if not w.isalpha()] if letters else list(words)
        runs = [letters[k : k + _RUN] for k in range(0, len(letters), _RUN)]
        width = np.dtype(self.kind).itemsize
        for start in range(0, len(runs), _RUN):
            some = runs[start : start + _RUN]
            found = self.tokenizer.encode_batch_fast([" ".join(r) for r in some], add_special_tokens=False)
            for run, e in zip(some, found):
                ids = np.array(e.ids, self.kind)
                ends = np.flatnonzero(self.last[ids]) + 1
                if len(ends) != len(run) or ends[-1] != len(ids):
                    alone += run
                    continue
                held, bounds = ids.tobytes(), [0, *(width * ends).tolist()]
                self.known.update((w, held[a:b]) for w, a, b in zip(run, bounds, bounds[1:]))
        for start in range(0, len(alone), 10_000):
            some = alone[start : start + 10_000]
            self.known.update((w, ids.tobytes()) for w, ids in zip(some, self._encoded(some)))

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        new = [w for w in words if w not in self.known]
        if new and len(self.known) + len(new) > _KNOWN_WORDS:
            self.known.clear()
            new = words
        self._learn(new)
        ids = [self.known[w] for w in words]
        width = np.dtype(self.kind).itemsize
        return np.frombuffer(b"".join(ids), self.kind), np.array([len(i) for i in ids], np.int64) // width

    def _parts(self, words: pa.Array) -> list[pa.Array]:
        """Stems in lower case and the marks after them; other words whole."""
        if not self.stems:
            return [words]
        stem = pc.ascii_rtrim(words, _MARKS)
        cut = pc.match_substring_regex(stem, r"\p{L}$")
        marks = pc.replace_substring_regex(words, f"(?s)^.*[^{_MARKS}]", "")
        stem = pc.if_else(cut, stem, words)
        plain = pc.and_not(pc.string_is_ascii(stem), pc.match_substring(stem, "<|"))
        return [pc.if_else(plain, pc.ascii_lower(stem), stem), pc.if_else(cut, marks, "")]

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin, with the end of the last."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        # A word is one or two parts; each part is a run in the ids of all different parts.
        parts = [p.dictionary_encode() for p in self._parts(coded.dictionary)]
        ids, size = self._of_words([w for p in parts for w in p.dictionary.to_pylist()])
        shift = np.cumsum([0, *(len(p.dictionary) for p in parts)])
        part = np.stack([p.indices.to_numpy() + s for p, s in zip(parts, shift)], axis=1)
        code = part[coded.indices.to_numpy()].ravel()
        per, first = size[code], np.cumsum(size) - size
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(per)))
        place = np.repeat(first[code] - ends[:-1], per)
        place += np.arange(len(place))
        return ids[place], ends[words.offsets.to_numpy().astype(np.int64) * len(parts)]

    def of_long_text(self, text: bytes) -> np.ndarray:
        """Ids of one text, slice by slice, each cut at white space."""
        spaces = tuple(SPACE.encode())
        found, start = [np.zeros(0, self.kind)], 0
        while start < len(text):
            end = min(len(text), start + _SLICE)
            while end < len(text) and text[end] not in spaces:
                end += 1
            found.append(self.of_texts(pa.array([text[start:end].decode()]))[0])
            start = end
        return np.concatenate(found)


_LOADED: dict[int, WordIds] = {}  # of this Python worker, by vocabulary


def word_ids(content: str) -> WordIds:
    key = hash(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordIds(content)
    return _LOADED[key]


def text_ids(words: WordIds, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text; null is empty."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(sizes):
        if sizes[start] > _SLICE:
            yield words.of_long_text(texts[start].as_py().encode())
            start += 1
            continue
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), _SLICE, side="right")))
        ids, bounds = words.of_texts(texts.slice(start, end - start))
        yield from np.split(ids, bounds[1:-1])
        start = end
