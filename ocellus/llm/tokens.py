"""Token ids of whole texts by a public tokenizer file, quickly.

Texts repeat most of their words, so a task encodes each distinct word once.
A block of texts is cut and its distinct chunks are found and looked up
column-wise; the ids of all texts are then gathered from those of the chunks.  Texts are cut only
where the tokenizer itself always cuts: around a line feed and before a
blank where no other white space is beside them, and after a run of Latin
letters that an ASCII non-letter follows.  Words of letters go to the tokenizer's model directly,
all else through the whole tokenizer.  A text with other white space than
ASCII's, with an added token's text or with U+0130 (whose lower-case form ends
in a combining dot) goes to the tokenizer whole.
"""

from __future__ import annotations

import functools
import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = "\x02"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_PART = re.compile(rf"[ \t-\r]*(?:[{_LATIN}]++(?=[\x00-@\[-`{{-\x7f]|\Z)|[^ \t-\r]++)|[ \t-\r]++")
_ODD = re.compile(r"[\x02\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeffİ]")
_LETTER_END = rf"([{_LATIN}])([!-@\[-`{{-~])"
_GAP = re.compile(r"[ \t-\r][ \t-\r]")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocab: str, words: int = 400_000):
        """``vocab``: a file name of ``public_tokenizers`` or a path;
        ``words``: how many distinct chunks are remembered."""
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocab if os.path.sep in vocab else public_tokenizers.path(vocab)
        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added), re.IGNORECASE) if added else None
        # what all added tokens begin with, if it has no letters: quick to look for
        first = os.path.commonprefix([t.content for t in self.tokenizer.get_added_tokens_decoder().values()])
        self.hint = re.match("[!-@]*", first)[0]
        self.model = self.tokenizer.model
        # remembered chunks: their text, where their ids begin in ``flat``, and how many
        self.words, self.known = words, pa.array([], pa.large_string())
        self.first, self.size, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")
        # what the model is given for a letter, and for a blank before a word
        self.letters, self.blank, self.same = {}, "", False
        self.blank = self._given(" a").removesuffix(self._given("a"))
        for c in filter(re.compile(f"[{_LATIN}]").match, map(chr, range(65, 0x250))):
            self.letters[ord(c)] = self._given(c)
            if any(self._direct(w) != self._whole(w) for w in (f"a{c}b", f" {c}{c}", c)):
                del self.letters[ord(c)]
        kept = "".join(map(chr, self.letters))
        #: ASCII letters are given to the model as they are
        self.same = all(self.letters.get(ord(c)) == c for c in string.ascii_letters)
        self.plain = re.compile(rf" ?[{kept}]{{1,64}}\Z") if kept else None

    def _given(self, text: str) -> str:
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def _direct(self, word: str) -> bytes:
        given = word[1:] if word[0] == " " else word
        if not self.same or not word.isascii():
            given = given.translate(self.letters)
        if word[0] == " ":
            given = self.blank + given
        return array("I", [t.id for t in self.model.tokenize(given)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        """Remember the ids of ``chunks``."""
        plain, direct, whole = self.plain.match if self.plain else lambda c: False, self._direct, self._whole
        raw = [(direct(c) if plain(c) else whole(c)) if c else b"" for c in chunks]
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        self.known = pa.concat_arrays([self.known, pa.array(chunks, pa.large_string())])
        self.first = np.r_[self.first, len(self.flat) + np.cumsum(size) - size]
        self.size = np.r_[self.size, size]
        self.flat = np.r_[self.flat, np.frombuffer(b"".join(raw), "<u4")]

    def _forget(self, places: np.ndarray) -> None:
        """Keep the chunks at ``places``: those of this block are the likeliest
        to return."""
        self.known = self.known.take(pa.array(places))
        first, self.size = self.first[places], self.size[places]
        ends = np.cumsum(self.size)
        self.flat = self.flat[np.repeat(first - ends + self.size, self.size) + np.arange(ends[-1] if len(ends) else 0)]
        self.first = ends - self.size

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Where the distinct ``chunks`` are remembered."""
        at = pc.index_in(chunks, value_set=self.known)
        if at.null_count:
            self._learn(chunks.filter(pc.is_null(at)).to_pylist())
            at = pc.index_in(chunks, value_set=self.known)
        return at.to_numpy().astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One byte string per text (null: empty)."""
        out = [b""] * len(texts)
        easy, cut, parts, ends = [], [], [], [0]
        for i, t in enumerate(texts):
            if not t:
                continue
            if _ODD.search(t) or self.added and self.hint in t and self.added.search(t):
                out[i] = self._whole(t)
            elif _GAP.search(t):
                cut.append(i)
                parts += _PART.findall(t)
                ends.append(len(parts))
            else:
                easy.append(i)
        column = pa.array([texts[i] for i in easy], pa.large_string())
        column = pc.replace_substring(pc.replace_substring(column, " ", CUT + " "), "\n", CUT + "\n" + CUT)
        column = pc.replace_substring_regex(column, _LETTER_END, rf"\1{CUT}\2")
        lists = pc.split_pattern(column, CUT)
        count = lists.offsets.to_numpy() - lists.offsets[0].as_py() if easy else np.zeros(1, np.int64)
        bounds = np.r_[count, count[-1] + np.array(ends[1:], np.int64)]
        coded = pa.concat_arrays([lists.flatten(), pa.array(parts, pa.large_string())]).dictionary_encode()
        if not len(coded):
            return out
        places = self._places(coded.dictionary)
        at = places[coded.indices.to_numpy()]
        sizes = self.size[at]
        upto = np.cumsum(sizes)
        raw = self.flat[np.repeat(self.first[at] - upto + sizes, sizes) + np.arange(upto[-1])].tobytes()
        bounds = np.r_[0, upto][bounds] * 4
        for i, a, b in zip(easy + cut, bounds.tolist(), bounds[1:].tolist()):
            out[i] = raw[a:b]
        if len(self.known) > self.words:
            self._forget(places)
        return out


@functools.cache
def shared_encoder(vocab: str) -> Encoder:
    """One encoder for all tasks of a worker process: it stays loaded and
    remembers the words of earlier tasks."""
    return Encoder(vocab)


def in_blocks(texts: list, chars: int = 4_000_000):
    """Index ranges of ``texts`` with about ``chars`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
