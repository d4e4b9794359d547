"""Token ids of whole texts, with the ids of frequent words kept.

Both vocabularies used here never join text across a space, unless it stands between
two blanks (or a blank and the end), where they may take blanks together. So a text is
cut before its other spaces, and each piece is encoded by the tokenizers library once
and looked up after that. Ids are the same as those of the uncut text (see the tests).
Arrow cuts many texts at once, finds their different pieces, and strings the ids together.

A call of the library costs more than a short piece, so new pieces are strung together
with a digit after each. Neither vocabulary joins a digit to a letter or sign before it
or to a space after it, and its id shows where a piece ends. Pieces that hold that
digit, or end in neither a letter nor a sign, are encoded one by one.

A word of Latin letters needs no normalising: the library's model takes it as the vocabulary
writes it, with what it writes for the space before it. A few signs and one end of line
after such a word, and one more word after these, are looked up by themselves, as both
vocabularies always cut there.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace()]
_SAFE_SPACE = re.compile(r" (?=\S)")
#: Written after each of the pieces that are encoded together.
MARK = "0"
_ENDS = frozenset(string.punctuation)
#: Letters that a word may have, and signs that may end it.
_LETTERS = string.ascii_letters + "".join(c for c in map(chr, range(0xC0, 0x100)) if c.isalpha())
_SIGNS = ".,;:!?*)$#%&"
_WORDS = re.compile(rf"([{_LETTERS}]+)([{re.escape(_SIGNS)}]*\n?)([{_LETTERS}]*)")
#: Pieces strung together.
PIECES_AT_ONCE = 256
#: Pieces kept in a worker, and their ids; beyond that only the first ones, which are
#: the most frequent by and large, are kept.
MAX_PIECES, FIRST_PIECES, MAX_IDS = 1_000_000, 500_000, 8_000_000
#: Characters that are encoded at once.
CHARS_AT_ONCE = 1 << 20


def _odd(text: str) -> bool:
    """Whether a blank stands before a space somewhere."""
    # Looking for one character is much quicker than for two.
    return any(c + " " in text for c in filter(text.__contains__, _BLANKS))


def _pieces(texts: list[str], odd: bool) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, without the space before them, and the place of each
    text's first piece, then that of the end."""
    if odd:
        lists = pa.array([_SAFE_SPACE.split(t) for t in texts], pa.large_list(pa.large_string()))
    else:
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    return lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # much quicker than to_pylist


class Encoder:
    """Encodes texts to arrays of unsigned 32-bit ids."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        mark = self.library.encode(MARK, add_special_tokens=False).ids
        self.mark_id = mark[0] if len(mark) == 1 else None
        #: How each letter is written, and the space before a word; None if words of
        #: these letters are cut, or not cut from what is around them.
        self.written: dict[int, str] = {}
        self.space = self._space()
        #: The bytes of each piece's ids, and how many ids there are.
        self.known: dict[object, bytes] = {}
        self.n_ids = 0

    def _cut(self, text: str) -> list[str]:
        """The words that the library cuts a text into."""
        library = self.library
        text = library.normalizer.normalize_str(text) if library.normalizer else text
        return [w for w, _ in library.pre_tokenizer.pre_tokenize_str(text)] if library.pre_tokenizer else [text]

    def _space(self) -> str | None:
        first = self._cut(" a")
        if len(first) != 1 or not first[0].endswith("a"):
            return None
        space = first[0][:-1]
        for c in _LETTERS:
            whole = self._cut(f" a{c}a")
            if len(whole) != 1 or not whole[0].startswith(f"{space}a") or not whole[0].endswith("a"):
                return None
            self.written[ord(c)] = whole[0][len(space) + 1 : -1]
        if self._cut(f" {_LETTERS}") != [space + _LETTERS.translate(self.written)]:
            return None
        for sign in ["\n"] + [sign + end for sign in _SIGNS for end in ("", "\n")]:
            if self._cut(f" ab{sign}cd") != [f"{space}ab", *self._cut(sign), "cd"]:
                return None
        return space

    def _by_model(self, space: str, words: list[str]) -> list[bytes]:
        """The ids of words of Latin letters, by the model alone."""
        tokenize = self.library.model.tokenize
        # All are written at once; no letter is written as an end of line.
        written = "\n".join(words).translate(self.written).split("\n") if words else []
        return [array("I", [t.id for t in tokenize(space + w)]).tobytes() for w in written]

    def _words(self, parts: list[tuple[str, str, str]]) -> list[bytes]:
        """The ids of a word, the signs after it and the word after these, of each."""
        known, found = self.known, []
        heads = [h for h in dict.fromkeys([head for head, _, _ in parts]) if h not in known]
        tails = list(dict.fromkeys([tail for _, _, tail in parts if tail and (tail,) not in known]))
        for h, ids in zip(heads, self._by_model(self.space, heads)):
            known[h] = ids
            self.n_ids += len(ids) // 4
        after_signs = dict(zip(tails, self._by_model("", tails)))
        for head, signs, tail in parts:
            ids = known[head]
            if signs:
                after = known.get((signs,))
                if after is None:
                    after = known[(signs,)] = self._ids([signs])[0]
                    self.n_ids += len(after) // 4
                ids += after
            if tail:
                ids += after_signs[tail] if tail in after_signs else known[(tail,)]
            found.append(ids)
        return found

    def _trim(self) -> None:
        """Forgets all but the first pieces, or all if those are too long to keep."""
        self.known = dict(itertools.islice(self.known.items(), FIRST_PIECES))
        self.n_ids = sum(map(len, self.known.values())) // 4
        if self.n_ids > MAX_IDS // 2:
            self.known, self.n_ids = {}, 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        coded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in coded]

    def _strung(self, pieces: list[str]) -> list[bytes] | None:
        """The ids of each of the pieces."""
        some = range(0, len(pieces), PIECES_AT_ONCE)
        after = MARK + " "
        raw = b"".join(self._ids([f" {after.join(pieces[i : i + PIECES_AT_ONCE])}{MARK}" for i in some]))
        ends = (np.flatnonzero(np.frombuffer(raw, dtype=np.uint32) == self.mark_id) * 4).tolist()
        if len(ends) != len(pieces):
            return None
        return [raw[a:b] for a, b in zip([0] + [end + 4 for end in ends], ends)]

    def _add(self, pieces: list) -> None:
        plain, parts, strung, single = [], [], [], []
        for p in pieces:
            if self.space is not None and type(p) is str:
                # Most new pieces are one word: no need to match these.
                words = (p, "", "") if p.isascii() and p.isalpha() else (m := _WORDS.fullmatch(p)) and m.groups()
                if words:
                    plain.append(p)
                    parts.append(words)
                    continue
            fits = type(p) is str and p and MARK not in p and not p[0].isspace()
            if fits and (p[-1].isalpha() or p[-1] in _ENDS):
                strung.append(p)
            else:
                single.append(p)
        found = self._strung(strung) if strung and self.mark_id is not None else None
        if found is None:
            strung, single, found = [], strung + single, []
        found += self._ids([p[0] if type(p) is tuple else " " + p for p in single])
        self.known.update(zip(strung + single, found))
        self.n_ids += sum(map(len, found)) // 4
        for p, ids in zip(plain, self._words(parts)):
            if p not in self.known:
                self.known[p] = ids
                self.n_ids += len(ids) // 4

    def _looked_up(self, texts: list[str], odd: bool) -> Iterator[np.ndarray]:
        """The ids of each text. Each different piece is looked up in Python once."""
        if not texts:
            return
        pieces, places = _pieces(texts, odd)
        rest = np.ones(len(pieces), dtype=bool)
        rest[places[:-1]] = False
        coded = pieces.filter(pa.array(rest)).dictionary_encode()
        # A text's first piece is a 1-tuple: it has no space before it.
        keys = _strings(coded.dictionary)
        codes = np.empty(len(pieces), dtype=np.int64)
        codes[rest] = coded.indices.to_numpy()
        codes[places[:-1]] = np.arange(len(keys), len(keys) + len(texts))
        keys += [(first,) for first in _strings(pieces.take(pa.array(places[:-1])))]
        found = list(map(self.known.get, keys))
        if new := [i for i, ids in enumerate(found) if ids is None]:
            self._add(list(dict.fromkeys([keys[i] for i in new])))
            for i in new:
                found[i] = self.known[keys[i]]
        ids = pa.array(found, pa.large_binary()).take(pa.array(codes))
        _, starts, raw = ids.buffers()
        cuts = np.frombuffer(starts, dtype=np.int64)[places] // 4
        whole = np.frombuffer(raw or b"", dtype=np.uint32)
        for a, b in itertools.pairwise(cuts.tolist()):
            yield whole[a:b]

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) > MAX_PIECES or self.n_ids > MAX_IDS:
            self._trim()
        odd = list(map(_odd, texts))
        found = [self._looked_up([t for t, o in zip(texts, odd) if o == kind], kind) for kind in (False, True)]
        for kind in odd:
            yield next(found[kind])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        some, chars = [], 0
        for text in texts:
            some.append(text)
            chars += len(text)
            if chars >= CHARS_AT_ONCE:
                yield from self._encode(some)
                some, chars = [], 0
        if some:
            yield from self._encode(some)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process and vocabulary."""
    return Encoder(path)
